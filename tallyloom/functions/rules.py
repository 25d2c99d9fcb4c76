"""Threshold rules as ordered ``when`` chains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.settings import DriftSettings, ModelSettings

# Names that reports carry.
HEALTH_STATES = ("healthy", "warning", "critical")
ACTION_OF_SEVERITY = {
    "severe": "retrain_global_emergency",
    "moderate": "retrain_cluster",
    "minor": "alert_only",
}
CLUSTER_RETRAIN_FEATURES = 5


def history_tier(history_days: Column, settings: ModelSettings = ModelSettings()) -> Column:
    return (
        F.when(history_days >= settings.rich_days, "data_rich")
        .when(history_days >= settings.medium_days, "data_medium")
        .otherwise("data_poor")
    )


def health_class(mape: Column, settings: DriftSettings = DriftSettings()) -> Column:
    return (
        F.when(mape < settings.mape_minor, "healthy")
        .when(mape < settings.mape_alert, "warning")
        .otherwise("critical")
    )


def mape_increase(current: Column, baseline: Column) -> Column:
    """Relative increase in percent; 0 where the baseline is not positive."""
    return F.when(baseline > 0, F.try_divide(current - baseline, baseline) * 100).otherwise(F.lit(0.0))


def mape_severity(current: Column, baseline: Column, settings: DriftSettings = DriftSettings()) -> Column:
    return (
        F.when(current >= settings.mape_emergency, "severe")
        .when(current >= settings.mape_alert, "moderate")
        .when(current >= settings.mape_minor, "minor")
        .when(mape_increase(current, baseline) > settings.mape_increase * 100, "minor")
        .otherwise("none")
    )


def mape_action(severity: Column) -> Column:
    chain = None
    for name, action in ACTION_OF_SEVERITY.items():
        chain = F.when(severity == name, action) if chain is None else chain.when(severity == name, action)
    return chain.otherwise("none")


def psi_severity(psi: Column, settings: DriftSettings = DriftSettings()) -> Column:
    return (
        F.when(psi > settings.psi_threshold, "high").when(psi > settings.psi_medium, "medium").otherwise("low")
    )


def cusum_drift(positive: Column, negative: Column, threshold: float) -> Column:
    return (F.abs(positive) > threshold) | (F.abs(negative) > threshold)


def cusum_direction(positive: Column, negative: Column) -> Column:
    return F.when(positive > F.abs(negative), "positive").otherwise("negative")


def recommended_action(
    mape_severity: Column, drifted_features: Column, cusum_drifted: Column, any_drift: Column
) -> Column:
    return (
        F.when(mape_severity == "severe", "retrain_global_emergency")
        .when(
            (mape_severity == "moderate") | (drifted_features >= CLUSTER_RETRAIN_FEATURES),
            "retrain_cluster",
        )
        .when(cusum_drifted, "investigate_gradual_drift")
        .when(any_drift, "alert_only")
        .otherwise("none")
    )
