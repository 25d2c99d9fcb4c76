"""Drift summary of one scored table: error, feature and gradual drift, and advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.metrics import is_valid, mape
from tallyloom.functions.rules import (
    cusum_direction,
    cusum_drift,
    mape_action,
    mape_increase,
    mape_severity,
    recommended_action,
)
from tallyloom.operators.cusum import cusum_once
from tallyloom.operators.health import critical_stores
from tallyloom.settings import MAPE_WITHOUT_VALID_ROWS, DriftSettings

# Limits and texts of the advice.
NOTE_PSI_FEATURES = 3
NOTE_CRITICAL_STORES = 10
NAMED_STORES = 5
ADVICE = {
    "emergency": "URGENT: Retrain global model immediately. MAPE exceeded 12% threshold.",
    "review": "Conduct human review to identify root cause (data quality, market changes, etc.)",
    "cluster": "Retrain models for affected store cluster (%d stores)",
    "focus": "Focus on stores: %s%s",
    "others": " and others",
    "gradual": "Investigate gradual drift detected by CUSUM. Monitor for next 7 days.",
    "alert": "Continue monitoring. Minor drift detected but within acceptable thresholds.",
    "none": "No action required. Models performing within expected ranges.",
    "features": "Feature drift detected in %d features. Review data pipeline for quality issues.",
    "critical": "%d stores in critical state. Consider cluster-level intervention.",
}


def error_summary(
    scored: DataFrame, baseline: Column, actual: str = "sales_amount", prediction: str = "prediction"
) -> DataFrame:
    """One row: baseline and current MAPE over valid rows, and the mean residual of the current
    part. Both MAPE values take the fallback when either part has no valid row."""
    y, p = F.col(actual), F.col(prediction)
    valid = is_valid(y)
    row = scored.agg(
        mape(y, p, valid & baseline).alias("__baseline"),
        mape(y, p, valid & ~baseline).alias("__current"),
        F.avg(F.when(~baseline, y - p)).alias("mean_residual"),
    )
    both = F.col("__baseline").isNotNull() & F.col("__current").isNotNull()
    fallback = F.lit(MAPE_WITHOUT_VALID_ROWS)
    return row.select(
        F.when(both, F.col("__current")).otherwise(fallback).alias("current_mape"),
        F.when(both, F.col("__baseline")).otherwise(fallback).alias("baseline_mape"),
        "mean_residual",
    )


def mape_drift(errors: DataFrame, settings: DriftSettings = DriftSettings()) -> DataFrame:
    """Add increase, severity, action and the drift flag to current_mape and baseline_mape."""
    current, base = F.col("current_mape"), F.col("baseline_mape")
    severity = mape_severity(current, base, settings)
    return errors.withColumns(
        {
            "increase_pct": mape_increase(current, base),
            "drift_detected": severity != "none",
            "severity": severity,
            "action": mape_action(severity),
        }
    )


def mean_residual_cusum(errors: DataFrame, settings: DriftSettings = DriftSettings()) -> DataFrame:
    """CUSUM after a single update from zero with the mean residual."""
    pos, neg = cusum_once(F.col("mean_residual"), slack=settings.cusum_slack)
    return errors.select("mean_residual", pos.alias("cusum_pos"), neg.alias("cusum_neg")).withColumns(
        {
            "drift_detected": cusum_drift(F.col("cusum_pos"), F.col("cusum_neg"), settings.cusum_threshold),
            "direction": cusum_direction(F.col("cusum_pos"), F.col("cusum_neg")),
        }
    )


def drift_report(errors: DataFrame, psi: DataFrame, settings: DriftSettings = DriftSettings()) -> DataFrame:
    """One row: structs mape, psi (with a map of feature details) and cusum, the overall flag
    and the recommended action. ``errors`` has one row, ``psi`` one row per feature."""
    severity = mape_severity(F.col("current_mape"), F.col("baseline_mape"), settings)
    pos, neg = cusum_once(F.col("mean_residual"), slack=settings.cusum_slack)
    detail = F.struct("psi", "drift_detected", "severity")
    features = psi.agg(
        F.struct(
            F.count_if("drift_detected").alias("drifted_features"),
            F.count(F.lit(1)).alias("total_features"),
            (F.count_if("drift_detected") > 0).alias("drift_detected"),
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("feature", detail)))).alias("details"),
        )
    ).scalar()
    rows = errors.select(
        F.struct(
            "current_mape",
            "baseline_mape",
            mape_increase(F.col("current_mape"), F.col("baseline_mape")).alias("increase_pct"),
            (severity != "none").alias("drift_detected"),
            severity.alias("severity"),
            mape_action(severity).alias("action"),
        ).alias("mape"),
        features.alias("psi"),
        F.struct(
            pos.alias("cusum_pos"),
            neg.alias("cusum_neg"),
            cusum_drift(pos, neg, settings.cusum_threshold).alias("drift_detected"),
            cusum_direction(pos, neg).alias("direction"),
        ).alias("cusum"),
    )
    any_drift = F.col("mape.drift_detected") | F.col("psi.drift_detected") | F.col("cusum.drift_detected")
    return rows.withColumns(
        {
            "drift_detected": any_drift,
            "recommended_action": recommended_action(
                F.col("mape.severity"),
                F.col("psi.drifted_features"),
                F.col("cusum.drift_detected"),
                any_drift,
            ),
        }
    )


def recommendations(report: DataFrame, health: DataFrame, store: str = "store_id") -> DataFrame:
    """Table (position, recommendation) from a one-row drift report and the store health table."""
    named = critical_stores(health, NAMED_STORES, store).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct((-F.col("mape")).alias("order"), F.col(store).alias("id")))),
            lambda s: s["id"].cast("string"),
        )
    )
    critical = health.agg(F.count_if(F.col("health_status") == "critical")).scalar()
    facts = report.select(
        F.col("recommended_action").alias("action"),
        F.col("psi.drifted_features").alias("drifted"),
        critical.alias("critical"),
        F.array_join(named.scalar(), ", ").alias("named"),
    )
    action, drifted, count = F.col("action"), F.col("drifted"), F.col("critical")

    def text(key: str, *values: Column) -> Column:
        return F.format_string(ADVICE[key], *values) if values else F.lit(ADVICE[key])

    others = F.when(count > NAMED_STORES, ADVICE["others"]).otherwise("")
    main = (
        F.when(action == "retrain_global_emergency", F.array(text("emergency"), text("review")))
        .when(
            action == "retrain_cluster",
            F.array(text("cluster", count), text("focus", F.col("named"), others)),
        )
        .when(action == "investigate_gradual_drift", F.array(text("gradual")))
        .when(action == "alert_only", F.array(text("alert")))
        .otherwise(F.array(text("none")))
    )
    notes = F.filter(
        F.array(
            F.when(drifted >= NOTE_PSI_FEATURES, text("features", drifted)),
            F.when(count > NOTE_CRITICAL_STORES, text("critical", count)),
        ),
        lambda note: note.isNotNull(),
    )
    return facts.select(F.posexplode(F.concat(main, notes)).alias("index", "recommendation")).select(
        (F.col("index") + 1).alias("position"), "recommendation"
    )
