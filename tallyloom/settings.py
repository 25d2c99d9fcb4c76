"""Parameters of the four stages, as frozen dataclasses with the usual defaults."""

from __future__ import annotations

from dataclasses import dataclass

# Thresholds and parameters that must equal the specified behaviour.
LAGS = (7, 14, 30, 365)
WINDOWS = (7, 14, 30)
TRAIN_RATIO, VAL_RATIO, TEST_RATIO = 0.8, 0.1, 0.1
BASELINE_RATIO = 0.8
RICH_DAYS, MEDIUM_DAYS, MIN_ADAPTER_ROWS = 1095, 365, 180
MAPE_MINOR, MAPE_ALERT, MAPE_EMERGENCY, MAPE_INCREASE = 5.0, 8.0, 12.0, 0.3
MAPE_WITHOUT_VALID_ROWS = 999.0
PSI_HIGH, PSI_MEDIUM, PSI_BINS = 0.25, 0.1, 10
PSI_EPSILON, PSI_MISSING_SHARE = 1e-10, 0.001
CUSUM_THRESHOLD, CUSUM_SLACK = 5.0, 3.0
SHRINKAGE = 0.7
INTERVAL_Z, INTERVAL_STD_SHARE, CONFIDENCE = 1.28, 0.3, 0.8
DEFAULT_PRICE_POINT = 500
FUTURE_EXTERNALS = {
    "gdp_growth": 3.0,
    "tourism_index": 100.0,
    "currency_rate_to_usd": 3.67,
    "temperature_celsius": 25.0,
    "is_public_holiday": 0,
}


@dataclass(frozen=True)
class FeatureSettings:
    lags: tuple[int, ...] = LAGS
    windows: tuple[int, ...] = WINDOWS
    target: str = "sales_amount"


@dataclass(frozen=True)
class SplitSettings:
    train: float = TRAIN_RATIO
    val: float = VAL_RATIO


@dataclass(frozen=True)
class ModelSettings:
    trees: int = 200
    depth: int = 7
    learning_rate: float = 0.05
    subsample: float = 0.8
    seed: int = 42
    min_adapter_rows: int = MIN_ADAPTER_ROWS
    rich_days: int = RICH_DAYS
    medium_days: int = MEDIUM_DAYS
    shrinkage: float = SHRINKAGE


@dataclass(frozen=True)
class DriftSettings:
    mape_minor: float = MAPE_MINOR
    mape_alert: float = MAPE_ALERT
    mape_emergency: float = MAPE_EMERGENCY
    mape_increase: float = MAPE_INCREASE
    psi_threshold: float = PSI_HIGH
    psi_medium: float = PSI_MEDIUM
    cusum_threshold: float = CUSUM_THRESHOLD
    cusum_slack: float = CUSUM_SLACK
    rolling_days: int = 7


@dataclass(frozen=True)
class ForecastSettings:
    horizon_days: int = 30
    confidence: float = CONFIDENCE
    z_score: float = INTERVAL_Z
    std_share: float = INTERVAL_STD_SHARE
