from tallyloom.functions.calendar import calendar_events, calendar_features, days_to_holiday
from tallyloom.functions.metrics import absolute_percentage_error, accuracy, is_valid, mae, mape, rmse
from tallyloom.functions.rules import (
    cusum_direction,
    health_class,
    history_tier,
    mape_severity,
    mape_action,
    psi_severity,
    recommended_action,
)

__all__ = [
    "absolute_percentage_error",
    "accuracy",
    "calendar_events",
    "calendar_features",
    "cusum_direction",
    "days_to_holiday",
    "health_class",
    "history_tier",
    "is_valid",
    "mae",
    "mape",
    "mape_action",
    "mape_severity",
    "psi_severity",
    "recommended_action",
    "rmse",
]
