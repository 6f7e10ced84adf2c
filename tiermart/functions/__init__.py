from tiermart.functions.columns import (
    MONEY,
    any_changed,
    cast_failed,
    convert_timezone,
    exact_mean,
    growth_percentage,
    mean,
    percentage,
    run_timestamp,
    to_money,
)

__all__ = [
    "MONEY",
    "any_changed",
    "cast_failed",
    "convert_timezone",
    "exact_mean",
    "growth_percentage",
    "mean",
    "percentage",
    "run_timestamp",
    "to_money",
]
