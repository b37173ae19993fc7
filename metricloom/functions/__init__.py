"""Column helpers built from Spark's own functions; no Python runs per row."""

from metricloom.functions.scalars import (
    capitalise,
    event_flag,
    funnel_step,
    lower_code,
    month_of,
    normal_segment,
    numbered_key,
    parse_flag,
    ratio,
    strict_segment,
    surrogate_key,
    tenure_days,
    upper_code,
    within_days,
)

__all__ = [
    "capitalise",
    "event_flag",
    "funnel_step",
    "lower_code",
    "month_of",
    "normal_segment",
    "numbered_key",
    "parse_flag",
    "ratio",
    "strict_segment",
    "surrogate_key",
    "tenure_days",
    "upper_code",
    "within_days",
]
