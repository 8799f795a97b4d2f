from paywatch.functions.columns import (
    MICROS_PER_DAY,
    NIGHT_END_HOUR,
    NIGHT_START_HOUR,
    calendar_day_range,
    micros,
    present,
    rate_pct,
    ratio,
    risk_tier,
    round_half_up,
    rounded_quotient,
)

__all__ = [
    "MICROS_PER_DAY",
    "NIGHT_END_HOUR",
    "NIGHT_START_HOUR",
    "calendar_day_range",
    "micros",
    "present",
    "rate_pct",
    "ratio",
    "risk_tier",
    "round_half_up",
    "rounded_quotient",
]
