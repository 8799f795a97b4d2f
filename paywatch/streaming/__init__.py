from paywatch.streaming.live import (
    daily_trend_stream,
    first_payments_stream,
    new_pairs_stream,
    rolling_rate_stream,
    velocity_alerts_stream,
    weekly_rate_stream,
)
from paywatch.streaming.run import append_to_table, latest_to_table, read_stream
from paywatch.streaming.velocity import payment_alerts_stream, payment_velocity_stream

__all__ = [
    "append_to_table",
    "daily_trend_stream",
    "first_payments_stream",
    "latest_to_table",
    "new_pairs_stream",
    "payment_alerts_stream",
    "payment_velocity_stream",
    "read_stream",
    "rolling_rate_stream",
    "velocity_alerts_stream",
    "weekly_rate_stream",
]
