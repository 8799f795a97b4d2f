"""Table shapes. Every reader binds these by column name, never by position."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, kind, True) for name in names]


RAW = T.StructType(
    _fields(T.StringType(), "txn_id")
    # Wall-clock time without a zone: hour and weekday do not depend on the session.
    + _fields(T.TimestampNTZType(), "timestamp")
    + _fields(T.StringType(), "sender_vpa", "receiver_vpa")
    + _fields(T.DecimalType(15, 2), "amount")
    + _fields(
        T.StringType(),
        "bank",
        "device_id",
        "app_name",
        "merchant_name",
        "sender_state",
        "txn_status",
        "failure_reason",
    )
    + _fields(T.IntegerType(), "device_mismatch", "geo_anomaly", "is_fraud")
)

DERIVED = T.StructType(
    _fields(T.IntegerType(), "txn_hour", "txn_day_of_week", "is_night_txn", "is_weekend")
    + _fields(T.DoubleType(), "amount_log", "amount_zscore")
    + _fields(T.LongType(), "sender_txn_velocity_1h", "sender_txn_velocity_24h")
    + _fields(T.DoubleType(), "sender_avg_amount_30d")
    + _fields(T.LongType(), "sender_txn_count_30d")
    + _fields(
        T.IntegerType(), "is_new_receiver", "amount_round_number", "txn_status_encoded"
    )
)

SCORES = T.StructType(
    _fields(T.DoubleType(), "fraud_probability")
    + _fields(T.IntegerType(), "fraud_flag")
    + _fields(T.StringType(), "risk_tier")
)

FEATURES = T.StructType(RAW.fields + DERIVED.fields)
SCORED = T.StructType(FEATURES.fields + SCORES.fields)

IMPORTANCES = T.StructType(
    _fields(T.StringType(), "feature") + _fields(T.DoubleType(), "importance_gain")
)

REPORT = T.StructType(
    _fields(T.StringType(), "model", "metric") + _fields(T.DoubleType(), "value")
)

# The model's inputs in the order the models are trained on.
FEATURE_COLUMNS = [
    "txn_hour",
    "txn_day_of_week",
    "is_night_txn",
    "is_weekend",
    "amount_log",
    "amount_zscore",
    "sender_txn_velocity_1h",
    "sender_txn_velocity_24h",
    "sender_avg_amount_30d",
    "sender_txn_count_30d",
    "device_mismatch",
    "geo_anomaly",
    "is_new_receiver",
    "amount_round_number",
    "txn_status_encoded",
]
LABEL = "is_fraud"
