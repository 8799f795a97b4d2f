"""Queries of the operations team: what to look at now."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywatch.functions import calendar_day_range
from paywatch.plans.kpis import MONEY_SUM
from paywatch.sources.tables import DAY

# Fixed value: payments per hour above which a sender counts as abusive.
VELOCITY_THRESHOLD = 10
# Fixed value: amount above which a payment is large.
LARGE_AMOUNT = 50000

QUEUE_COLUMNS = [
    "txn_id",
    "timestamp",
    "sender_vpa",
    "receiver_vpa",
    "amount",
    "bank",
    "app_name",
    "fraud_probability",
    "risk_tier",
    "device_mismatch",
    "geo_anomaly",
    "is_new_receiver",
    "sender_txn_velocity_1h",
]


def of_days(df: DataFrame, first: date, last: date | None = None) -> DataFrame:
    """Rows of the days first..last. On a table laid out by day the folders are
    pruned as well."""
    chosen = df.where(calendar_day_range(F.col("timestamp"), first, last))
    if DAY in df.columns:
        chosen = chosen.where(F.col(DAY).between(F.lit(first), F.lit(last or first)))
    return chosen


def of_sender(df: DataFrame, sender: str) -> DataFrame:
    """One sender's rows. On a lookup table row groups that cannot hold the sender are skipped."""
    return df.where(F.col("sender_vpa") == sender)


def of_tier(df: DataFrame, tier: str) -> DataFrame:
    """Rows of one risk tier. On a lookup table the other tiers' folders are skipped."""
    return df.where(F.col("risk_tier") == tier)


def flagged(df: DataFrame) -> DataFrame:
    """Flagged rows. On a lookup table row groups without one are skipped."""
    return df.where(F.col("fraud_flag") == 1)


def _today(df: DataFrame) -> date:
    """The session's date, which its time zone decides."""
    return df.sparkSession.sql("SELECT current_date()").head()[0]


def high_risk_queue(scored: DataFrame, as_of: date | None = None) -> DataFrame:
    """HIGH payments of one day, today by default, most probable first."""
    return (
        of_days(scored, as_of or _today(scored))
        .where(F.col("risk_tier") == "HIGH")
        .select(*QUEUE_COLUMNS)
        .orderBy(F.desc("fraud_probability"), F.asc("txn_id"))
    )


def velocity_abuse(
    scored: DataFrame, threshold: int = VELOCITY_THRESHOLD, n: int = 25
) -> DataFrame:
    """Senders with more than `threshold` payments in an hour, fastest first."""
    return (
        scored.where(F.col("sender_txn_velocity_1h") > threshold)
        .groupBy("sender_vpa")
        .agg(
            F.max("sender_txn_velocity_1h").alias("max_1h_velocity"),
            F.count("*").alias("total_txns"),
            F.sum("fraud_flag").alias("fraud_flags"),
            F.sum("amount").cast(MONEY_SUM).alias("total_amount"),
        )
        .orderBy(F.desc("max_1h_velocity"), F.asc("sender_vpa"))
        .limit(n)
    )


def compound_risk(scored: DataFrame, min_amount: int = LARGE_AMOUNT) -> DataFrame:
    """Large payments to a new receiver from an unusual device, most probable first."""
    return (
        scored.where(
            (F.col("amount") > min_amount)
            & (F.col("is_new_receiver") == 1)
            & (F.col("device_mismatch") == 1)
        )
        .select(
            "txn_id",
            "timestamp",
            "sender_vpa",
            "receiver_vpa",
            "amount",
            "fraud_probability",
            "risk_tier",
        )
        .orderBy(F.desc("fraud_probability"), F.asc("txn_id"))
    )


def top_high_risk(scored: DataFrame, n: int = 5) -> DataFrame:
    """A short look at the HIGH payments."""
    return (
        scored.where(F.col("risk_tier") == "HIGH")
        .select("txn_id", "sender_vpa", "amount", "fraud_probability", "bank")
        .orderBy("txn_id")
        .limit(n)
    )
