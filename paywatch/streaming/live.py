"""Streaming counterparts of the monitoring queries.

Every one is a windowed or keyed aggregate: rows combine before the shuffle and
the state is one row per group, so a dominant sender is no larger than any other;
for the velocity alerts `windows` sees to it.
Rows later than the watermark are dropped. Event time is read as UTC in
every session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywatch.functions import micros, rate_pct
from paywatch.plans.kpis import flagged_amount, flagged_pct
from paywatch.plans.operations import VELOCITY_THRESHOLD
from paywatch.streaming.windows import busy_windows

# Windows count from Thursday, 1970-01-01; weeks start four days later, on Monday.
MONDAY = "4 days"


def _timed(stream: DataFrame, delay: str) -> DataFrame:
    event_time = F.timestamp_micros(micros(F.col("timestamp")))
    return stream.withColumn("_event_time", event_time).withWatermark("_event_time", delay)


def _ntz(column: str | Column) -> Column:
    """The wall-clock time in UTC, whatever the session's zone."""
    time = F.col(column) if isinstance(column, str) else column
    seconds = (F.unix_micros(time).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def daily_trend_stream(scored: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The daily trend; a day comes out once the watermark has passed it."""
    return (
        _timed(scored, delay)
        .groupBy(F.window("_event_time", "1 day"))
        .agg(
            F.count("*").alias("total_txns"),
            F.sum("fraud_flag").alias("fraud_txns"),
            flagged_pct(3).alias("daily_fraud_rate_pct"),
            flagged_amount(0).alias("fraud_amount"),
        )
        .withColumn("txn_date", F.to_date(_ntz("window.start")))
        .select("txn_date", "total_txns", "fraud_txns", "daily_fraud_rate_pct", "fraud_amount")
    )


def weekly_rate_stream(scored: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Calendar weeks from Monday."""
    return (
        _timed(scored, delay)
        .groupBy(F.window("_event_time", "7 days", startTime=MONDAY))
        .agg(
            F.count("*").alias("weekly_txns"),
            F.sum("fraud_flag").alias("weekly_fraud"),
            flagged_pct(3).alias("weekly_fraud_rate_pct"),
        )
        .select(
            _ntz("window.start").alias("week_start"),
            "weekly_txns",
            "weekly_fraud",
            "weekly_fraud_rate_pct",
        )
    )


def rolling_rate_stream(scored: DataFrame, days: int = 7, delay: str = "1 hour") -> DataFrame:
    """The rate over `days` days, moving by one day. Also has the windows that
    begin before the first payment."""
    return (
        _timed(scored, delay)
        .groupBy(F.window("_event_time", f"{days} days", "1 day"))
        .agg(
            F.count("*").alias(f"txns_{days}d"),
            F.sum("fraud_flag").alias(f"fraud_{days}d"),
            rate_pct(F.sum("fraud_flag"), F.count("*"), 3).alias(f"fraud_rate_{days}d_pct"),
        )
        .select(
            F.date_sub(F.to_date(_ntz("window.end")), 1).alias("txn_date"),
            f"txns_{days}d",
            f"fraud_{days}d",
            f"fraud_rate_{days}d_pct",
        )
    )


def velocity_alerts_stream(
    transactions: DataFrame,
    threshold: int = VELOCITY_THRESHOLD,
    width: str = "1 hour",
    step: str = "5 minutes",
    delay: str = "10 minutes",
) -> DataFrame:
    """Senders with more than `threshold` payments in a window of `width`.

    The session's state store is set to RocksDB, the one that keeps keyed state with timers."""
    busy = busy_windows(transactions, threshold, width, step, delay)
    return busy.select(
        _ntz(F.timestamp_micros("start")).alias("window_start"),
        _ntz(F.timestamp_micros("end")).alias("window_end"),
        "sender_vpa",
        "txns",
    )


def first_payments_stream(transactions: DataFrame) -> DataFrame:
    """The earliest payment of each (sender, receiver) seen so far; for update mode.

    The state is one row per pair and stays, as "never before" needs it to.
    """
    return (
        transactions.groupBy("sender_vpa", "receiver_vpa")
        .agg(F.min(F.struct("timestamp", "txn_id")).alias("_first"))
        .select("sender_vpa", "receiver_vpa", "_first.timestamp", "_first.txn_id")
    )


def new_pairs_stream(transactions: DataFrame, memory: str = "30 days") -> DataFrame:
    """(sender, receiver) pairs not seen within `memory` before; for append mode.

    The bounded form of `first_payments_stream`: a pair's state goes once the watermark
    has passed its first payment by `memory`, so the state holds the pairs of that time
    only. A pair that comes again after it counts as new once more.
    """
    return (
        _timed(transactions, memory)
        .dropDuplicatesWithinWatermark(["sender_vpa", "receiver_vpa"])
        .select("sender_vpa", "receiver_vpa")
    )
