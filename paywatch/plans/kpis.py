"""Monitoring queries over the scored table.

"Fraud" here means flagged by the score, except where the name says label.
All groupings combine before the shuffle, so a dominant group costs nothing extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paywatch.functions import rate_pct, round_half_up, rounded_quotient
from paywatch.operators.daily import dense_domain, fill_days

TIERS = ["HIGH", "MEDIUM", "LOW"]
MONEY_SUM = "decimal(25,2)"


def has_flag(value: int) -> Column:
    return F.col("fraud_flag") == value


def flagged_amount(when_none: int | None) -> Column:
    """Sum of the flagged amounts; 0 or null where nothing is flagged."""
    zero = F.lit(when_none).cast("decimal(15,2)")
    return F.sum(F.when(has_flag(1), F.col("amount")).otherwise(zero)).cast(MONEY_SUM)


def mean_amount(condition: Column | None = None) -> Column:
    """Mean amount to two digits, from the exact sum."""
    amount = F.col("amount") if condition is None else F.when(condition, F.col("amount"))
    cents = (F.sum(amount) * 100).cast("decimal(38,0)")
    return rounded_quotient(cents, F.count(amount) * 100, 2)


def flagged_pct(digits: int) -> Column:
    return rate_pct(F.sum("fraud_flag"), F.count("*"), digits)


def overall_kpis(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count("*").alias("total_transactions"),
        F.sum("fraud_flag").alias("flagged_transactions"),
        flagged_pct(2).alias("fraud_rate_pct"),
        flagged_amount(0).alias("flagged_amount"),
        mean_amount(has_flag(1)).alias("avg_fraud_ticket_size"),
        mean_amount(has_flag(0)).alias("avg_legit_ticket_size"),
    )


def daily_trend(scored: DataFrame) -> DataFrame:
    return (
        scored.groupBy(F.to_date("timestamp").alias("txn_date"))
        .agg(
            F.count("*").alias("total_txns"),
            F.sum("fraud_flag").alias("fraud_txns"),
            flagged_pct(3).alias("daily_fraud_rate_pct"),
            flagged_amount(0).alias("fraud_amount"),
        )
        .orderBy("txn_date")
    )


def tier_breakdown(scored: DataFrame) -> DataFrame:
    """Per tier; `confirmed_fraud` counts flags, not labels."""
    mean = F.avg("fraud_probability") * 100
    place = F.when(F.col("risk_tier") == "HIGH", 1).when(F.col("risk_tier") == "MEDIUM", 2)
    return (
        scored.groupBy("risk_tier")
        .agg(
            F.count("*").alias("txn_count"),
            F.sum("fraud_flag").alias("confirmed_fraud"),
            round_half_up(mean, 2).alias("avg_fraud_prob_pct"),
            F.sum("amount").cast(MONEY_SUM).alias("total_amount_at_risk"),
        )
        .orderBy(place.otherwise(3))
    )


def tier_counts(scored: DataFrame) -> DataFrame:
    """The three tiers in fixed order, null where a tier is empty."""
    counts = scored.groupBy("risk_tier").agg(F.count("*").alias("txn_count"))
    return dense_domain(counts, "risk_tier", TIERS).orderBy("_position").drop("_position")


def top_senders(scored: DataFrame, n: int = 10) -> DataFrame:
    """Senders with the most flagged payments; equal counts are ordered by name."""
    return (
        scored.groupBy("sender_vpa")
        .agg(
            F.count("*").alias("total_txns"),
            F.sum("fraud_flag").alias("fraud_txns"),
            flagged_pct(1).alias("fraud_rate_pct"),
            flagged_amount(None).alias("total_fraud_amount"),
        )
        .where(F.col("fraud_txns") > 0)
        .orderBy(F.desc("fraud_txns"), F.asc("sender_vpa"))
        .limit(n)
    )


def fraud_by(
    scored: DataFrame,
    key: str,
    digits: int = 2,
    rows: str = "total_txns",
    flagged: str = "fraud_txns",
    name: str | None = None,
    **more: Column,
) -> DataFrame:
    """Rows, flagged rows and their rate per value of `key`, plus `more` aggregates."""
    return scored.groupBy(F.col(key).alias(name or key)).agg(
        F.count("*").alias(rows),
        F.sum("fraud_flag").alias(flagged),
        flagged_pct(digits).alias("fraud_rate_pct"),
        *[column.alias(label) for label, column in more.items()],
    )


def fraud_by_bank(scored: DataFrame) -> DataFrame:
    grouped = fraud_by(scored, "bank", fraud_exposure=flagged_amount(0))
    return grouped.orderBy(F.desc("fraud_rate_pct"), F.asc("bank"))


def fraud_by_hour(scored: DataFrame) -> DataFrame:
    return fraud_by(scored, "txn_hour", digits=3, name="hour_of_day").orderBy("hour_of_day")


def fraud_by_app(scored: DataFrame) -> DataFrame:
    return fraud_by(scored, "app_name").orderBy(F.desc("fraud_txns"), F.asc("app_name"))


def fraud_by_device_mismatch(scored: DataFrame) -> DataFrame:
    return fraud_by(scored, "device_mismatch", rows="txn_count", flagged="fraud_count")


def fraud_by_geo_anomaly(scored: DataFrame) -> DataFrame:
    return fraud_by(
        scored, "geo_anomaly", rows="txn_count", flagged="fraud_count", avg_amount=mean_amount()
    )


def fraud_by_new_receiver(scored: DataFrame) -> DataFrame:
    return fraud_by(scored, "is_new_receiver", rows="txn_count", flagged="fraud_count")


def weekly_rate(scored: DataFrame) -> DataFrame:
    """Calendar weeks from Monday."""
    week = F.date_trunc("week", F.col("timestamp")).cast("timestamp_ntz")
    return (
        scored.groupBy(week.alias("week_start"))
        .agg(
            F.count("*").alias("weekly_txns"),
            F.sum("fraud_flag").alias("weekly_fraud"),
            flagged_pct(3).alias("weekly_fraud_rate_pct"),
        )
        .orderBy("week_start")
    )


def rolling_rate(scored: DataFrame, days: int = 7) -> DataFrame:
    """The rate over each day and the days before it, `days` in all."""
    daily = scored.groupBy(F.to_date("timestamp").alias("txn_date")).agg(
        F.count("*").alias("_txns"), F.sum("fraud_flag").alias("_fraud")
    )
    # One row per day by now, so a single window group is as small as a calendar.
    recent = Window.orderBy(F.unix_date("txn_date")).rangeBetween(1 - days, 0)
    return daily.select(
        "txn_date",
        F.sum("_txns").over(recent).alias(f"txns_{days}d"),
        F.sum("_fraud").over(recent).alias(f"fraud_{days}d"),
        rate_pct(F.sum("_fraud").over(recent), F.sum("_txns").over(recent), 3).alias(
            f"fraud_rate_{days}d_pct"
        ),
    ).orderBy("txn_date")


def class_contrast(scored: DataFrame) -> DataFrame:
    """Means of a few columns for labelled fraud against the rest."""

    def mean(column: str, label: int, factor: float = 1.0, digits: int = 2) -> Column:
        value = F.when(F.col("is_fraud") == label, F.col(column))
        average = F.try_divide(F.sum(value).cast("double"), F.count(value))
        return round_half_up(average * F.lit(factor), digits)

    return scored.agg(
        mean("txn_hour", 1).alias("fraud_avg_hour"),
        mean("txn_hour", 0).alias("legit_avg_hour"),
        mean("amount", 1).alias("fraud_avg_amount"),
        mean("amount", 0).alias("legit_avg_amount"),
        mean("sender_txn_velocity_24h", 1).alias("fraud_avg_velocity_24h"),
        mean("sender_txn_velocity_24h", 0).alias("legit_avg_velocity_24h"),
        mean("device_mismatch", 1, 100.0, 1).alias("fraud_device_mismatch_pct"),
        mean("device_mismatch", 0, 100.0, 1).alias("legit_device_mismatch_pct"),
    )


def kpi_snapshot(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count("*").alias("total"),
        F.sum("fraud_flag").alias("flagged"),
        flagged_pct(2).alias("fraud_rate"),
        mean_amount(has_flag(1)).alias("avg_ticket"),
        F.count(F.when(F.col("risk_tier") == "HIGH", 1)).alias("high_risk"),
    )


def daily_flagged(scored: DataFrame) -> DataFrame:
    """Flagged payments per day, quiet and missing days included."""
    daily = scored.groupBy(F.to_date("timestamp").alias("txn_date")).agg(
        F.sum("fraud_flag").alias("flagged")
    )
    return fill_days(daily, "txn_date", "flagged").orderBy("txn_date")
