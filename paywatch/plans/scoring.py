"""Fraud probability, flag and risk tier per transaction. No shuffle in any of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywatch.functions import rate_pct
from paywatch.plans.decision import DEFAULT_THRESHOLD, decided, with_risk
from paywatch.schema import FEATURE_COLUMNS

# What `rule_score` reads of the derived features.
RULE_INPUTS = ("is_new_receiver", "is_night_txn")


def require_columns(df: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS) -> None:
    """Fail before any job runs, naming what is missing."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"Missing feature columns: {missing}")


def rule_score(features: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """A deterministic score from five signals, for use without a trained model."""
    points = (
        F.col("device_mismatch") * 35
        + F.col("geo_anomaly") * 25
        + F.col("is_new_receiver") * 10
        + F.when(F.col("amount") > 50000, 20).otherwise(0)
        + F.col("is_night_txn") * 10
    )
    return with_risk(features, points.cast("double") / F.lit(100.0), threshold)


def score(
    features: DataFrame, model: PipelineModel, threshold: float | None = None
) -> DataFrame:
    """Score with a fitted model, by the threshold that came with it unless one is given;
    works on batch and streaming frames alike."""
    require_columns(features)
    return decided(features, model, threshold).select(
        *features.columns, "fraud_probability", "fraud_flag", "risk_tier"
    )


def scoring_summary(scored: DataFrame) -> DataFrame:
    """Rows scored, rows flagged, their share and the size of each tier."""

    def tier(name: str) -> Column:
        return F.count(F.when(F.col("risk_tier") == name, 1))

    return scored.agg(
        F.count("*").alias("records_scored"),
        F.sum("fraud_flag").alias("flagged"),
        rate_pct(F.sum("fraud_flag"), F.count("*"), 2).alias("flagged_pct"),
        tier("HIGH").alias("high_risk"),
        tier("MEDIUM").alias("medium_risk"),
        tier("LOW").alias("low_risk"),
    )
