"""How unusual a value is for its key: z-score over the key's whole history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paywatch.operators.heavy import HeavyRule, heavy_keys, split_heavy

# Fixed value: z-scores are cut to this range on both sides.
ZSCORE_LIMIT = 10.0


def _statistics(value: str) -> dict[str, Column]:
    number = F.col(value).cast("double")
    return {
        "_total": F.sum(value),
        "_number": F.count(value),
        "_deviation": F.stddev_samp(number),
        "_low": F.min(value),
        "_high": F.max(value),
    }


def _zscore(value: str) -> Column:
    mean = F.try_divide(F.col("_total").cast("double"), F.col("_number"))
    spread = F.coalesce(F.nullif(F.col("_deviation"), F.lit(0.0)), F.lit(1.0))
    score = (F.col(value).cast("double") - mean) / spread
    cut = F.least(F.greatest(score, F.lit(-ZSCORE_LIMIT)), F.lit(ZSCORE_LIMIT))
    # Equal values are at their mean, whatever rounding makes of it; greatest and
    # least skip nulls, but a row without a value has no score.
    differ = F.col("_low") < F.col("_high")
    return F.when(score.isNotNull(), F.when(differ, cut).otherwise(F.lit(0.0)))


def zscore_windowed(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Window form; reuses a partitioning by `key`."""
    group = Window.partitionBy(key)
    stats = {name: agg.over(group) for name, agg in _statistics(value).items()}
    return df.withColumns(stats).withColumn(out, _zscore(value)).drop(*stats)


def zscore_lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    """Join form: one combined row per key."""
    return df.groupBy(F.col(key).alias("_key")).agg(
        *[agg.alias(name) for name, agg in _statistics(value).items()]
    )


def attach_zscore(df: DataFrame, lookup: DataFrame, key: str, value: str, out: str) -> DataFrame:
    return (
        df.join(lookup, F.col(key).eqNullSafe(F.col("_key")), "left")
        .withColumn(out, _zscore(value))
        .drop("_key", *_statistics(value))
    )


def add_zscore(
    df: DataFrame, key: str, value: str, out: str, rule: HeavyRule = HeavyRule()
) -> DataFrame:
    """(value - mean) / sample deviation within the key, cut to ±10."""
    ordinary, heavy = split_heavy(df, key, heavy_keys(df, key, rule))
    # One row per heavy key: the bound of the rule makes this small.
    lookup = F.broadcast(zscore_lookup(heavy, key, value))
    return zscore_windowed(ordinary, key, value, out).unionByName(
        attach_zscore(heavy, lookup, key, value, out)
    )
