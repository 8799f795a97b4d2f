"""Equal-width histograms."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywatch.functions import present


def histogram(
    df: DataFrame,
    value: Column,
    bins: int,
    classes: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(class, bin, lower_edge, count) with every bin present, also the empty ones.

    Each class has its own range, from its smallest to its largest value; the
    last bin is closed on both sides; null and NaN are in none. `classes` maps a name to the condition
    that selects it, and the conditions exclude each other.

    The ranges are one combined row, handed to the second pass as a subquery, so
    no row is shuffled: only bin counts are. `df` is read twice: pass a stored
    table, not one that is expensive to derive.
    """
    classes = classes or {"all": F.lit(True)}
    names = list(classes)
    pairs = df.select(
        F.coalesce(*[F.when(test, F.lit(name)) for name, test in classes.items()]).alias("class"),
        present(value).alias("_x"),
    ).where(F.col("class").isNotNull() & F.col("_x").isNotNull())

    def widened(name: str) -> Column:
        mine = F.when(F.col("class") == name, F.col("_x"))
        low, high = F.min(mine), F.max(mine)
        # One single value: a range of width 1 around it.
        half = F.when(low == high, F.lit(0.5)).otherwise(F.lit(0.0))
        return F.struct((low - half).alias("low"), (high + half).alias("high"))

    ranges = pairs.agg(*[widened(name).alias(name) for name in names])
    as_map = F.create_map(*[part for name in names for part in (F.lit(name), F.col(name))])
    looked_up = ranges.select(as_map).scalar()[F.col("class")]

    x, low, high = F.col("_x"), F.col("_range.low"), F.col("_range.high")
    position = F.floor(F.lit(float(bins)) * (x - low) / (high - low)).cast("int")
    counts = (
        pairs.withColumn("_range", looked_up)
        .groupBy("class", F.least(position, F.lit(bins - 1)).alias("bin"))
        .agg(F.count("*").alias("count"))
    )
    edge = low + F.col("bin") * (high - low) / F.lit(float(bins))
    spine = (
        ranges.select(F.explode(as_map).alias("class", "_range"))
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .select("class", "bin", edge.alias("lower_edge"))
    )
    return spine.join(counts, ["class", "bin"], "left").select(
        "class",
        "bin",
        "lower_edge",
        F.coalesce(F.col("count"), F.lit(0).cast("bigint")).alias("count"),
    )
