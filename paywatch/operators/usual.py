"""Difference from a key's usual attribute: the value it used most often before."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paywatch.operators.heavy import (
    HeavyRule,
    busy_instants,
    heavy_keys,
    join_instants,
    split_heavy,
)
from paywatch.operators.running import running
from paywatch.operators.trailing import BUCKET

# "Usual" at time t: among the key's rows before t, the attribute with the most
# rows; of several, the one that reached that number last. A row without a time has
# no history and is none.


def with_uses(df: DataFrame, key: str, attribute: str, at: str, uses: str) -> DataFrame:
    """First half of the window form: the key's rows with this attribute up to each row."""
    so_far = (
        Window.partitionBy(key, attribute)
        .orderBy(at)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(uses, F.count(at).over(so_far))


def usual_of_uses(
    df: DataFrame, key: str, attribute: str, at: str, uses: str, out: str
) -> DataFrame:
    """Second half, in the order of the key and `at` alone."""
    before = (
        Window.partitionBy(key).orderBy(at).rangeBetween(Window.unboundedPreceding, -1)
    )
    standing = F.when(
        F.col(at).isNotNull(),
        F.struct(F.col(uses).alias("_uses"), F.col(at), F.col(attribute).alias("_attribute")),
    )
    return (
        df.withColumn("_usual", F.max(standing).over(before))
        .withColumn(out, _differs(attribute))
        .drop(uses, "_usual")
    )


def usual_windowed(df: DataFrame, key: str, attribute: str, at: str, out: str) -> DataFrame:
    """Window form; reuses a partitioning by `key`."""
    return usual_of_uses(with_uses(df, key, attribute, at, "_uses"), key, attribute, at, "_uses", out)


def _differs(attribute: str):
    known = F.col("_usual").isNotNull()
    same = F.col(attribute).eqNullSafe(F.col("_usual._attribute"))
    return (known & ~same).cast("int")


def usual_lookup(
    df: DataFrame, key: str, attribute: str, at: str, bucket: timedelta = BUCKET
) -> DataFrame:
    """Split form: the usual attribute at each (key, instant), from two bucketed
    running folds over combined instants."""
    length = bucket // timedelta(microseconds=1)
    instants = (
        df.where(F.col(at).isNotNull())
        .groupBy(
            F.col(key).alias("_key"),
            F.col(attribute).alias("_attribute"),
            F.col(at).alias("_when"),
        )
        .agg(F.count("*").alias("_uses"))
        .withColumn("_bucket", F.floor(F.col("_when") / F.lit(length)))
    )
    counted = running(
        instants, ["_key", "_attribute"], "_bucket", "_when", {"_uses": "sum"}, inclusive=True
    )
    standings = counted.groupBy("_key", "_bucket", "_when").agg(
        F.max(F.struct(F.col("_uses"), F.col("_when"), F.col("_attribute"))).alias("_usual")
    )
    return running(
        standings, ["_key"], "_bucket", "_when", {"_usual": "max"}, inclusive=False
    ).select("_key", "_when", "_usual")


def attach_usual(
    df: DataFrame,
    lookup: DataFrame,
    busy: DataFrame,
    key: str,
    attribute: str,
    at: str,
    out: str,
) -> DataFrame:
    joined = join_instants(df, lookup, busy, key, at)
    return joined.withColumn(out, _differs(attribute)).drop("_usual")


def add_usual_mismatch(
    df: DataFrame,
    key: str,
    attribute: str,
    at: str,
    out: str,
    rule: HeavyRule = HeavyRule(),
) -> DataFrame:
    """1 where the attribute differs from the key's usual one; 0 with no history."""
    ordinary, heavy = split_heavy(df, key, heavy_keys(df, key, rule))
    lookup = usual_lookup(heavy, key, attribute, at)
    busy = busy_instants(heavy, key, at, rule)
    return usual_windowed(ordinary, key, attribute, at, out).unionByName(
        attach_usual(heavy, lookup, busy, key, attribute, at, out)
    )
