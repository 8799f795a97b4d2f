"""First occurrence of a pair, in time order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paywatch.operators.heavy import HeavyRule, heavy_keys, split_heavy

#: Parts over which a heavy key's pair is spread.
SALTS = 256


def first_seen_windowed(
    df: DataFrame, key: str, other: str, at: str, row_id: str, out: str
) -> DataFrame:
    """Window form; reuses a partitioning by `key` alone."""
    order = Window.partitionBy(key, other).orderBy(at, row_id)
    return df.withColumn(out, (F.row_number().over(order) == 1).cast("int"))


def first_seen_split(
    df: DataFrame, key: str, other: str, at: str, row_id: str, out: str, salts: int = SALTS
) -> DataFrame:
    """Split form: the earliest row of each salted part of a pair, then the earliest of those.

    The first window spreads a pair over `salts` tasks. In the second, a pair's
    candidates meet, at most `salts` of them; all other rows stay spread.
    """
    parts = df.withColumn("_part", F.pmod(F.xxhash64(row_id, at), F.lit(salts)))
    within = Window.partitionBy(key, other, "_part").orderBy(at, row_id)
    leads = F.row_number().over(within) == 1
    marked = parts.withColumn("_lead", leads).withColumn(
        "_part", F.when(F.col("_lead"), F.lit(-1)).otherwise(F.col("_part"))
    )
    first = F.row_number().over(within) == 1
    return marked.withColumn(out, (F.col("_lead") & first).cast("int")).drop("_part", "_lead")


def add_first_seen(
    df: DataFrame,
    key: str,
    other: str,
    at: str,
    row_id: str,
    out: str,
    rule: HeavyRule = HeavyRule(),
) -> DataFrame:
    """1 on the first row of each (key, other) in the order of (at, row_id), else 0.

    Exactly one row of a pair gets 1, also where ids or times are null (null times
    come first) or repeat; of rows equal in both, any one.
    """
    ordinary, heavy = split_heavy(df, key, heavy_keys(df, key, rule))
    return first_seen_windowed(ordinary, key, other, at, row_id, out).unionByName(
        first_seen_split(heavy, key, other, at, row_id, out)
    )
