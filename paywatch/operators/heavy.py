"""Heavy keys: the few keys that hold too many rows for one task.

A window over `partitionBy(key)` puts a whole key into one task. That is the
cheapest plan for ordinary keys (one shuffle, shared by all windows on the key)
and unusable for a key with a third of the table. Keyed operators therefore come
in two forms: a window form for ordinary keys and a split form for heavy ones,
built from aggregates that combine before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class HeavyRule:
    """The `most` largest keys of more than `floor` rows are heavy.

    `most` bounds the list whatever the table holds, so it is safe to broadcast.
    A key outside the list has at most max(floor, rows / most) rows: with the
    defaults ten million, up to a table of 10^12 rows. One window group of that
    size sorts within a task.
    """

    floor: int = 10_000_000
    most: int = 100_000


def heavy_keys(df: DataFrame, key: str, rule: HeavyRule = HeavyRule()) -> DataFrame:
    """One row per heavy key, in column `_heavy`; never more than `rule.most`."""
    return (
        df.groupBy(F.col(key).alias("_heavy"))
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > rule.floor)
        .orderBy(F.desc("_rows"), F.asc("_heavy"))
        .limit(rule.most)
        .select("_heavy")
    )


def is_key(key: str) -> Column:
    return F.col(key).eqNullSafe(F.col("_heavy"))


def split_heavy(df: DataFrame, key: str, heavy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of heavy keys).

    With no heavy keys the broadcast is empty and AQE removes the second branch
    before it starts.
    """
    listed = F.broadcast(heavy)
    return df.join(listed, is_key(key), "left_anti"), df.join(listed, is_key(key), "left_semi")


def busy_instants(df: DataFrame, key: str, at: str, rule: HeavyRule = HeavyRule()) -> DataFrame:
    """(_busy_key, _busy_at, _copies) of the instants of a key with many rows.

    Bounded like the heavy keys; `_copies` is the number of parts to spread over.
    """
    part = max(rule.floor, 1)
    return (
        df.groupBy(F.col(key).alias("_busy_key"), F.col(at).alias("_busy_at"))
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > part)
        .orderBy(F.desc("_rows"), F.asc("_busy_key"), F.asc("_busy_at"))
        .limit(rule.most)
        .select("_busy_key", "_busy_at", F.ceil(F.col("_rows") / part).alias("_copies"))
    )


def join_instants(
    df: DataFrame, lookup: DataFrame, busy: DataFrame, key: str, at: str
) -> DataFrame:
    """Left join a lookup with one row per (_key, _when).

    A busy instant is salted: its rows go to several tasks, by a hash of the row
    so that a repeated task sends them the same way, and its lookup row to each.
    """
    listed = F.broadcast(busy)

    def with_copies(side: DataFrame, side_key: str, side_at: str) -> DataFrame:
        same = F.col(side_key).eqNullSafe(F.col("_busy_key")) & (
            F.col(side_at) == F.col("_busy_at")
        )
        copies = F.coalesce(F.col("_copies"), F.lit(1).cast("bigint"))
        return side.join(listed, same, "left").withColumn("_copies", copies)

    spread = with_copies(df, key, at).withColumn(
        "_salt", F.pmod(F.xxhash64(*df.columns), F.col("_copies"))
    )
    repeated = with_copies(lookup, "_key", "_when").select(
        *lookup.columns, F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("_copy")
    )
    same = (
        F.col(key).eqNullSafe(F.col("_key"))
        & (F.col(at) == F.col("_when"))
        & (F.col("_salt") == F.col("_copy"))
    )
    return spread.drop("_busy_key", "_busy_at", "_copies").join(repeated, same, "left").drop(
        "_key", "_when", "_salt", "_copy"
    )
