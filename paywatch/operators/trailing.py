"""Counts and sums over the time just before each row: [t - width, t) per key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paywatch.operators.heavy import (
    HeavyRule,
    busy_instants,
    heavy_keys,
    join_instants,
    split_heavy,
)
from paywatch.operators.running import running

# Window groups of a heavy key: at most this long. A bucket with too many instants is
# cut into PARTS: a quarter of a second has at most 250,000 distinct microseconds, each
# one narrow row, and one more per width, after rows of the same instant are combined.
BUCKET = timedelta(minutes=1)
PARTS = 240


@dataclass(frozen=True)
class Trailing:
    """The count and, if named, the exact sum of the value over a width."""

    width: timedelta
    count: str
    total: str | None = None

    @property
    def width_us(self) -> int:
        return self.width // timedelta(microseconds=1)


def trailing_windowed(
    df: DataFrame, key: str, at: str, value: str, specs: Sequence[Trailing]
) -> DataFrame:
    """Window form: one shuffle on `key`, linear in the rows.

    A sliding RANGE frame is evaluated anew for every row. The difference of two
    frames that both start at the beginning only ever adds rows, and is exact
    for counts and decimal sums.
    """

    def before(fold: Column, lag: int) -> Column:
        frame = Window.partitionBy(key).orderBy(at)
        return fold.over(frame.rangeBetween(Window.unboundedPreceding, -lag))

    added = {}
    for spec in specs:
        far = spec.width_us + 1
        number = F.count(value)
        added[spec.count] = before(number, 1) - before(number, far)
        if spec.total:
            total = F.sum(value)
            zero = F.lit(0).cast("decimal(25,2)")
            added[spec.total] = F.coalesce(before(total, 1), zero) - F.coalesce(
                before(total, far), zero
            )
    return df.withColumns(added)


def bucketed(events: DataFrame, length: int, rule: HeavyRule) -> DataFrame:
    """`_bucket`: where the range of `length` around `_when` starts, or the part of it
    where a key has more rows in that range than the rule's floor."""
    part = -(-length // PARTS)
    into = F.pmod(F.col("_when"), F.lit(length))
    marked = events.withColumn("_bucket", F.col("_when") - into)
    crowded = busy_instants(marked, "_key", "_bucket", rule).drop("_copies")
    same = F.col("_key").eqNullSafe(F.col("_busy_key")) & (F.col("_bucket") == F.col("_busy_at"))
    inner = F.when(F.col("_busy_at").isNotNull(), into - F.pmod(into, F.lit(part))).otherwise(0)
    return (
        marked.join(F.broadcast(crowded), same, "left")
        .withColumn("_bucket", F.col("_bucket") + inner)
        .drop("_busy_key", "_busy_at")
    )


def trailing_lookup(
    df: DataFrame,
    key: str,
    at: str,
    value: str,
    specs: Sequence[Trailing],
    bucket: timedelta = BUCKET,
    rule: HeavyRule = HeavyRule(),
) -> DataFrame:
    """Split form, for keys of any size: one row per (key, instant) to join back.

    Rows of one instant are combined first. An instant adds its count and sum at
    `at` and takes them away again at `at + width`, so the trailing value is the
    running total of these changes before the row. Buckets with more changes than
    the rule's floor are cut into parts; their list is bounded like the heavy keys.
    """
    instants = df.groupBy(key, at).agg(
        F.count(value).alias("_n"), F.coalesce(F.sum(value), F.lit(0)).alias("_s")
    )

    measured = [(i, f"_n{i}", "_n", "bigint") for i in range(len(specs))]
    measured += [(i, f"_s{i}", "_s", "decimal(38,2)") for i, spec in enumerate(specs) if spec.total]

    def change(when: Column, leaving: int | None) -> Column:
        parts = []
        for i, name, source, kind in measured:
            if leaving is None:
                amount = F.col(source)
            elif i == leaving:
                amount = -F.col(source)
            else:
                amount = F.lit(0)
            parts.append(amount.cast(kind).alias(name))
        return F.struct(when.alias("_when"), F.lit(leaving is None).alias("_arrives"), *parts)

    changes = [change(F.col(at), None)] + [
        change(F.col(at) + F.lit(spec.width_us), i) for i, spec in enumerate(specs)
    ]
    length = bucket // timedelta(microseconds=1)
    events = instants.select(F.col(key).alias("_key"), F.inline(F.array(*changes)))
    events = bucketed(events, length, rule)

    sums = {name: "sum" for _, name, _, _ in measured}
    folded = running(events, ["_key"], "_bucket", "_when", sums, inclusive=False)
    named = [
        F.col(name).cast("bigint" if source == "_n" else "decimal(26,2)").alias(
            specs[i].count if source == "_n" else specs[i].total
        )
        for i, name, source, _ in measured
    ]
    return folded.where("_arrives").select("_key", "_when", *named)


def attach_trailing(
    df: DataFrame,
    lookup: DataFrame,
    busy: DataFrame,
    key: str,
    at: str,
    specs: Sequence[Trailing],
) -> DataFrame:
    """Join the lookup to the rows, zero where it has none."""
    names = [spec.count for spec in specs] + [spec.total for spec in specs if spec.total]
    zero = {
        name: F.coalesce(F.col(name), F.lit(0).cast(lookup.schema[name].dataType))
        for name in names
    }
    return join_instants(df, lookup, busy, key, at).withColumns(zero)


def add_trailing(
    df: DataFrame,
    key: str,
    at: str,
    value: str,
    specs: Sequence[Trailing],
    rule: HeavyRule = HeavyRule(),
) -> DataFrame:
    """Trailing counts and sums for every row; rows at the same instant do not count.

    `at` is an integer column of microseconds, see `functions.micros`.
    """
    ordinary, heavy = split_heavy(df, key, heavy_keys(df, key, rule))
    lookup = trailing_lookup(heavy, key, at, value, specs, rule=rule)
    return trailing_windowed(ordinary, key, at, value, specs).unionByName(
        attach_trailing(heavy, lookup, busy_instants(heavy, key, at, rule), key, at, specs)
    )
