"""Results over a complete domain: every day of a range, every member of a list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def fill_days(daily: DataFrame, day: str, *values: str) -> DataFrame:
    """Add the missing days between the first and the last, with 0 in `values`.

    `daily` holds one row per day, so the window is as small as the calendar. Each day
    brings the empty days up to the next one, so the input is read once. Rows without
    a day are left out.
    """
    known = daily.where(F.col(day).isNotNull())
    following = F.coalesce(F.date_sub(F.lead(day).over(Window.orderBy(day)), 1), F.col(day))
    names = [name for name in daily.columns if name != day]
    rows = known.withColumn("_last", following).select(
        F.col(day).alias("_day"), *names, F.explode(F.sequence(F.col(day), F.col("_last"))).alias(day)
    )
    came = F.col(day) == F.col("_day")
    kept = {name: F.when(came, F.col(name)) for name in names}
    kept |= {name: F.coalesce(kept[name], F.lit(0).cast(daily.schema[name].dataType)) for name in values}
    return rows.withColumns(kept).select(day, *names)


def dense_domain(df: DataFrame, column: str, members: Sequence[str]) -> DataFrame:
    """One row per member in the given order, null values where `df` has none.

    `_position` holds the order.
    """
    listed = df.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(member) for member in members])).alias("_position", column)
    )
    return listed.join(df, column, "left")
