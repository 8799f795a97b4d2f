"""Running totals whose groups may be larger than one task can take."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FOLDS = {"sum": F.sum, "max": F.max}


def running(
    events: DataFrame,
    keys: list[str],
    bucket: str,
    at: str,
    measures: Mapping[str, str],
    inclusive: bool,
    widths: Sequence[int] = (),
) -> DataFrame:
    """Fold each measure over the rows of the same keys up to `at`.

    measures   column -> "sum" or "max"; the result replaces the column.
    bucket     splits a group into consecutive ranges of `at`; must never
               decrease as `at` grows. Each (keys, bucket) is one window group.
    inclusive  True: rows at the same `at` count; False: strictly before
               (`at` then has to be an integer type).
    widths     where the buckets of one group are too many for a task: widths, in
               units of an integer `bucket`, of ever coarser buckets. Totals are
               then folded within each coarser bucket and over the coarsest.

    The buckets before a row are not read again: each bucket's total is taken
    with a combining aggregate, the totals are folded over the buckets of the
    keys (one row per bucket), level by level, and the outcome enters the bucket as one more row
    in front of it. `at` of the events must not be null.
    """
    totals = events.groupBy(*keys, bucket).agg(
        *[FOLDS[how](name).alias(name) for name, how in measures.items()]
    )
    if widths:
        above = f"{bucket}_above"
        coarser = totals.withColumn(above, F.col(bucket) - F.pmod(F.col(bucket), F.lit(widths[0])))
        carried = running(coarser, keys, above, bucket, measures, False, widths[1:])
        carried = carried.select(*keys, bucket, *measures)
    else:
        earlier = (
            Window.partitionBy(*keys)
            .orderBy(bucket)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carried = totals.select(
            *keys,
            bucket,
            *[FOLDS[how](name).over(earlier).alias(name) for name, how in measures.items()],
        )
    # Null sorts first, so the carried row is in every frame of its bucket.
    together = events.unionByName(carried, allowMissingColumns=True)
    frame = (
        Window.partitionBy(*keys, bucket)
        .orderBy(F.col(at).asc_nulls_first())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    )
    folded = {name: FOLDS[how](name).over(frame) for name, how in measures.items()}
    return together.withColumns(folded).where(F.col(at).isNotNull())
