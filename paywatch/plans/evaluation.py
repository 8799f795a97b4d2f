"""Measures of a binary score: curves, areas, confusion, threshold choice.

Ranking measures need running totals over all rows in score order. Rows with
equal scores are combined first; the distinct scores are then cut into buckets
of nearly equal size at their quantiles, so that no single task sees them all,
wherever the scores crowd together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paywatch.functions import present, ratio
from paywatch.operators.running import running
from paywatch.schema import LABEL, REPORT
from paywatch.session import materialize

SCORE = "fraud_probability"

# 80 thresholds, evenly from 0.1 to 0.9.
SWEEP_GRID = tuple(0.1 + i * 0.8 / 79 for i in range(80))
DEFAULT_THRESHOLD = 0.5

# Size of a bucket of distinct scores; the most buckets cut at once; and into how many
# each is cut again, as often as it takes, where these are still too large.
SCORES_PER_BUCKET = 1_000_000
MOST_CUTS = 16_384
FAN = 64


def _bucketed(df: DataFrame, score: str, edges: Sequence[float], out: str) -> DataFrame:
    """Number of edges at or below the score."""
    if not edges:
        return df.withColumn(out, F.lit(0))
    splits = [float("-inf"), *edges, float("inf")]
    marked = Bucketizer(splits=splits, inputCol=score, outputCol=out).transform(df)
    return marked.withColumn(out, F.col(out).cast("int"))


def _labelled(df: DataFrame, score: str, label: str) -> DataFrame:
    """(score, pos, neg) per row with a label. A missing score counts as 0."""
    actual = F.col(label) == 1
    return df.where(F.col(label).isNotNull()).select(
        F.coalesce(present(F.col(score)), F.lit(0.0)).alias("score"),
        actual.cast("bigint").alias("pos"),
        (~actual).cast("bigint").alias("neg"),
    )


def score_counts(df: DataFrame, score: str = SCORE, label: str = LABEL) -> DataFrame:
    """Positives and negatives per distinct score."""
    rows = _labelled(df, score, label)
    return rows.groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def curve(
    df: DataFrame,
    score: str = SCORE,
    label: str = LABEL,
    buckets: int | None = None,
    size: int = SCORES_PER_BUCKET,
    most: int = MOST_CUTS,
    fan: int = FAN,
) -> DataFrame:
    """(score, pos, neg, tp, fp) per distinct score: tp and fp count the rows with
    this score or a higher one.

    `buckets` follows from the number of distinct scores and the `size` of a bucket. Beyond
    `most`, each bucket is cut again into `fan`, until they are small enough, so no task
    takes more than about `size` scores or `most` totals, however many there are.
    """
    counts = materialize(score_counts(df, score, label), "score-counts")
    return _curve_of(counts, buckets, size, most, fan)


def _banded(counts: DataFrame, buckets: int, most: int, fan: int) -> tuple[DataFrame, list[int]]:
    """`counts` with the bucket of each score in `_band`, and the widths of its coarser buckets."""
    there = min(most, buckets)
    shares = [i / there for i in range(1, there)]
    cuts = counts.approxQuantile("score", shares, 1 / (4 * there)) if shares else []
    banded = _bucketed(counts, "score", sorted(set(cuts)), "_band")
    banded = banded.withColumn("_band", F.col("_band").cast("bigint"))
    widths = []
    while there < buckets:
        inner = F.percentile_approx("score", [i / fan for i in range(1, fan)], 4 * fan)
        inside = banded.groupBy("_band").agg(inner.alias("_cuts"))
        if not widths:
            inside = F.broadcast(inside)  # at most `most` rows of `fan` numbers
        passed = F.size(F.filter("_cuts", lambda cut: cut < F.col("score")))
        banded = banded.join(inside, "_band").withColumn("_band", F.col("_band") * fan + passed)
        banded = banded.drop("_cuts")
        there *= fan
        widths.append(fan ** (len(widths) + 1))
    return banded, widths


def _curve_of(
    counts: DataFrame,
    buckets: int | None = None,
    size: int = SCORES_PER_BUCKET,
    most: int = MOST_CUTS,
    fan: int = FAN,
) -> DataFrame:
    if buckets is None:
        buckets = 1 + counts.count() // size
    banded, widths = _banded(counts, buckets, most, fan)
    events = banded.select(
        "score",
        "pos",
        "neg",
        F.col("pos").alias("tp"),
        F.col("neg").alias("fp"),
        (-F.col("_band")).alias("_band"),
        (-F.col("score")).alias("_falling"),
    )
    totals = running(
        events, [], "_band", "_falling", {"tp": "sum", "fp": "sum"}, inclusive=True, widths=widths
    )
    return totals.select("score", "pos", "neg", "tp", "fp")


def _areas(points: DataFrame) -> DataFrame:
    """All ranking measures from one aggregate over the curve.

    Every term needs only its own row: the point before has tp - pos and fp - neg.
    """
    pos, neg, tp, fp = (F.col(name).cast("double") for name in ("pos", "neg", "tp", "fp"))
    precision = F.try_divide(tp, tp + fp)
    precision_before = F.coalesce(F.try_divide(tp - pos, tp - pos + fp - neg), F.lit(1.0))
    sums = points.agg(
        F.sum("pos").cast("double").alias("p"),
        F.sum("neg").cast("double").alias("n"),
        F.sum(pos * (fp - neg / 2)).alias("outranked"),
        F.sum(pos * precision).alias("step"),
        F.sum(pos * (precision + precision_before) / 2).alias("trapezoid"),
    )
    p, n = F.col("p"), F.col("n")
    return sums.select(
        # A positive is outranked by the negatives above it, half of those beside it.
        (F.lit(1.0) - F.try_divide("outranked", p * n)).alias("roc_auc"),
        F.try_divide("step", p).alias("average_precision"),
        F.try_divide("trapezoid", p).alias("pr_auc"),
    )


def ranking_measures(df: DataFrame, score: str = SCORE, label: str = LABEL) -> DataFrame:
    """One row: roc_auc, average_precision (steps), pr_auc (trapezoids). Exact."""
    return _areas(curve(df, score, label))


def roc_points(df: DataFrame, score: str = SCORE, label: str = LABEL) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score."""
    return _rates(curve(df, score, label)).select("threshold", "fpr", "tpr")


def pr_points(df: DataFrame, score: str = SCORE, label: str = LABEL) -> DataFrame:
    """(threshold, precision, recall) per distinct score."""
    return _rates(curve(df, score, label)).select("threshold", "precision", "recall")


def _rates(points: DataFrame) -> DataFrame:
    whole = points.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    whole = whole.select(F.struct("p", "n")).scalar()
    tp, fp = F.col("tp"), F.col("fp")
    return points.withColumn("_whole", whole).select(
        F.col("score").alias("threshold"),
        ratio(fp, F.col("_whole.n")).alias("fpr"),
        ratio(tp, F.col("_whole.p")).alias("tpr"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, F.col("_whole.p")).alias("recall"),
    )


def _threshold_measures(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """Precision, recall and F1, each 0 where it is undefined."""
    zero = F.lit(0.0)
    return {
        "precision": F.coalesce(ratio(tp, tp + fp), zero),
        "recall": F.coalesce(ratio(tp, tp + fn), zero),
        "f1": F.coalesce(ratio(tp * 2, tp * 2 + fp + fn), zero),
    }


def confusion(
    df: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    score: str = SCORE,
    label: str = LABEL,
) -> DataFrame:
    """One row: tn, fp, fn, tp, precision, recall, f1 at an inclusive threshold above 0."""
    return _confusion_of(_labelled(df, score, label), threshold)


def _confusion_of(counts: DataFrame, threshold: float) -> DataFrame:
    reached = F.col("score") >= threshold

    def number(side: str, test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col(side))), F.lit(0)).cast("bigint")

    cells = counts.agg(
        number("neg", ~reached).alias("tn"),
        number("neg", reached).alias("fp"),
        number("pos", ~reached).alias("fn"),
        number("pos", reached).alias("tp"),
    )
    return cells.withColumns(_threshold_measures(F.col("tp"), F.col("fp"), F.col("fn")))


def threshold_sweep(
    df: DataFrame,
    grid: Sequence[float] = SWEEP_GRID,
    score: str = SCORE,
    label: str = LABEL,
) -> DataFrame:
    """Confusion and measures at every threshold of an ascending grid, in one pass.

    Each row is counted once, under the highest threshold it reaches; suffix sums
    over the few grid rows do the rest.
    """
    reached = (
        _bucketed(_labelled(df, score, label), "score", grid, "_reached")
        .groupBy("_reached")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    # Position 0 is for the rows below every threshold.
    edges = ", ".join(["NULL"] + [f"{float(edge)!r}D" for edge in grid])
    steps = df.sparkSession.range(1).selectExpr(
        f"posexplode(array({edges})) AS (_reached, threshold)"
    )
    # One row per threshold by now: single window groups are as small as the grid.
    above = Window.orderBy(F.desc("_reached"))
    below = Window.orderBy("_reached").rowsBetween(Window.unboundedPreceding, -1)

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("bigint"))

    counted = (
        steps.join(F.broadcast(reached), "_reached", "left")
        .select("_reached", "threshold", filled("pos").alias("pos"), filled("neg").alias("neg"))
        .select(
            "threshold",
            F.sum("pos").over(above).alias("tp"),
            F.sum("neg").over(above).alias("fp"),
            F.coalesce(F.sum("pos").over(below), F.lit(0)).cast("bigint").alias("fn"),
            F.coalesce(F.sum("neg").over(below), F.lit(0)).cast("bigint").alias("tn"),
        )
        .where(F.col("threshold").isNotNull())
    )
    return counted.withColumns(
        _threshold_measures(F.col("tp"), F.col("fp"), F.col("fn"))
    )


def best_threshold(sweep: DataFrame, criterion: str = "precision_recall") -> DataFrame:
    """One row (threshold, j): the lowest threshold with the largest J above 0, else 0.5.

    precision_recall  J = precision + recall - 1
    youden            J = true positive rate - false positive rate
    """
    if criterion == "precision_recall":
        j = F.col("precision") + F.col("recall") - 1
    elif criterion == "youden":
        j = F.col("recall") - F.coalesce(
            ratio(F.col("fp"), F.col("fp") + F.col("tn")), F.lit(0.0)
        )
    else:
        raise ValueError(f"Unknown criterion: {criterion}")
    best = (
        sweep.where(F.col("tp") + F.col("fp") > 0)
        .select(j.alias("j"), "threshold")
        .where(F.col("j") > 0)
        .agg(F.max(F.struct(F.col("j"), (-F.col("threshold")).alias("falling"))).alias("_best"))
    )
    return best.select(
        F.coalesce(-F.col("_best.falling"), F.lit(DEFAULT_THRESHOLD)).alias("threshold"),
        F.coalesce(F.col("_best.j"), F.lit(0.0)).alias("j"),
    )


def as_report(model: str, one_row: DataFrame) -> DataFrame:
    """A row of measures as (model, metric, value)."""
    names = one_row.columns
    doubles = one_row.select(*[F.col(name).cast("double") for name in names])
    return doubles.unpivot([], names, "metric", "value").select(
        F.lit(model).alias("model"), "metric", "value"
    )


def comparison(
    predictions: Mapping[str, DataFrame],
    thresholds: Mapping[str, float],
    importances: DataFrame | None = None,
    top: int = 5,
) -> DataFrame:
    """The models side by side: ranking and threshold measures, confusion cells,
    the threshold used and the strongest features, as REPORT rows."""
    parts = []
    for model, scored in predictions.items():
        # Scored once; everything else reads the written counts.
        counts = materialize(score_counts(scored), "score-counts")
        parts.append(as_report(model, _areas(_curve_of(counts))))
        parts.append(as_report(model, _confusion_of(counts, thresholds[model])))
        chosen = scored.sparkSession.range(1).select(F.lit(thresholds[model]).alias("threshold"))
        parts.append(as_report(model, chosen))
    if importances is not None:
        strongest = importances.orderBy(F.desc("importance_gain"), F.asc("feature")).limit(top)
        parts.append(
            strongest.select(
                F.lit("importance").alias("model"),
                F.col("feature").alias("metric"),
                F.col("importance_gain").alias("value"),
            )
        )
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.select(*REPORT.fieldNames())
