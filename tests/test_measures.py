import math
import random

import pytest
from conftest import column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywatch.operators import running
from paywatch.plans.evaluation import (
    SWEEP_GRID,
    best_threshold,
    comparison,
    confusion,
    curve,
    pr_points,
    ranking_measures,
    roc_points,
    threshold_sweep,
)


def scores(spark, pairs):
    return spark.createDataFrame(
        [(float(p) if p is not None else None, y) for p, y in pairs],
        "fraud_probability double, is_fraud int",
    )


def crowded(seed, rows=500):
    """Scores crowded near zero, with ties."""
    rng = random.Random(seed)
    out = []
    for _ in range(rows):
        fraud = int(rng.random() < 0.2)
        p = rng.random() ** (2 if fraud else 8)
        out.append((round(p, 3) if rng.random() < 0.5 else p, fraud))
    return out


def plain_measures(pairs):
    pos = sum(y for _, y in pairs)
    neg = len(pairs) - pos
    won = sum(
        (a > b) + (a == b) / 2 for a, ya in pairs if ya for b, yb in pairs if not yb
    )
    step = area = 0.0
    last_recall, last_precision = 0.0, 1.0
    for s in sorted({p for p, _ in pairs}, reverse=True):
        tp = sum(y for p, y in pairs if p >= s)
        n = sum(p >= s for p, _ in pairs)
        recall, precision = tp / pos, tp / n
        step += (recall - last_recall) * precision
        area += (recall - last_recall) * (precision + last_precision) / 2
        last_recall, last_precision = recall, precision
    return won / (pos * neg), step, area


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_areas_against_plain_loops(spark, seed):
    pairs = crowded(seed)
    row = ranking_measures(scores(spark, pairs)).head()
    expected = plain_measures(pairs)
    assert (row.roc_auc, row.average_precision, row.pr_auc) == pytest.approx(expected)


@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_curve_does_not_depend_on_buckets(spark, buckets):
    pairs = crowded(4)
    for row in curve(scores(spark, pairs), buckets=buckets).collect():
        assert row.tp == sum(y for p, y in pairs if p >= row.score)
        assert row.fp == sum(1 - y for p, y in pairs if p >= row.score)


def test_auc_of_equal_scores_is_a_half(spark):
    assert ranking_measures(scores(spark, [(0.3, 1), (0.3, 0), (0.3, 0)])).head().roc_auc == 0.5


def test_auc_of_the_opposite_score(spark):
    df = scores(spark, crowded(5))
    turned = df.withColumn("fraud_probability", -F.col("fraud_probability"))
    both = ranking_measures(df).head().roc_auc + ranking_measures(turned).head().roc_auc
    assert both == pytest.approx(1)


def test_one_class_has_no_auc(spark):
    assert ranking_measures(scores(spark, [(0.1, 0), (0.2, 0)])).head().roc_auc is None


def test_points_end_at_one(spark):
    df = scores(spark, crowded(6))
    last = roc_points(df).orderBy("threshold").head()
    assert (last.fpr, last.tpr) == (1, 1)
    assert pr_points(df).orderBy("threshold").head().recall == 1


def test_confusion_cells_and_missing_scores(spark):
    df = scores(spark, [(0.5, 1), (0.4999, 1), (float("nan"), 1), (None, 0), (0.9, 0), (0.7, 1)])
    row = confusion(df).head()
    assert (row.tp, row.fn, row.fp, row.tn) == (2, 2, 1, 1)
    assert row.precision == pytest.approx(2 / 3)
    assert row.recall == 0.5
    assert row.f1 == pytest.approx(4 / 7)


def test_confusion_without_predictions_is_zero(spark):
    row = confusion(scores(spark, [(0.1, 1), (0.2, 0)])).head()
    assert (row.precision, row.recall, row.f1) == (0, 0, 0)


def test_sweep_equals_separate_counts(spark):
    pairs = crowded(7) + [(t, 1) for t in SWEEP_GRID[:5]] + [(None, 1), (float("nan"), 0)]
    found = threshold_sweep(scores(spark, pairs)).orderBy("threshold").collect()
    assert [row.threshold for row in found] == list(SWEEP_GRID)
    real = [(p if p is not None and not math.isnan(p) else 0.0, y) for p, y in pairs]
    for row in found:
        assert row.tp == sum(y for p, y in real if p >= row.threshold)
        assert row.fp == sum(1 - y for p, y in real if p >= row.threshold)
        assert row.tp + row.fp + row.fn + row.tn == len(real)


def test_best_threshold_is_the_first_of_equals(spark):
    df = scores(spark, [(0.85, 1), (0.05, 0)])
    row = best_threshold(threshold_sweep(df)).head()
    assert (row.threshold, row.j) == (SWEEP_GRID[0], 1)
    assert best_threshold(threshold_sweep(df), "youden").head().j == 1


def test_best_threshold_without_positive_predictions(spark):
    row = best_threshold(threshold_sweep(scores(spark, [(0.05, 1), (0.01, 0)]))).head()
    assert (row.threshold, row.j) == (0.5, 0)


def test_unknown_criterion(spark):
    with pytest.raises(ValueError, match="criterion"):
        best_threshold(threshold_sweep(scores(spark, [(0.5, 1)])), "other")


def test_comparison_is_long(spark):
    df = scores(spark, crowded(8))
    report = comparison({"one": df, "two": df}, {"one": 0.5, "two": 0.3})
    assert report.columns == ["model", "metric", "value"]
    values = {(r.model, r.metric): r.value for r in report.collect()}
    assert values["one", "roc_auc"] == values["two", "roc_auc"]
    assert values["two", "threshold"] == 0.3
    assert values["one", "tp"] <= values["two", "tp"]


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("width", [1, 13, 1000])
def test_running_against_plain_loops(spark, inclusive, width):
    rng = random.Random(width)
    rows = [
        (i, rng.choice(["a", "a", "b", None]), rng.randrange(-60, 60), rng.randrange(-5, 9))
        for i in range(200)
    ]
    df = spark.createDataFrame(rows, "id int, k string, at bigint, v bigint").withColumns(
        {"bucket": F.floor(F.col("at") / width), "top": F.col("v")}
    )
    found = running(df, ["k"], "bucket", "at", {"v": "sum", "top": "max"}, inclusive).collect()
    assert len(found) == len(rows)
    for row in found:
        seen = [
            v
            for _, k, when, v in rows
            if k == row.k and (when < row.at or (inclusive and when == row.at))
        ]
        assert row.v == (sum(seen) if seen else None)
        assert row.top == max(seen, default=None)


def test_running_totals_over_levels(spark):
    df = spark.range(400).selectExpr(
        "id % 2 AS k", "id - 200 AS at", "id % 7 AS v", "(id * 37) % 101 AS top",
        "id - 200 - pmod(id - 200, 3) AS bucket",
    )
    measures = {"v": "sum", "top": "max"}
    for inclusive in (True, False):
        flat = running(df, ["k"], "bucket", "at", measures, inclusive)
        tall = running(df, ["k"], "bucket", "at", measures, inclusive, widths=(9, 45, 180))
        columns = ["k", "at", "v", "top"]
        assert sorted(map(str, flat.select(columns).collect())) == sorted(map(str, tall.select(columns).collect()))


def test_curve_cuts_buckets_again(spark, monkeypatch):
    from paywatch.plans import evaluation

    used, cut = [], evaluation._banded

    def watched(*given):
        banded, widths = cut(*given)
        sizes = [r["count"] for r in banded.groupBy("_band").count().collect()]
        used.append((widths, max(sizes)))
        return banded, widths

    monkeypatch.setattr(evaluation, "_banded", watched)
    df = scores(spark, crowded(5, 900))
    once = sorted(curve(df, buckets=1).collect())
    assert sorted(curve(df, size=10, most=4, fan=4).collect()) == once
    widths, largest = used[-1]
    assert widths == [4, 16] and largest <= 40
