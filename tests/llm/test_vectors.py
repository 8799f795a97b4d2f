"""Whitening and hard negatives against plain versions, with odd rows and columns."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from paywatch.llm import hard_negatives, whitening
from paywatch.llm.queries import table

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [
    (None, [1.0, 2.0, 3.0, 4.0], 1),
    (900, None, 1),
    (901, [1.0, None, 2.0, 3.0], 1),
    (902, [1.0, math.nan, 2.0, 3.0], 1),
    (903, [1.0, math.inf, 2.0, 3.0], 1),
    (1000, [0.5, 0.5, 0.5, 0.5], None),
    (1100, [], 1),
    (1101, [], 2),
]


def some(n, d=4, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, [float(np.float32(v)) for v in rng.normal(0, 1, d)], int(rng.integers(0, 3))) for i in range(n)]


def mined(rows, every, positives=5, negatives=5):
    """The rows of hard_negatives.mine, by comparing everything."""
    good = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            good[i] = min(good.get(i, (label, v)), (label, v))
    x = {i: [math.floor(256 * c) for c in v] for i, (_, v) in good.items()}
    out = []
    for a in (i for i in good if i % every == 0):
        scores = {i: sum(p * q for p, q in zip(x[a], x[i], strict=True)) for i in good if i != a and len(x[i]) == len(x[a])}
        order = sorted(scores, key=lambda i: (-scores[i], i))
        for p in [i for i in order if good[i][0] == good[a][0]][:positives]:
            window = [i for i in order if good[i][0] != good[a][0] and 80 * scores[p] <= 100 * scores[i] <= 100 * scores[p]]
            out += [(a, p, r, i, scores[p], scores[i]) for r, i in enumerate(window[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [24, 1 << 18])
def test_hard_negatives_equal_a_full_comparison(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK_VALUES", block)
    monkeypatch.setattr(hard_negatives, "CHUNK", 7)
    # Ties: every vector three times; repeats: one id twice; a hot vector; an anchor of zeros.
    rows = some(60) + [(200 + i, v, (label + i) % 3) for i, v, label in some(60)] + [(400 + i, [1.0, 1.0, 0.0, 0.0], i % 2) for i in range(40)]
    rows += [(5, [9.0, 9.0, 9.0, 9.0], 0), (500, [0.0] * 4, 1), (501, [0.0] * 4, 2), *ODD]
    data = spark.createDataFrame(rows, SCHEMA).withColumns({"rank": F.lit(1), "part": F.lit("x"), "score": F.lit(0.5), "n": F.lit(3)})
    got = sorted(tuple(r) for r in hard_negatives.mine(data, every=10).collect())
    assert got == mined(rows, 10) and len(got) > 100


def test_hard_negatives_stop_before_the_end_where_the_lists_allow():
    rng = np.random.default_rng(1)
    x = np.rint(rng.normal(0, 1, (4000, 2)) * 100).astype(np.int64)
    lists = hard_negatives.Lists(x, np.arange(4000))
    met = list(itertools.islice(lists.visit(np.array([100, -50])), 2))
    assert sum(len(rows) for rows, _, _ in met) < 300
    assert all(bound >= max(x[np.setdiff1d(np.arange(4000), np.concatenate([m[0] for m in met[: k + 1]]))] @ [100, -50])
               for k, (_, _, bound) in enumerate(met))


def test_hard_negatives_without_rows_or_with_huge_ones(spark):
    assert hard_negatives.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([(0, [1e30, 1.0], 1), (1, [1.0, 1.0], 1)], SCHEMA)).count() == 0


def whole(rows, scale=64, shift=1_000_000):
    x = np.array([[math.floor(scale * c) + shift for c in v] for _, v, _ in rows], np.int64)
    n, s = len(x), x.sum(0)
    y = (n * x - s) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    keep = values[::-1] > 1e-9 * values[-1]
    return n, ((n * x - s) ** 2).sum(1), y @ vectors[:, ::-1][:, keep] / np.sqrt(values[::-1][keep]), values[::-1][keep] / values.sum()


def test_whitening_equals_eigenvectors(spark):
    rows = some(300, 6)
    # A constant dimension and one that follows from others: rank 6 of 8.
    rows = [(i, [*v, 7.0, 2 * math.floor(64 * v[0]) / 64], label) for i, v, label in rows] * 2
    odd = [(i, v, label) for i, v, label in ODD if v is None or len(v) == 4 and any(c is None or not math.isfinite(c) for c in v)]
    data = spark.createDataFrame(rows + odd, SCHEMA).withColumns({"n": F.lit(1), "component": F.lit("x"), "v": F.lit(0), "id": F.lit(2)})
    got = whitening.whiten(data, most=32).toPandas()
    n, deviations, want, explained = whole(rows)
    assert set(got.n) == {n} and set(got.component) == set(range(1, 7)) and len(got) == 6 * n
    assert got.identity_error.max() < 1e-9
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-12)
    for k in range(6):
        own = got[got.component == k + 1].sort_values(["vec_id"], kind="stable")
        order = np.argsort([r[0] for r in rows], kind="stable")
        assert own.deviation.tolist() == deviations[order].tolist()
        values = own.whitened.to_numpy()
        assert min(np.abs(values - want[order, k]).max(), np.abs(values + want[order, k]).max()) < 1e-9


def test_whitening_of_equal_singular_values_nulls_and_long_numbers(spark):
    axes = [[(1.0 if k == i else 0.0) * side for k in range(5)] for i in range(5) for side in (1, -1)]
    data = spark.createDataFrame([(None, v, 0) for v in axes], SCHEMA)
    got = whitening.whiten(data).toPandas()
    assert len(got) == 50 and got.vec_id.isna().all() and got.identity_error.max() < 1e-12
    assert np.allclose(got.explained, 0.2) and np.allclose(got.groupby("component").whitened.apply(lambda w: (w**2).mean()), 1)
    big = spark.createDataFrame([(i, [v, 1.0], 0) for i, v in enumerate([1e15, -1e15, 5e14])], SCHEMA)
    assert whitening.whiten(big).toPandas().deviation.isna().all()


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 0)], [(1, [1.0], 0), (2, [1.0], 0)], [(1, [], 0)], [(1, None, 0)], [(1, [3e38], 0)]])
def test_whitening_without_spread_has_no_rows(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_each_length_is_whitened_by_itself(spark):
    rows = some(30, 2) + [(100 + i, v, label) for i, v, label in some(30, 3)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).toPandas()
    assert len(got) == 30 * 2 + 30 * 3 and set(got.n) == {30}


def test_whole_table_of_vectors_is_whitened(spark):
    vectors = table(spark, "/root/testdata/sf0.001", "embeddings")
    got = whitening.whiten(vectors)
    assert got.count() == 32 * vectors.count() and got.agg(F.max("identity_error")).first()[0] < 1e-9
