"""Nearest neighbours by inner product along shifted space-filling curves.

Vectors are turned by one random rotation; each curve takes a few of the turned
coordinates, shifted by an offset of its own, as a cell of a grid and orders cells by
Hilbert index. Spark sorts each order by range partitioning. A query is compared,
on the original vectors, with the rows whose rank lies within a window around its
own, on every curve; the results are merged and ranked.

How wide the window must be depends on the data, so it is fitted: for a bounded
sample of queries the true neighbours are found by brute force, and the window is
the rank distance within which, on their closest curve, the wanted share of them
lies. Clustered vectors give narrow windows; vectors without any structure give
windows that cover most rows, and the search then costs as much as brute force.

Equal vectors are one point on the curves and are expanded at the end, smallest ids
first. Vectors that are null, zero, or hold null or non-finite components take no part.
Vectors of one length are searched by themselves, one length after the other. Rows that
repeat an id count as one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paywatch.session import materialize

CURVES, AXES, BITS = 8, 4, 10
BLOCK = 8192
#: Queries of the sample by which the window is fitted, and the share of their neighbours it reaches.
SAMPLE, REACHED = 64, 0.97
#: Rows whose spread sets the grid.
FIT_ROWS = 20_000


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer cells [row, axis], by Gray-code rotation of the axes."""
    x = cells.astype(np.int64).copy()
    axes = x.shape[1]
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(axes):
            on = (x[:, i] & bit) != 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(on, low, swap)
            x[:, i] ^= swap
        bit >>= 1
    for i in range(1, axes):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.int64)
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where(x[:, axes - 1] & bit, bit - 1, 0)
        bit >>= 1
    x ^= turn[:, None]
    out = np.zeros(len(x), np.int64)
    for k in range(bits - 1, -1, -1):
        for i in range(axes):
            out = (out << 1) | ((x[:, i] >> k) & 1)
    return out


class Curves:
    """Rotation, offsets and grid of all curves."""

    def __init__(self, sample: np.ndarray, curves: int = CURVES, seed: int = 5):
        rng = np.random.default_rng(seed)
        d = sample.shape[1]
        self.axes = min(AXES, d)
        self.turns = []
        while len(self.turns) < curves:
            q, _ = np.linalg.qr(rng.standard_normal((d, d)))
            self.turns += [q[:, i : i + self.axes] for i in range(0, d - self.axes + 1, self.axes)]
        self.turns = self.turns[:curves]
        self.shifts = rng.random((curves, self.axes))
        spread = [np.abs(sample @ t).max(0) if len(sample) else np.ones(self.axes) for t in self.turns]
        self.spread = [np.where(s > 0, s, 1.0) for s in spread]

    def keys(self, x: np.ndarray, curve: int) -> np.ndarray:
        place = (x @ self.turns[curve] / self.spread[curve] + 1.2) / 2.4  # outside the sample's spread: clipped
        cells = np.clip((place + self.shifts[curve]) / 2, 0, 1 - 1e-9) * (1 << BITS)
        return hilbert(cells.astype(np.int64), BITS)


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter("id IS NOT NULL AND size(v) > 0")
    return rows.filter(sound & F.exists("v", lambda x: x != 0))


def top_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest per row, and of whatever equals the last of them."""
    if scores.shape[1] <= k:
        return np.isfinite(scores)
    least = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k][:, None]
    return (scores >= least) & np.isfinite(scores)


def nearest(vectors: DataFrame, every: int, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score (inner product) of the k nearest of each query.

    Queries are the rows whose id is divisible by `every`."""
    rows = materialize(usable(vectors, id_col, vector_col).dropDuplicates(["id"]), "vectors")
    length = F.size("v")
    asked = F.count_if(F.col("id") % every == 0)
    lengths = rows.groupBy(length.alias("n")).agg(F.count("*").alias("rows"), asked.alias("asked"))
    lengths = [r.n for r in lengths.filter("rows > 1 AND asked > 0").orderBy("n").collect()]
    out = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for n in lengths:
        found = _nearest(rows.filter(length == n), every, k)
        out = found if n == lengths[0] else out.unionByName(found)
    return out


def _nearest(rows: DataFrame, every: int, k: int) -> DataFrame:
    """The k nearest of each query among vectors of one length."""
    spark = rows.sparkSession
    # One point per distinct vector, with the ids that an answer could need.
    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    members = rows.withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    points = materialize(
        members.groupBy("v").agg(F.min("id").alias("point"), F.sort_array(F.collect_list("id")).alias("ids")), "points"
    )
    n = points.count()
    share = F.pmod(F.xxhash64("point"), F.lit(1 << 30)) < min(1 << 30, int((1 << 30) * FIT_ROWS / n))
    sample = np.array([r[0] for r in points.filter(share).select("v").limit(2 * FIT_ROWS).collect()], np.float64)
    curves = Curves(sample if len(sample) else np.ones((1, len(points.select("v").first()[0]))))
    sent = spark.sparkContext.broadcast(curves)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1))
            for c in range(CURVES):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.full(len(x), c, np.int32)), pa.array(sent.value.keys(x, c))],
                    names=["point", "curve", "key"],
                )

    keyed = points.select("point", "v").mapInArrow(place, "point long, curve int, key long")
    parts = max(CURVES, math.ceil(n * CURVES / (1 << 20)))
    ordered = keyed.repartitionByRange(parts, "curve", "key", "point").sortWithinPartitions("curve", "key", "point")
    low = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = materialize(ordered.select("point", "curve", F.spark_partition_id().alias("part"), low.alias("nth")), "curves")
    sizes = dict(ordered.groupBy("part").agg(F.max("nth") + 1).collect())
    begins, at = [], 0
    for part in sorted(sizes):
        begins.append((part, at))
        at += sizes[part]
    begin = spark.createDataFrame(begins, "part int, begin long")
    ranks = ordered.join(F.broadcast(begin), "part").select(
        "point", "curve", (F.col("begin") + F.col("nth") - F.col("curve") * n).alias("rank")
    )
    ranks = materialize(ranks, "ranks")

    asked = rows.filter(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "v")
    asked = asked.join(points.select("v", "point"), "v")
    # At the end of a curve, too, the window holds k others.
    window = max(fit_window(asked, points, ranks, n, k), k + 1)
    near = visit(asked, points, ranks, window, k)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "point")
    near = near.groupBy("query_id", "point").agg(F.max("score").alias("score"))
    near = near.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k + 1)
    expanded = near.join(points.select("point", "ids"), "point").select("query_id", F.explode("ids").alias("vec_id"), "score")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        expanded.filter("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(final))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _scores(points: pa.Table, queries: pa.Table) -> np.ndarray:
    return matrix(queries["v"].combine_chunks()) @ matrix(points["v"].combine_chunks()).T


def fit_window(asked: DataFrame, points: DataFrame, ranks: DataFrame, n: int, k: int) -> int:
    """Rank distance within which the sampled queries' true neighbours lie on some curve."""
    queries = asked.orderBy(F.xxhash64("query_id"), "query_id").limit(SAMPLE).select("query_id", "point", "v").toArrow()
    if not len(queries):
        return 1
    sent = asked.sparkSession.sparkContext.broadcast(queries)

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _scores(pa.table({"v": batch.column(1)}), sent.value)
            q, p = np.nonzero(top_of(scores, k + 1))
            own = sent.value["point"].to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[q]), batch.column(0).take(pa.array(p)), pa.array(scores[q, p])], names=["asked", "point", "score"]
            )

    found = points.select("point", "v").mapInArrow(brute, "asked long, point long, score double")
    order = Window.partitionBy("asked").orderBy(F.desc("score"), "point")
    true = found.withColumn("nth", F.row_number().over(order)).filter((F.col("nth") <= k + 1) & (F.col("asked") != F.col("point")))
    own = ranks.select(F.col("point").alias("asked"), "curve", F.col("rank").alias("own"))
    apart = true.join(ranks, "point").join(own, ["asked", "curve"])
    apart = apart.groupBy("asked", "point").agg(F.min(F.abs(F.col("rank") - F.col("own"))).alias("apart"))
    distances = np.sort([r[0] for r in apart.select("apart").collect()])
    return int(distances[math.ceil(REACHED * len(distances)) - 1]) + 1 if len(distances) else 1


def visit(asked: DataFrame, points: DataFrame, ranks: DataFrame, window: int, k: int) -> DataFrame:
    """Each query against the blocks of every curve that its window touches."""
    blocks = ranks.join(points.select("point", "v"), "point").select(
        "curve", F.expr(f"rank DIV {BLOCK}").cast("int").alias("block"), "point", "rank", "v"
    )
    own = asked.join(ranks, "point").select("query_id", F.col("curve").alias("on"), F.col("rank").alias("rank"), F.col("v").alias("v"))
    first, last = F.greatest(F.col("rank") - window, F.lit(0)), F.col("rank") + window
    own = own.withColumn("block", F.explode(F.sequence(F.floor(first / BLOCK).cast("int"), F.floor(last / BLOCK).cast("int"))))

    def compare(points: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(points) or not len(queries):
            return pa.table({"query_id": pa.array([], pa.int64()), "point": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        rank, point, asked, at = points["rank"].to_numpy(), points["point"].to_numpy(), queries["query_id"].to_numpy(), queries["rank"].to_numpy()
        out = []
        x, y = matrix(points["v"].combine_chunks()), matrix(queries["v"].combine_chunks())
        for a in range(0, len(asked), 256):
            scores = y[a : a + 256] @ x.T
            scores[np.abs(rank[None] - at[a : a + 256, None]) > window] = -np.inf
            q, p = np.nonzero(top_of(scores, k + 1))
            out.append((asked[a : a + 256][q], point[p], scores[q, p]))
        ids, near, scores = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.table({"query_id": ids, "point": near, "score": scores})

    return (
        blocks.groupBy("curve", "block")
        .cogroup(own.toDF("query_id", "on", "rank", "v", "at").groupBy("on", "at"))
        .applyInArrow(compare, "query_id long, point long, score double")
    )
