"""Connected components: union-find inside partitions, then stars across them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywatch.session import materialize

EDGES = "a long, b long"


def local_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of one partition: one edge from each node to its smallest."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    rows = [(x, root(x)) for x in list(parent)]
    rows = [r for r in rows if r[0] != r[1]]
    columns = np.array(rows, np.int64).reshape(-1, 2)
    yield pa.RecordBatch.from_arrays([pa.array(columns[:, 0]), pa.array(columns[:, 1])], names=["a", "b"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node below the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours below the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _print(edges: DataFrame) -> tuple:
    pair = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(pair), F.sum(F.pmod(pair, F.lit(1 << 32)))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node that has an edge to another, with the smallest node it reaches.

    `edges` has long columns a and b. Loops and repeated edges are ignored, rows with a
    null too. Each round is written to the shared folder; rounds grow with the logarithm
    of the longest path.
    """
    plain = edges.filter("a <> b").select("a", "b")
    star = materialize(plain.mapInArrow(local_roots, EDGES).distinct(), "stars")
    seen = _print(star)
    while seen[0]:
        star = materialize(_small_star(_large_star(star)), "stars")
        now = _print(star)
        if now == seen:
            break
        seen = now
    roots = star.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
