"""Hard negatives by Fagin's threshold algorithm.

A row's score with an anchor is the inner product of their vectors in whole numbers,
each component x taken as floor(scale * x). An anchor's positives are its best rows of the
same label; for each of them the negatives are the best rows of other labels whose score
lies within a window of percentages of the positive's score. Higher scores come first,
ties by smaller id.

Rows are dealt to blocks by a hash of their id. A block keeps, for every dimension, its
rows in order of that component. A search reads all lists from the end that the sign of the
anchor's component favours, scores each newly met row in full, and knows that no row still
unseen can score more than the threshold, the sum of the products at the places reached.
It ends once the threshold is strictly below the k-th best score of every window, or below
the window's lower end; strictly, since an equal score could still win by its id. So each
block's answer is exact, and the best over all blocks are merged. Blocks hold a bounded
number of components and meet the anchors in chunks of bounded size, so no task grows with
the table; a label with a third of all rows is spread over all blocks like any other.

Rows with a null id or label, a null vector, or null or non-finite components take no part,
nor do rows whose squared integers sum to 2^62 or more, as their scores need not fit in a
long. Rows that repeat an id count as one: the smallest label, then the smallest vector.
Vectors meet only vectors of their own length; empty vectors score zero with each other.
Where the low percentage exceeds the high one of a negative positive score, the window is
empty. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paywatch.session import materialize

#: Components of one block, and anchors of one chunk.
BLOCK_VALUES, CHUNK = 1 << 18, 4096
#: Depth to which the lists are read first; it doubles.
FIRST_DEPTH = 32
FOUND = "anchor_id long, slot int, row_id long, score long"


class Lists:
    """The rows of one block, sorted by every component."""

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        self.x, self.ids = x, ids
        self.order = np.ascontiguousarray(np.argsort(x, axis=0, kind="stable").T)
        self.sorted = np.take_along_axis(np.ascontiguousarray(x.T), self.order, 1)

    def visit(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """New rows, their scores, and a bound of the scores of all rows not yet met."""
        n = len(self.x)
        used = np.flatnonzero(anchor)
        used = used if len(used) else np.zeros(min(1, len(anchor)), np.int64)
        if not len(used):
            yield np.arange(n), np.zeros(n, np.int64), -math.inf
            return
        up, down = used[anchor[used] < 0], used[anchor[used] >= 0]
        weight, slack = anchor[used].astype(np.float64), len(used) * 2.0**-50
        seen, depth, left = np.zeros(n, bool), 0, n
        while left:
            to = min(n, 2 * depth or FIRST_DEPTH)
            met = np.zeros(n, bool)
            met[self.order[up, depth:to].ravel()] = True
            met[self.order[down, n - to : n - depth].ravel()] = True
            new = np.flatnonzero(met & ~seen)
            seen |= met
            reached = np.where(anchor[used] < 0, self.sorted[used, to - 1], self.sorted[used, n - to]).astype(np.float64)
            # Rounding can only raise the bound.
            bound = weight @ reached + slack * (np.abs(weight) @ np.abs(reached))
            depth = to
            left -= len(new)
            yield new, self.x[new] @ anchor, bound if left else -math.inf

    def best(self, anchor: np.ndarray, may: np.ndarray, windows: list[tuple[float, float]], k: int) -> list[tuple]:
        """(ids, scores) of the k best rows of each window among those that `may` allows."""
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows]
        open_ = [w for w, (low, high) in enumerate(windows) if low <= high]
        for rows, scores, bound in self.visit(anchor):
            allowed = may[rows]
            ids, scores = self.ids[rows[allowed]], scores[allowed]
            for w in open_:
                low, high = windows[w]
                inside = (scores >= low) & (scores <= high)
                if len(best[w][1]) == k:
                    inside &= scores >= best[w][1][-1]
                if inside.any():
                    all_ids = np.concatenate([best[w][0], ids[inside]])
                    all_scores = np.concatenate([best[w][1], scores[inside]])
                    order = np.lexsort((all_ids, -all_scores))[:k]
                    best[w] = all_ids[order], all_scores[order]
            open_ = [w for w in open_ if bound >= max(windows[w][0], best[w][1][-1] if len(best[w][1]) == k else -math.inf)]
            if not open_:
                break
        return best


def integers(column: pa.ChunkedArray, scale: int) -> np.ndarray:
    """[row, component]: floor(scale * x)."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.floor(scale * flat).astype(np.int64).reshape(len(column), -1)


def _found(anchors: np.ndarray, answers: list[list[tuple]]) -> pa.Table:
    rows = [
        (np.full(len(ids), a), np.full(len(ids), w, np.int32), ids, scores)
        for a, windows in zip(anchors.tolist(), answers, strict=True)
        for w, (ids, scores) in enumerate(windows)
    ]
    columns = zip(*rows, strict=True) if rows else [[np.zeros(0, np.int64)]] * 4
    names = ["anchor_id", "slot", "row_id", "score"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    return pa.table({n: pa.array(np.concatenate(list(c)), t) for n, c, t in zip(names, columns, kinds, strict=True)})


def sound(vectors: DataFrame, scale: int, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """id, label, v and n (its length), of the rows that take part."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("v"),
    ).filter("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    squares = F.aggregate("v", F.lit(0.0), lambda sum_, x: sum_ + F.pow(F.abs(x) * scale + 1, 2.0))
    rows = rows.filter(squares < 2.0**62)
    least = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("least"))
    return least.select("id", "least.label", "least.v", F.size("least.v").alias("n"))


def first(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each anchor and slot over all blocks, with their rank."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "row_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    low_percent: int = 80,
    high_percent: int = 100,
    scale: int = 256,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Anchors are the rows whose id is divisible by `every`; they meet all rows."""
    rows = materialize(sound(vectors, scale, id_col, label_col, vector_col), "rows")
    size = rows.agg(F.sum("n").alias("values"), F.count_if(F.col("id") % every == 0).alias("anchors")).first()
    parts = max(1, math.ceil((size["values"] or 0) / BLOCK_VALUES))
    chunks = max(1, math.ceil(size["anchors"] / CHUNK))
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    blocks = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).withColumn("chunk", each(chunks))
    anchors = rows.filter(F.col("id") % every == 0).toDF("anchor_id", "own_label", "anchor", "own_n")
    anchors = anchors.withColumn("own_chunk", F.pmod(F.hash("anchor_id"), F.lit(chunks))).withColumn("own_part", each(parts))

    def same_label(points: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(points) or not len(asked):
            return _found(np.zeros(0, np.int64), [])
        ids, own = points["id"].to_numpy(), asked["anchor_id"].to_numpy()
        lists = Lists(integers(points["v"], scale), ids)
        anchors = integers(asked["anchor"], scale)
        return _found(own, [lists.best(v, ids != i, [(-math.inf, math.inf)], positives) for i, v in zip(own, anchors, strict=True)])

    keys = ["n", "label", "part", "chunk"]
    own_keys = ["own_n", "own_label", "own_part", "own_chunk"]
    found = blocks.groupBy(*keys).cogroup(anchors.groupBy(*own_keys)).applyInArrow(same_label, FOUND)
    near = first(found, positives).select(
        "anchor_id", F.col("rank").alias("slot"), F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    near = materialize(near, "positives")

    def other_label(points: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(points) or not len(asked):
            return _found(np.zeros(0, np.int64), [])
        lists = Lists(integers(points["v"], scale), points["id"].to_numpy())
        may: dict[str, np.ndarray] = {}
        answers = []
        for label, v, bests in zip(
            asked["own_label"].to_pylist(), integers(asked["anchor"], scale), asked["bests"].to_pylist(), strict=True
        ):
            if label not in may:
                may[label] = pc.not_equal(points["label"], label).to_numpy()
            windows = [(-(-low_percent * b // 100), high_percent * b // 100) for b in bests]
            answers.append(lists.best(v, may[label], windows, negatives))
        return _found(asked["anchor_id"].to_numpy(), answers)

    bests = near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("slot", "positive_score"))).alias("bests"))
    anchors = anchors.join(bests.select("anchor_id", F.col("bests.positive_score").alias("bests")), "anchor_id")
    keys, own_keys = ["n", "part", "chunk"], ["own_n", "own_part", "own_chunk"]
    found = blocks.groupBy(*keys).cogroup(anchors.groupBy(*own_keys)).applyInArrow(other_label, FOUND)
    chosen = first(found, negatives).withColumn("slot", F.col("slot") + 1)
    return chosen.join(near, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("row_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
