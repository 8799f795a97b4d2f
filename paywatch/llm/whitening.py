"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Components c become whole numbers x = floor(scale * c) + shift, and Y holds the rows x
minus their mean. Y = U B V^T with orthonormal U and V and an upper bidiagonal B comes from
alternating products: each step multiplies the rows by the next column of V (a pass over
the data, spread over tasks), makes the result orthogonal to all earlier columns of U, and
multiplies it by the transposed rows (in the same pass), which is made orthogonal to all
earlier columns of V. A breakdown, where the rows have less rank or equal singular values,
goes on from a new random direction. The singular values of the small B give the standard
deviations, and V times its right singular vectors the components.

A column of U has an entry per row, u = Y p, and is never stored: its direction p is kept,
which has an entry per dimension, and tasks multiply it out again to make new columns
orthogonal. So a step needs one pass, whose sums have three entries per dimension at most,
and nothing that grows with the rows reaches the driver. All min(rows, dimensions) steps
are taken, since a search that ends early can miss one of two equal singular values. The
passes read blocks of centred rows, written once to the shared folder, so a lost executor
costs a part of one pass.

Sums and deviations are exact: x are whole numbers, and n * x - S is taken in whole numbers.
Rows whose vector is null or holds null or non-finite components, or components beyond
2^62 / scale (no long holds them), take no part. Vectors of one length are whitened by
themselves. Repeated rows count as often as they come; a null id is kept. Components whose
standard deviation is zero, but for rounding, have no whitened values and are left out, so
equal vectors, single and empty ones give no rows. A deviation that does not fit in a long
is null. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paywatch.session import materialize

SCALE, SHIFT = 64, 1_000_000
MOST = 32
#: Bytes of centred rows one task reads in a pass, at least and at most.
LEAST_BYTES, MOST_BYTES = 1 << 20, 1 << 26
#: Singular values below this share of the root of their squares' sum are zero.
NOTHING = 1e-12


@dataclass
class Whitening:
    """Fitted to `n` vectors of one length: what turns a centred row into whitened values."""

    n: int
    sums: list[int]
    variances: np.ndarray
    total: float
    #: [dimension, component]: unit eigenvectors.
    components: np.ndarray
    #: Largest absolute entry of the whitened rows' covariance minus the identity.
    identity_error: float = math.nan

    @property
    def weights(self) -> np.ndarray:
        return self.components / np.sqrt(self.variances)

    @property
    def explained(self) -> list[float]:
        return (self.variances / self.total).tolist()


def integers(column: pa.Array, scale: int) -> np.ndarray:
    """[row, dimension]: floor(scale * c), as long; the shift falls out when centring."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(scale * flat).astype(np.int64).reshape(len(column), -1)


def sound(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    # Comparisons with a NaN or null component hold for neither.
    inside = F.forall("v", lambda c: F.coalesce(F.abs(c) * scale < 2.0**62, F.lit(False)) & ~F.isnan(c))
    return rows.filter(F.col("v").isNotNull() & inside)


def added(rows: DataFrame, run: Callable, kind: str = "double") -> dict:
    """Sums over all tasks of what `run` yields as (place, value)."""
    places = rows.mapInArrow(run, f"place int, value {kind}").groupBy("place").agg(F.sum("value").alias("value"))
    return dict(places.collect())


def column_sums(rows: DataFrame, scale: int, d: int) -> tuple[int, list[int]]:
    """How many rows there are, and the sum of each component without the shift."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, totals = 0, [0] * d
        for batch in batches:
            x = integers(batch.column(0), scale)
            # Halves keep sums of longs from overflowing.
            high, low = (x >> 31).sum(0).tolist(), (x & (2**31 - 1)).sum(0).tolist()
            n += len(x)
            totals = [t + (h << 31) + w for t, h, w in zip(totals, high, low, strict=True)]
        values = [Decimal(v) for v in (n, *totals)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d + 1), pa.int32()), pa.array(values, pa.decimal128(38, 0))], names=["place", "value"]
        )

    found = added(rows.select("v"), run, "decimal(38,0)")
    return int(found.get(0) or 0), [int(found.get(k + 1) or 0) for k in range(d)]


def centred(rows: DataFrame, scale: int, n: int, sums: list[int]) -> DataFrame:
    """Blocks of rows: ids, deviations (sum over dimensions of (n * x - S)^2) and y (x - S / n, doubles)."""
    d, whole = len(sums), np.array(sums, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = integers(batch.column(1), scale)
            most = n * max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, sums)) if len(x) else 0
            if d * most * most < 2**62:
                apart = n * x - np.array(sums, np.int64)
                deviations = pa.array((apart * apart).sum(1), pa.int64())
            else:
                apart = n * x.astype(object) - whole
                exact = (apart * apart).sum(1).tolist()
                deviations = pa.array([v if v < 2**63 else None for v in exact], pa.int64())
            y = (apart / n).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), batch.column(0)),
                    pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), deviations),
                    pa.array([y.tobytes()], pa.binary()),
                ],
                names=["ids", "deviations", "y"],
            )

    return rows.select("id", "v").mapInArrow(run, "ids array<long>, deviations array<long>, y binary")


def summed(blocks: DataFrame, d: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all blocks of of(block), a vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for y in batch.column(0):
                part = of(np.frombuffer(y.as_buffer()).reshape(-1, d))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["place", "value"]
            )

    found = added(blocks.select("y"), run)
    return np.array([found[k] for k in sorted(found)])


def bidiagonal(blocks: DataFrame, d: int, steps: int, size: float, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """V [dimension, step] and B. `size` is the root of the sum of all squares of Y."""
    rng = np.random.default_rng(seed)
    v_all, p_all, z_all = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))
    b = np.zeros((steps, steps))
    v, beta = None, 0.0
    for j in range(steps):
        if v is None:
            v, beta = rng.standard_normal(d), 0.0
            for _ in range(2):
                v -= v_all @ (v_all.T @ v)
            v /= np.linalg.norm(v)
        # U^T Y v is known from the products with earlier columns of U.
        q = v - p_all @ (z_all.T @ v)
        for _ in range(2):

            def multiply(y: np.ndarray, q: np.ndarray = q, p: np.ndarray = p_all) -> np.ndarray:
                w = y @ q
                return np.concatenate([[w @ w], w @ y, w @ (y @ p)])

            found = summed(blocks, d, multiply)
            squares, product, overlap = found[0], found[1 : d + 1], found[d + 1 :]
            q = q - p_all @ overlap
            rest = squares - overlap @ overlap
            product = product - z_all @ overlap
            # Taken again where most of the column was not new.
            if rest <= (NOTHING * size) ** 2 or rest > 0.5 * squares:
                break
        if rest <= (NOTHING * size) ** 2:
            alpha, p, z = 0.0, np.zeros(d), np.zeros(d)
        else:
            alpha = math.sqrt(rest)
            p, z = q / alpha, product / alpha
        b[j, j] = alpha
        if j:
            b[j - 1, j] = beta
        v_all = np.column_stack([v_all, v])
        p_all, z_all = np.column_stack([p_all, p]), np.column_stack([z_all, z])
        following = z - alpha * v
        for _ in range(2):
            following = following - v_all @ (v_all.T @ following)
        beta = float(np.linalg.norm(following))
        v = following / beta if beta > NOTHING * size else None
    return v_all, b


def fit(blocks: DataFrame, n: int, sums: list[int], most: int = MOST) -> Whitening:
    d = len(sums)
    total = float(summed(blocks, d, lambda y: np.array([np.vdot(y, y)]))[0]) if n else 0.0
    nothing = Whitening(n, sums, np.zeros(0), total / max(n, 1), np.zeros((d, 0)))
    if not total:
        return nothing
    size = math.sqrt(total)
    v, b = bidiagonal(blocks, d, min(n, d), size)
    _, singular, right = np.linalg.svd(b)
    keep = np.flatnonzero(singular > NOTHING * size)[:most]
    components = v @ right[keep].T
    fitted = Whitening(n, sums, singular[keep] ** 2 / n, total / n, components / np.linalg.norm(components, axis=0))
    weights, k = fitted.weights, len(keep)

    def moments(y: np.ndarray) -> np.ndarray:
        w = y @ weights
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])

    found = summed(blocks, d, moments) / n
    covariance = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
    fitted.identity_error = float(np.abs(covariance - np.eye(k)).max())
    return fitted


def apply(blocks: DataFrame, fitted: Whitening) -> DataFrame:
    """id, deviation and whitened (one value per component) of every row of the blocks."""
    d, weights = len(fitted.sums), fitted.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, y in enumerate(batch.column(2)):
                w = np.frombuffer(y.as_buffer()).reshape(-1, d) @ weights
                ends = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i].values, batch.column(1)[i].values]
                    + [pa.ListArray.from_arrays(pa.array(ends), pa.array(w.ravel()))],
                    names=["id", "deviation", "whitened"],
                )

    return blocks.select("ids", "deviations", "y").mapInArrow(run, "id long, deviation long, whitened array<double>")


ROWS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(
    vectors: DataFrame,
    most: int = MOST,
    scale: int = SCALE,
    shift: int = SHIFT,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """A row for each vector and component: vec_id, component (from 1), n, deviation, whitened,
    explained (share of the variance) and identity_error."""
    spark = vectors.sparkSession
    rows = sound(vectors, scale, id_col, vector_col)
    lengths = [r[0] for r in rows.select(F.size("v").alias("d")).filter("d > 0").distinct().orderBy("d").collect()]
    out = spark.createDataFrame([], StructType.fromDDL(ROWS))
    for d in lengths:
        own = rows.filter(F.size("v") == d)
        n, sums = column_sums(own, scale, d)
        bytes_ = 8 * n * d
        tasks = max(math.ceil(bytes_ / MOST_BYTES), min(spark.sparkContext.defaultParallelism, math.ceil(bytes_ / LEAST_BYTES)))
        blocks = materialize(centred(own, scale, n, sums).coalesce(tasks), "centred")
        fitted = fit(blocks, n, sums, most)
        fitted.sums = [s + n * shift for s in sums]
        found = apply(blocks, fitted).select("id", "deviation", F.posexplode("whitened").alias("at", "value"))
        found = found.select(
            F.col("id").alias("vec_id"),
            (F.col("at") + 1).cast("int").alias("component"),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            F.col("value").alias("whitened"),
            F.element_at(F.array(*map(F.lit, fitted.explained or [0.0])), F.col("at") + 1).alias("explained"),
            F.lit(fitted.identity_error).alias("identity_error"),
        )
        out = found if d == lengths[0] else out.unionByName(found)
    return out
