"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics are taken over whole texts inside tasks, written once, and scored by
trees flattened into arrays. Null and empty texts have the statistics of an empty
text and a score like any other. Rows without a label are scored but not learnt
from; where one label, or none, is known, the score is its share (0.5 for none).
Repeated rows are scored each. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywatch.llm.flat import BLANKS, flatten, grams, row_of, slices, words
from paywatch.session import materialize

#: Labelled rows that the fit uses at most; all other steps use every row.
MOST_LABELLED = 20_000
BINS, DEPTH, TREES, RATE, RIDGE = 64, 4, 80, 0.15, 1.0

STATISTICS = (
    "bytes words bytes_per_word upper lower digits blanks breaks wide symbols full_stops commas pipes "
    "byte_entropy distinct_words top_word repeats_previous distinct_pairs distinct_fives lines repeated_lines "
    "repeated_line_bytes longest_line worst_upper worst_symbols worst_repeats worst_pipes"
).split()
#: Words over which the worst stretch of a document is taken.
STRETCH = 48


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _distinct(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, and how often the commonest occurs."""
    owner = row_of(counts)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    n = len(counts)
    if not len(values):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    new = np.r_[True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])]
    runs = np.diff(np.append(np.flatnonzero(new), len(values)))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner[new], runs)
    return np.bincount(owner[new], minlength=n), top


def _gram_distinct(values: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    owner = row_of(counts)
    hashes = grams(values, k)
    inside = np.flatnonzero(owner[: len(hashes)] == owner[k - 1 :]) if len(hashes) else np.zeros(0, np.int64)
    n = np.bincount(owner[inside], minlength=len(counts))
    return _share(_distinct(hashes[inside], n)[0], n) + (n == 0)


def statistics(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of `STATISTICS` per text."""
    n = len(bounds) - 1
    size = np.diff(bounds)
    table = np.bincount(np.repeat(np.arange(n), size) * 256 + flat, minlength=n * 256).reshape(n, 256)
    of = lambda *codes: table[:, list(codes)].sum(1)
    upper, lower = table[:, 65:91].sum(1), table[:, 97:123].sum(1)
    digits, wide = table[:, 48:58].sum(1), table[:, 128:].sum(1)
    p = _share(table, size[:, None])
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(1)
    plain = of(*BLANKS) + upper + lower + digits + wide + of(*b".,;:'\"-()?!")
    values, counts = words(flat, bounds, BLANKS)
    owner = row_of(counts)
    distinct, top = _distinct(values, counts)
    same = np.zeros(len(values), bool)
    if len(values):
        same[1:] = (values[1:] == values[:-1]) & (owner[1:] == owner[:-1])
    lines, line_counts = words(flat, bounds, b"\n")
    line_distinct, line_top = _distinct(lines, line_counts)

    # Stretches of STRETCH words; the worst of each document tells junk inside prose.
    blank = np.isin(flat, np.frombuffer(BLANKS, np.uint8))
    row_of_byte = np.repeat(np.arange(n), size)
    first = np.cumsum(counts) - counts
    begun = np.zeros(len(flat), np.int64)
    if len(flat):
        begun = np.cumsum(~blank & np.r_[True, blank[:-1] | (row_of_byte[1:] != row_of_byte[:-1])])
    nth = np.maximum(begun - 1 - first[row_of_byte], 0) // STRETCH
    per = counts // STRETCH + 1
    base = np.cumsum(per) - per
    at = base[row_of_byte] + nth
    total = int(per.sum())
    filled = np.bincount(at, minlength=total)
    stretch_row = row_of(per)

    def worst(weights: np.ndarray) -> np.ndarray:
        share = np.bincount(at, weights=weights, minlength=total) / np.maximum(filled, 40)
        out = np.zeros(n)
        np.maximum.at(out, stretch_row, share)
        return out

    symbol = np.zeros(256, bool)
    symbol[[*b"#$%&*!|@^~<>=+_{}[]\\/"]] = True
    stretch_of_word = base[owner] + (np.arange(len(values)) - first[owner]) // STRETCH
    repeats = np.bincount(stretch_of_word, weights=same, minlength=total) / STRETCH
    worst_repeats = np.zeros(n)
    np.maximum.at(worst_repeats, stretch_row, repeats)

    columns = [
        np.log1p(size),
        np.log1p(counts),
        _share(size, counts),
        _share(upper, size),
        _share(lower, size),
        _share(digits, size),
        _share(of(*BLANKS), size),
        _share(of(10), counts),
        _share(wide, size),
        _share(size - plain, size),
        _share(of(46), counts),
        _share(of(44), counts),
        _share(of(124), counts),
        entropy,
        _share(distinct, counts),
        _share(top, counts),
        _share(np.bincount(owner[same], minlength=n), counts),
        _gram_distinct(values, counts, 2),
        _gram_distinct(values, counts, 5),
        np.log1p(line_counts),
        1 - _share(line_distinct, line_counts),
        _share(line_top, line_counts),
        _share(size, line_counts),
        worst(((flat >= 65) & (flat <= 90)).astype(float)),
        worst(symbol[flat].astype(float)),
        worst_repeats,
        worst((flat == 124).astype(float)),
    ]
    return np.stack(columns, 1).astype(np.float32) if n else np.zeros((0, len(STATISTICS)), np.float32)


def add_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of `docs` except the text, and `stats`, an array of floats."""
    kept = [f for f in docs.schema if f.name not in (text_col, "stats")]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, bounds = flatten(batch.column(0))
            rows = [statistics(flat[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]) for a, b in slices(bounds)]
            matrix = np.concatenate([*rows, np.zeros((0, len(STATISTICS)), np.float32)])
            ends = np.arange(len(matrix) + 1, dtype=np.int32) * len(STATISTICS)
            stats = pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], stats], names=[*batch.schema.names[1:], "stats"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return docs.select(text_col, *[f"`{f.name}`" for f in kept]).mapInArrow(measure, f"{schema}stats array<float>")


@dataclass(frozen=True)
class Trees:
    """Trees as arrays [tree, node]; the children of node k are 2k + 1 and 2k + 2."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Trees:
    """Boost on logistic loss; splits are sought in histograms of at most BINS bins."""
    nodes, inner = 2 ** (DEPTH + 1) - 1, 2**DEPTH - 1
    share = float(np.mean(y)) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Trees(np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, nodes)), float(np.log(share / (1 - share))))
    n, d = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(d)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], "left") for f in range(d)])
    base = float(np.log(share / (1 - share)))
    total = np.full(n, base)
    feature = np.zeros((trees, nodes), np.int64)
    threshold, value = np.full((trees, nodes), np.inf), np.zeros((trees, nodes))
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for depth in range(DEPTH):
            first, width = 2**depth - 1, 2**depth
            best = np.full(width, 1e-6)
            for f in range(d):
                at = (node - first) * BINS + binned[f]
                left_g = np.bincount(at, g, width * BINS).reshape(width, BINS).cumsum(1)
                left_h = np.bincount(at, h, width * BINS).reshape(width, BINS).cumsum(1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                gain = left_g**2 / (left_h + RIDGE) + (all_g - left_g) ** 2 / (all_h - left_h + RIDGE) - all_g**2 / (all_h + RIDGE)
                gain = np.where((left_h > 0.5) & (all_h - left_h > 0.5), gain, 0)[:, : len(cuts[f])]
                if not gain.size:
                    continue
                k = gain.argmax(1)
                better = np.flatnonzero(gain[np.arange(width), k] > best)
                best[better] = gain[better, k[better]]
                feature[t, first + better] = f
                threshold[t, first + better] = cuts[f][k[better]]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        sums = np.bincount(node, g, nodes) / (np.bincount(node, h, nodes) + RIDGE)
        value[t, inner:] = RATE * sums[inner:]
        total += value[t, node]
    return Trees(feature, threshold, value, base)


def train(measured: DataFrame, labels: DataFrame, label: str, most: int = MOST_LABELLED, id_col: str = "doc_id") -> Trees:
    """Fit on at most about `most` labelled rows, chosen by a hash of the id."""
    known = labels.select(F.col(id_col), F.col(label).cast("double").alias("y")).filter(F.col("y").isNotNull())
    n = known.count()
    if n > most:
        known = known.filter(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)) < int((1 << 30) * most / n))
    rows = measured.select(id_col, "stats").join(known, id_col).toArrow().sort_by([(id_col, "ascending")])
    x = rows["stats"].combine_chunks().flatten().to_numpy().reshape(-1, len(STATISTICS))
    return fit_trees(x, rows["y"].to_numpy())


def score(measured: DataFrame, trees: Trees) -> DataFrame:
    """`score`, the probability of label 1, in place of `stats`."""
    model = measured.sparkSession.sparkContext.broadcast(trees)
    kept = [f for f in measured.schema if f.name not in ("stats", "score")]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(model.value.scores(x))], names=[*batch.schema.names[1:], "score"]
            )

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return measured.select("stats", *[f"`{f.name}`" for f in kept]).mapInArrow(add, f"{schema}score double")


def held_out(doc_id: Column) -> Column:
    """A fifth of the documents, by checksum of the id; labels are learnt from the others."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_LABELLED) -> DataFrame:
    """Id, `held_out` and `score` of every document; texts are read once."""
    measured = materialize(add_statistics(docs.select("text", "doc_id")), "statistics")
    trees = train(measured, labels.filter(~held_out(F.col("doc_id"))), label, most)
    return score(measured, trees).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")


def classify_rows(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_LABELLED) -> DataFrame:
    """`docs`, whole, with `quality_score`.

    Labelled documents are measured first, for the fit; then one pass measures and
    scores every row where it lies, so texts are not shuffled.
    """
    known = labels.filter(~held_out(F.col("doc_id")))
    measured = materialize(add_statistics(docs.select("text", "doc_id")), "statistics")
    model = docs.sparkSession.sparkContext.broadcast(train(measured, known, label, most))
    plain = docs.drop("quality_score")
    place = plain.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, bounds = flatten(batch.column(place))
            rows = [statistics(flat[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]) for a, b in slices(bounds)]
            scores = model.value.scores(np.concatenate([*rows, np.zeros((0, len(STATISTICS)), np.float32)]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "quality_score"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in plain.schema)
    return plain.mapInArrow(add, f"{schema}quality_score double")
