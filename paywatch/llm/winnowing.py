"""Benchmark decontamination by winnowing.

Every `SPAN` consecutive words of a benchmark item are a window; a shorter item is
one window. Of each window the smallest k-gram hash is its fingerprint (the last,
if several are equal). A document's window can only equal an item's if its
fingerprint is one of the items', so only such windows are compared as a whole:
every shared span of at least `SPAN` words is found. Windows that occur mark their
words, and marked words merge into spans.

The items' fingerprints and windows travel to the tasks in blocks of a checked
size; documents are read once and never shuffled. Null or empty texts have no
words; items without words, or an empty benchmark, match nothing. An item without
an id is listed under ''. Repeated rows are judged each. All columns of the
documents stay; for `mark`, one named like a column it adds is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywatch.llm.aside import refuse, set_aside
from paywatch.llm.flat import BASE, NOT_ALPHANUMERIC, U64, flatten, grams, mix, row_of, slices, words

SPAN, GRAM = 10, 5
#: Bytes of benchmark text in one block.
BLOCK_BYTES = 16 << 20
ADDED = ("n_words", "hit_spans", "hit_items")
SPANS = "array<struct<begin: int, end: int>>"


def window_hashes(values: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    out = np.zeros(len(starts), U64)
    for i in range(length):
        out = out * BASE + values[starts + i]
    return mix(out + U64(length))


def fingerprints(values: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Fingerprint of each window: its smallest k-gram hash."""
    k = min(GRAM, length) if length == SPAN else length
    hashes = grams(values, k)
    best = hashes[starts]
    for i in range(1, length - k + 1):
        best = np.minimum(best, hashes[starts + i])
    return best


def window_starts(counts: np.ndarray, length: int) -> np.ndarray:
    """Where windows of `length` words begin, none across two texts."""
    owner = row_of(counts)
    if len(owner) < length:
        return np.zeros(0, np.int64)
    return np.flatnonzero(owner[: len(owner) - length + 1] == owner[length - 1 :])


def item_windows(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per window of each item: its length in words, fingerprint and hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, bounds = flatten(batch.column(1))
            for low, high in slices(bounds):
                part = flat[bounds[low] : bounds[high]]
                values, counts = words(part, bounds[low : high + 1] - bounds[low], NOT_ALPHANUMERIC)
                owner = row_of(counts)
                for length in range(1, SPAN + 1):
                    starts = window_starts(counts, length)
                    if length < SPAN:
                        starts = starts[counts[owner[starts]] == length]
                    if len(starts):
                        ids = batch.column(0).take(pa.array(owner[starts] + low))
                        yield pa.RecordBatch.from_arrays(
                            [
                                ids,
                                pa.array(np.full(len(starts), length, np.int32)),
                                pa.array(fingerprints(values, starts, length).view(np.int64)),
                                pa.array(window_hashes(values, starts, length).view(np.int64)),
                            ],
                            names=["item", "length", "fingerprint", "hash"],
                        )

    texts = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col))
    return texts.mapInArrow(cut, "item string, length int, fingerprint long, hash long").distinct()


class Index:
    """Windows of one block of items, by length."""

    def __init__(self, rows: pa.Table):
        length = rows["length"].to_numpy()
        prints, hashes = (rows[c].to_numpy().view(np.uint64) for c in ("fingerprint", "hash"))
        names = rows["item"].combine_chunks().dictionary_encode()
        self.items = np.array(names.dictionary.to_pylist(), dtype=object)
        item = names.indices.to_numpy(zero_copy_only=False)
        self.by_length = {}
        for n in np.unique(length):
            mine = np.flatnonzero(length == n)
            mine = mine[np.argsort(hashes[mine], kind="stable")]
            found, first = np.unique(hashes[mine], return_index=True)
            self.by_length[int(n)] = (np.unique(prints[mine]), found, np.append(first, len(mine)), item[mine])


def member(sorted_values: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x, at


def hits(values: np.ndarray, counts: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Which words some window covers, and the (text, item) pairs met."""
    step = np.zeros(len(values) + 1, np.int64)
    owner = row_of(counts)
    pairs = [np.zeros((0, 2), np.int64)]
    for length, (prints, hashes, first, items) in index.by_length.items():
        starts = window_starts(counts, length)
        if not len(starts):
            continue
        likely = starts[member(prints, fingerprints(values, starts, length))[0]]
        held, at = member(hashes, window_hashes(values, likely, length))
        likely, at = likely[held], at[held]
        np.add.at(step, likely, 1)
        np.add.at(step, likely + length, -1)
        met = np.unique(np.stack([owner[likely], at], 1), axis=0)
        n = first[met[:, 1] + 1] - first[met[:, 1]]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pairs.append(np.stack([np.repeat(met[:, 0], n), items[np.repeat(first[met[:, 1]], n) + within]], 1))
    return np.cumsum(step[:-1]) > 0, np.unique(np.concatenate(pairs), axis=0)


def _merged(known: list, more: list) -> list:
    out: list = []
    for begin, end in sorted((*known, *more)):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def mark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """`docs` with `n_words`, `hit_spans` (word ranges covered by windows) and `hit_items`.

    Beyond one block of benchmark text, further blocks follow in the same pass.
    """
    refuse(docs, ADDED)
    size = benchmark.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    out = docs.withColumns(
        {
            "n_words": F.lit(0).cast("long"),
            "hit_spans": F.array().cast(SPANS),
            "hit_items": F.array().cast("array<string>"),
        }
    )
    schema = out.schema
    for block in range(blocks):
        mine = benchmark.filter(F.pmod(F.xxhash64(item_id), F.lit(blocks)) == block) if blocks > 1 else benchmark
        lookup = docs.sparkSession.sparkContext.broadcast(Index(item_windows(mine, item_id, item_text).toArrow()))

        def pass_over(batches: Iterator[pa.RecordBatch], lookup=lookup) -> Iterator[pa.RecordBatch]:
            index = lookup.value
            for batch in batches:
                names = batch.schema.names
                flat, bounds = flatten(batch.column(names.index(text_col)))
                n_words, spans, items = [], batch.column(names.index("hit_spans")).to_pylist(), batch.column(names.index("hit_items")).to_pylist()
                for low, high in slices(bounds):
                    part = flat[bounds[low] : bounds[high]]
                    values, counts = words(part, bounds[low : high + 1] - bounds[low], NOT_ALPHANUMERIC)
                    n_words.append(counts)
                    covered, pairs = hits(values, counts, index)
                    if not covered.any():
                        continue
                    firsts = np.cumsum(counts) - counts
                    owner = row_of(counts)
                    edge = covered & np.r_[True, ~covered[:-1] | (owner[1:] != owner[:-1])]
                    close = covered & np.r_[~covered[1:] | (owner[1:] != owner[:-1]), True]
                    new: dict[int, list] = {}
                    for begin, end in zip(np.flatnonzero(edge).tolist(), (np.flatnonzero(close) + 1).tolist(), strict=True):
                        row = int(owner[begin])
                        new.setdefault(row, []).append((begin - int(firsts[row]), end - int(firsts[row])))
                    for row, more in new.items():
                        known = [(s["begin"], s["end"]) for s in spans[low + row]]
                        spans[low + row] = [{"begin": a, "end": b} for a, b in _merged(known, more)]
                    for row, item in pairs.tolist():
                        items[low + row] = [*items[low + row], index.items[item]]
                put = {
                    "n_words": pa.array(np.concatenate(n_words) if n_words else np.zeros(0, np.int64)),
                    "hit_spans": pa.array(spans, batch.column(names.index("hit_spans")).type),
                    "hit_items": pa.array([sorted(set(x)) if x else x for x in items], pa.list_(pa.string())),
                }
                yield pa.RecordBatch.from_arrays([put.get(c, batch.column(c)) for c in names], names=names)

        out = out.mapInArrow(pass_over, schema)
    return out


def digest(marked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per document and a checksum of the items met."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["begin"]))
    return marked.select(
        id_col,
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, **names: str) -> DataFrame:
    """The documents that hold no window of the benchmark, with all their columns unchanged."""
    docs, restore = set_aside(docs, ADDED)
    return restore(mark(docs, benchmark, **names).filter(F.size("hit_spans") == 0).drop(*ADDED))
