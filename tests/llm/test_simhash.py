"""SimHash fingerprints and groups against plain versions."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from paywatch.llm import simhash
from paywatch.llm.queries import table

PROSE = " ".join(f"word{i} and the {i * 7 % 13} other thing{i % 5}" for i in range(300))
TEXTS = [
    (1, PROSE), (2, PROSE + " end"), (3, PROSE.upper()), (3, PROSE), (4, None), (5, ""), (6, " \t\n"), (7, "one two"),
    (8, "ONE\x0b Two\x0c"), (9, "a b c d"), (10, "a b c d a b c d"), (11, "été " * 5000), (None, PROSE), (None, "alone here"),
    (12, "x" * 200_000 + " y z w v"), (13, "\x1c not\x85a separator\xa0"), (14, "word " * 40_000),
]


def plain_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if runs else 0


def plain_groups(rows, radius=4):
    prints = [(i, plain_print(t)) for i, t in rows]
    values = sorted({p for _, p in prints})
    name = {v: v for v in values}

    def root(v):
        while name[v] != v:
            v = name[v]
        return v

    for k, v in enumerate(values):
        for w in values[k + 1 :]:
            if (v ^ w).bit_count() <= radius:
                name[root(v)] = root(w)
    least = {}
    for i, p in prints:
        if i is not None:
            least[root(p)] = min(least.get(root(p), i), i)
    return sorted(((i, f"{p:016x}", least.get(root(p))) for i, p in prints), key=repr)


def test_hashes_are_those_of_spark(spark):
    texts = ["", "a", "word " * 9, "x" * 31, "y" * 32, "ü" * 40, "z" * 1000, "a b c d"]
    flat = np.frombuffer("".join(texts).encode() + bytes(8), np.uint8)
    lengths = np.array([len(t.encode()) for t in texts])
    ours = simhash.xxh64(flat, np.cumsum(lengths) - lengths, lengths).view(np.int64).tolist()
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(F.xxhash64("t")).collect()
    assert ours == [r[0] for r in rows] and ours[2] == np.uint64(xxhash.xxh64_intdigest("word " * 9, 42)).astype(np.int64)


@pytest.mark.parametrize("size", [1, 8192])
def test_groups_equal_a_full_comparison(spark, size):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumns({"print": F.lit(1), "fingerprint": F.lit("x"), "tile": F.lit(0)})
    got = simhash.groups(docs, size=size)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_groups(TEXTS)


def test_no_documents(spark):
    assert simhash.groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("size", [16, 300])
def test_links_are_complete_over_tiles(spark, size):
    """Chains of single bits around a few centres, in many tiles."""
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = {int(c) for c in centres}
    for c in centres.tolist():
        for _ in range(12):
            for b in rng.choice(64, int(rng.integers(1, 7)), replace=False).tolist():
                c ^= 1 << b
            values.add(c & (1 << 64) - 1)
    values = np.array(sorted(values), np.uint64)
    prints = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "print long")
    edges = [(int(np.int64(a).view(np.uint64)), int(np.int64(b).view(np.uint64))) for a, b in simhash.links(prints, 4, size).collect()]

    def parts(pairs):
        name = {int(v): int(v) for v in values}

        def root(v):
            while name[v] != v:
                v = name[v]
            return v

        for a, b in pairs:
            name[root(a)] = root(b)
        groups = {}
        for v in name:
            groups.setdefault(root(v), set()).add(v)
        return {frozenset(g) for g in groups.values()}

    every = [(int(a), int(b)) for k, a in enumerate(values) for b in values[k + 1 :] if (int(a) ^ int(b)).bit_count() <= 4]
    assert parts(edges) == parts(every) and len(every) > 300


def test_a_dense_group_gives_few_edges():
    """All words within two bits of one: thousands of links, fewer edges than words."""
    words = np.unique(np.array([1 << a | 1 << b for a in range(64) for b in range(64)], np.uint64))
    edges = simhash.linked(words, None, 4)
    assert len(edges) == len(words) - 1
    both = simhash.linked(words[::2].copy(), words[1::2].copy(), 4)
    assert len(both) < len(words)


def test_tiles_far_apart_are_skipped():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 1 << 63, 200_000, dtype=np.uint64)
    cells, counts = np.unique(simhash.cell_of(values), return_counts=True)
    tiling = simhash.Tiling(cells, counts, 4, 500)
    met = sum(len(tiling.partners(t)) for t in range(len(tiling.parts)))
    assert met < 0.45 * len(tiling.parts) * (len(tiling.parts) + 1) / 2
    tile = tiling.tile[simhash.cell_of(values)]
    for k in range(0, 2000, 7):
        for b in range(0, 64, 16):
            other = tiling.tile[simhash.cell_of(values[k : k + 1] ^ np.uint64(0xF << b))][0]
            assert other < 0 or max(tile[k], other) in tiling.partners(min(tile[k], other))


def test_whole_table_of_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, simhash.groups(docs).collect()), key=repr) == plain_groups(rows)
