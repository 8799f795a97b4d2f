"""Near-duplicate documents by SimHash fingerprints, compared exactly in tiles.

A text is lower-cased (A to Z) and cut into words at space and the controls tab to
carriage return. Its features are the hashes of all runs of four words, repeats included
(with fewer words, the whole sequence). Bit i of the fingerprint is 1 where more than half
of the hashes have it. Null, empty and wordless texts have fingerprint zero, and are linked
like any other. Fingerprints that differ in at most `radius` bits are linked; groups are
the connected components.

Only distinct fingerprints are compared, so copies meet nobody. They are dealt to tiles by
population counts: that of the whole word and those of its four quarters. Two words differ
in at least as many bits as their population counts do, and in at least as many as those of
the quarters do in sum, so tile pairs whose counts lie further apart than the radius are
skipped without a look. All other pairs of tiles are compared, bit for bit, by exclusive-or
and bit count; nothing is sampled or bucketed. A task unites what it finds and hands on a
spanning forest, so links inside a group never become rows for all its pairs. The work grows
with the square of the number of distinct fingerprints, divided by what the tiles let skip,
and the skipped share rises with the number of tiles.

The plan of the tiles is made from a histogram of the quarters' counts, which has at most
17^4 = 83,521 cells however many documents there are.

Rows are judged by themselves: repeated rows and repeated ids each get an answer, and equal
texts the same. A row without an id is linked like any other but never names a group; a
group of only such rows has a null name. Extra columns are ignored. A text is held whole
by one task, with about nine bytes of working memory per byte of text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywatch.llm.components import components
from paywatch.llm.flat import U64, flatten, slices
from paywatch.session import materialize

WORDS_PER_SHINGLE = 4
SEED = 42
#: Fingerprints of one tile, and the number of tiles beyond which tiles are cut by hash.
TILE, MOST_TILES = 8192, 4096
#: Words hashed at a time.
CHUNK = 1 << 14
#: A to Z in lower case, every separator a space.
PLAIN = bytes.maketrans(bytes(range(65, 91)) + bytes(range(9, 14)), bytes(range(97, 123)) + b" " * 5)
CELLS = 17**4
#: Fixed values of XXH64.
PRIMES = np.array(
    [11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261], np.uint64
)


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << U64(bits)) | (x >> U64(64 - bits))


def _step(accumulator: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(accumulator + lane * PRIMES[1], 31) * PRIMES[0]


def xxh64(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of many stretches of one byte array, which must go on for eight bytes after the last."""
    p1, p2, p3, p4, p5 = (PRIMES[k : k + 1] for k in range(5))
    lanes = np.ndarray(len(flat) - 7, "<u8", flat, strides=(1,))
    rest = lengths % 32
    order = np.argsort(-rest.astype(np.int8), kind="stable")
    starts, lengths, rest = starts[order], lengths[order], rest[order]
    h = np.full(len(starts), seed, U64) + p5
    long = np.flatnonzero(lengths >= 32)
    if len(long):
        stripes, at = lengths[long] // 32, starts[long]
        acc = [np.full(len(long), seed, U64) + offset for offset in (p1 + p2, p2, 0 * p1, 0 * p1 - p1)]
        for turn in range(int(stripes.max())):
            on = np.flatnonzero(stripes > turn)
            for k in range(4):
                acc[k][on] = _step(acc[k][on], lanes[at[on] + 32 * turn + 8 * k])
        whole = _turn(acc[0], 1) + _turn(acc[1], 7) + _turn(acc[2], 12) + _turn(acc[3], 18)
        for k in range(4):
            whole = (whole ^ _step(U64(0), acc[k])) * p1 + p4
        h[long] = whole
    h += lengths.astype(U64)
    at = starts + (lengths - rest)
    for k in range(3):
        m = int(np.searchsorted(-rest, -(8 * k + 8), "right"))
        h[:m] = _turn(h[:m] ^ _step(U64(0), lanes[at[:m] + 8 * k]), 27) * p1 + p4
    at += rest & ~7
    on = np.flatnonzero(rest & 4)
    h[on] = _turn(h[on] ^ (lanes[at[on]] & U64(0xFFFFFFFF)) * p1, 23) * p2 + p3
    at += rest & 4
    for k in range(3):
        on = np.flatnonzero((rest & 3) > k)
        h[on] = _turn(h[on] ^ flat[at[on] + k] * p5, 11) * p1
    h = (h ^ (h >> U64(33))) * p2
    h = (h ^ (h >> U64(29))) * p3
    out = np.empty_like(h)
    out[order] = h ^ (h >> U64(32))
    return out


def ones(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """[stretch, bit]: how many hashes of each stretch have the bit; `firsts` says where stretches begin."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
    return np.add.reduceat(bits, firsts, axis=0, dtype=np.int64)


def tidy(text: bytes) -> bytes:
    """The text in lower case, its words apart by one space each."""
    text = text.translate(PLAIN)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text.strip(b" ")


def fingerprints_of(texts: list[bytes], words: int = WORDS_PER_SHINGLE) -> np.ndarray:
    """Fingerprints of texts in UTF-8."""
    texts = [tidy(t) for t in texts]
    out = np.zeros(len(texts), U64)
    own = np.array([i for i, t in enumerate(texts) if t], np.int64)
    if not len(own):
        return out
    texts = [texts[i] for i in own.tolist()]
    flat = np.frombuffer(b" ".join(texts) + bytes(8), np.uint8)
    gaps = np.flatnonzero(flat == 32)
    starts, ends = np.r_[0, gaps + 1], np.r_[gaps, len(flat) - 8]
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    first = np.searchsorted(starts, bounds)  # word at which each text begins
    counts = np.maximum(np.diff(first) - words + 1, 1)  # shingles of each text
    owner = np.repeat(np.arange(len(texts)), counts)
    begin = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + first[owner]
    last = np.minimum(begin + words, first[owner + 1]) - 1
    found = np.zeros((len(texts), 64), np.int64)
    for at in range(0, len(owner), CHUNK):
        part = slice(at, at + CHUNK)
        begins = starts[begin[part]]
        hashes = xxh64(flat, begins, ends[last[part]] - begins)
        firsts = np.flatnonzero(np.r_[True, owner[part][1:] != owner[part][:-1]])
        found[owner[part][firsts]] += ones(hashes, firsts)
    bits = np.packbits(2 * found > counts[:, None], axis=1, bitorder="little")
    out[own] = bits.view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and print, a long with the bits of the fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, bounds = flatten(batch.column(1))
            for low, high in slices(bounds):
                cuts = bounds[low : high + 1].tolist()
                prints = fingerprints_of([flat[a:b].tobytes() for a, b in pairwise(cuts)]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(prints)], names=["doc_id", "print"]
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, print long")


def cell_of(prints: np.ndarray) -> np.ndarray:
    """The population counts of the four quarters, as one number."""
    quarters = np.bitwise_count(prints.astype("<u8").view("<u2").reshape(-1, 4)).astype(np.int64)
    return ((quarters[:, 0] * 17 + quarters[:, 1]) * 17 + quarters[:, 2]) * 17 + quarters[:, 3]


class Tiling:
    """Which tile a cell belongs to, how many parts a tile has, and which tiles may hold links."""

    def __init__(self, cells: np.ndarray, counts: np.ndarray, radius: int, size: int = TILE):
        quarters = np.stack([cells // 17**k % 17 for k in (3, 2, 1, 0)], 1)
        sides = np.concatenate([quarters.sum(1, keepdims=True), quarters], 1)
        most = max(size, math.ceil(counts.sum() / MOST_TILES))
        tiles, todo = [], [np.arange(len(cells))] if len(cells) else []
        while todo:
            own = todo.pop()
            if counts[own].sum() <= most or len(own) == 1:
                tiles.append(own)
                continue
            spread = [np.cov(sides[own, k], fweights=counts[own]) for k in range(5)]
            own = own[np.argsort(sides[own, int(np.argmax(spread))], kind="stable")]
            half = int(np.searchsorted(np.cumsum(counts[own]), counts[own].sum() / 2)) + 1
            half = min(half, len(own) - 1)
            todo += [own[:half], own[half:]]
        self.tile = np.full(CELLS, -1, np.int32)
        for k, own in enumerate(tiles):
            self.tile[cells[own]] = k
        self.parts = np.array([max(1, math.ceil(counts[own].sum() / size)) for own in tiles], np.int64)
        self.low = np.array([sides[own].min(0) for own in tiles]).reshape(-1, 5)
        self.high = np.array([sides[own].max(0) for own in tiles]).reshape(-1, 5)
        self.radius = radius

    def partners(self, tile: int) -> np.ndarray:
        """Tiles from this one on whose population counts allow a link with it."""
        gaps = np.maximum(0, np.maximum(self.low[tile:] - self.high[tile], self.low[tile] - self.high[tile:]))
        return tile + np.flatnonzero((gaps[:, 0] <= self.radius) & (gaps[:, 1:].sum(1) <= self.radius))


def linked(left: np.ndarray, right: np.ndarray | None, radius: int) -> np.ndarray:
    """Edges [n, 2] that connect whatever is linked between two tiles, or within one (right is None)."""
    nodes = left if right is None else np.concatenate([left, right])
    other, first = (left, 0) if right is None else (right, len(left))
    parent = np.arange(len(nodes))
    edges = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    # A strip stays in the processor's cache, and so few hits are held at a time.
    high, wide = 32, 8192
    differ, many = np.empty((high, wide), U64), np.empty((high, wide), np.uint8)
    for i in range(0, len(left), high):
        strip = left[i : i + high, None]
        for j in range(i if right is None else 0, len(other), wide):
            against = other[None, j : j + wide]
            shape = np.s_[: len(strip), : against.shape[1]]
            bits = np.bitwise_count(np.bitwise_xor(strip, against, out=differ[shape]), out=many[shape])
            if right is None and j == i:
                bits[:, : len(strip)][np.tri(len(strip), dtype=bool)] = 65
            if bits.min() > radius:
                continue
            a, b = np.nonzero(bits <= radius)
            pairs = np.stack([parent[a + i], parent[b + j + first]], 1)
            for x, y in np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0).tolist():
                x, y = root(x), root(y)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    edges.append((nodes[x], nodes[y]))
        while not np.array_equal(parent, up := parent[parent]):
            parent = up
    return np.array(edges, np.uint64).reshape(-1, 2)


def links(prints: DataFrame, radius: int, size: int = TILE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect each to all it is linked with.

    `prints` has a long column print without repeats."""
    spark = prints.sparkSession

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts = np.unique(cell_of(batch.column(0).to_numpy().view(np.uint64)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts)], names=["cell", "n"])

    histogram = prints.mapInArrow(cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    order = np.argsort(histogram["cell"].to_numpy())
    tiling = Tiling(histogram["cell"].to_numpy()[order], histogram["n"].to_numpy()[order], radius, size)
    sent = spark.sparkContext.broadcast(tiling)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            tile = sent.value.tile[cell_of(values)]
            part = (values * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % sent.value.parts[tile]
            yield pa.RecordBatch.from_arrays(
                [pa.array(tile), pa.array(part.astype(np.int32)), batch.column(0)], names=["tile", "part", "print"]
            )

    def pack(group: pa.Table) -> pa.Table:
        values = np.sort(group["print"].to_numpy())
        return pa.table(
            {"tile": group["tile"][:1], "part": group["part"][:1], "prints": pa.array([values.tobytes()], pa.binary())}
        )

    placed = prints.select("print").mapInArrow(place, "tile int, part int, print long")
    tiles = materialize(
        placed.groupBy("tile", "part").applyInArrow(pack, "tile int, part int, prints binary"), "tiles"
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each tile that a part of a tile has to be compared with."""
        for batch in batches:
            for i, tile in enumerate(batch.column(0).to_pylist()):
                partners = sent.value.partners(tile)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).take(pa.array(np.full(len(partners), i))) for k in (0, 1)]
                    + [pa.array(partners.astype(np.int32))],
                    names=["tile", "part", "partner"],
                )

    asked = tiles.select("tile", "part").mapInArrow(meet, "tile int, part int, partner int")
    held = tiles.select(F.col("tile").alias("partner"), F.col("part").alias("partner_part"))
    pairs = asked.join(held, "partner").filter("tile < partner OR part <= partner_part")
    # The pairs are dealt out evenly before the fingerprints are put in.
    pairs = materialize(pairs.select("tile", "part", "partner", "partner_part"), "tile-pairs")
    left = tiles.select("tile", "part", F.col("prints").alias("x"))
    right = tiles.select(F.col("tile").alias("partner"), F.col("part").alias("partner_part"), F.col("prints").alias("y"))
    ready = pairs.join(left, ["tile", "part"]).join(right, ["partner", "partner_part"])
    tasks = min(10_000, max(1, math.ceil(pairs.count() / 4)))
    ready = ready.repartition(tasks, "tile", "part", "partner", "partner_part")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                edges = linked(x, None if np.array_equal(x, y) else y, radius).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["a", "b"])

    return ready.select("x", "y").mapInArrow(compare, "a long, b long")


def groups(
    docs: DataFrame, radius: int = 4, id_col: str = "doc_id", text_col: str = "text", size: int = TILE
) -> DataFrame:
    """Per row of `docs`: doc_id, fingerprint (16 hexadecimal digits) and component_id, the
    smallest id of all documents it is linked with, directly or over others."""
    known = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = materialize(known.groupBy("print").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    edges = materialize(links(classes.select("print"), radius, size), "fingerprint-links")
    roots = components(edges).withColumnRenamed("node", "print")
    # Only linked fingerprints need the smallest id of their component.
    named = classes.join(roots, "print")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    linked_names = named.select("print", "root").join(least, "root").select("print", F.col("component_id").alias("shared"))
    names = classes.join(linked_names, "print", "left").select(
        "print", F.coalesce("shared", "least").alias("component_id")
    )
    # Written first: a join of two plain exchanges is one whose hot keys, the prints of many
    # copies, Spark can split.
    names = materialize(names, "fingerprint-names")
    return known.join(names, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
