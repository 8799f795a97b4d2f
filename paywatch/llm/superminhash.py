"""Near-duplicate documents by SuperMinHash, banding, verification and union-find.

A document is the set of its distinct five-word shingles (with fewer words, the whole
sequence; without words, empty and linked with nothing). Each shingle visits the
components of the signature in an order of its own, and its value at its j-th visit
lies between j and j + 1. So the values of one shingle are correlated ranks, which
lowers the variance, and a pass may end as soon as every component is below j + 1.

Documents of equal sets are one class, named by the smallest id. Bands of the
signature gather candidates among classes; links are confirmed on the full sets.
In each bucket every class first meets the smallest, the head. What that leaves
unconnected is compared inside tasks, block against block, by signature and then on the
full sets, and only links that connect come out; no bucket is expanded into rows for all
its pairs.

Null texts have no words. Rows that repeat, with one id, form one document and get
the same answer. A row without an id belongs to the group of an equal set; alone, it
is its own group with a null name. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywatch.llm.components import components
from paywatch.llm.flat import BASE, BLANKS, U64, flatten, grams, mix, row_of, slices, words
from paywatch.session import materialize

WORDS_PER_SHINGLE = 5
BANDS, ROWS = 32, 5
#: Length of a signature: a prime, so that steps of any size visit every component.
LENGTH = 257
#: Components kept, as a byte each, to tell unlikely pairs.
WIDTH = 256
#: Classes, and bytes of their sets, that one task compares with as many others at most.
BLOCK, BLOCK_BYTES = 4096, 1 << 23
#: Smaller circles are spread as well: blocks of this size, as long as there are no more than so many.
SMALL_BLOCK, SMALL_BLOCKS = 256, 16
#: Ids, of eight bytes each, that are sent to all tasks at most.
MOST_SENT = 1 << 21
MASK = (1 << 64) - 1


def shingles(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and their numbers."""
    values, counts = words(flat, bounds, BLANKS)
    k = WORDS_PER_SHINGLE
    owner = row_of(counts)
    hashes = grams(values, k)
    inside = np.flatnonzero(owner[: len(hashes)] == owner[k - 1 :]) if len(hashes) else np.zeros(0, np.int64)
    found, rows = [hashes[inside]], [owner[inside]]
    first = np.cumsum(counts) - counts
    for n in range(1, k):
        short = np.flatnonzero(counts == n)
        whole = np.zeros(len(short), U64)
        for i in range(n):
            whole = whole * BASE + values[first[short] + i]
        found.append(mix(whole + U64(n)))
        rows.append(short)
    hashes, owner = np.concatenate(found), np.concatenate(rows)
    order = np.argsort(owner, kind="stable")
    hashes, owner = hashes[order], owner[order]
    sizes = np.bincount(owner, minlength=len(counts))
    ends = np.cumsum(sizes)
    for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        if b - a > 1:
            hashes[a:b].sort()
    if len(hashes):
        new = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])]
        hashes, owner = hashes[new], owner[new]
    return hashes, np.bincount(owner, minlength=len(counts))


def signatures(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """[text, component]: step j above 54 random bits."""
    n = len(counts)
    out = np.full(n * LENGTH, np.iinfo(np.uint64).max, U64)
    owner = row_of(counts)
    seed = mix(hashes ^ U64(0xA0761D6478BD642F))
    place, stride = seed % U64(LENGTH), U64(1) + (seed >> U64(32)) % U64(LENGTH - 1)
    for j in range(LENGTH):
        value = U64(j << 54) | (mix(hashes + U64(j * int(BASE) & MASK)) >> U64(10))
        np.minimum.at(out, owner * LENGTH + place.astype(np.int64), value)
        done = out.reshape(n, LENGTH).max(1) < U64((j + 1) << 54)
        going = ~done[owner]
        if not going.any():
            break
        hashes, owner, place, stride = hashes[going], owner[going], place[going], stride[going]
        place = (place + stride) % U64(LENGTH)
    return out.reshape(n, LENGTH)


def likeness(percent: int) -> float:
    """Share of equal signature bytes below which a pair is not looked at: 4.5 standard
    deviations below the threshold."""
    p = percent / 100
    return p - 4.5 * math.sqrt(p * (1 - p) / WIDTH)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    parts = signature[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
    out = np.broadcast_to(np.arange(BANDS, dtype=U64) + U64(1), parts.shape[:2]).copy()
    for i in range(ROWS):
        out = mix(out * BASE + parts[:, :, i])
    return out.view(np.int64)


def _lists(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))


def sign(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Set size, 128-bit digest of the set, band hashes and one byte per component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, bounds = flatten(batch.column(1))
            for low, high in slices(bounds):
                hashes, counts = shingles(flat[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low])
                owner = row_of(counts)
                sums = np.zeros((2, len(counts)), U64)
                np.add.at(sums[0], owner, hashes)
                np.add.at(sums[1], owner, mix(hashes + U64(77)))
                signature = signatures(hashes, counts)
                small = (mix(signature[:, :WIDTH]) >> U64(56)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(counts.astype(np.int64)),
                        pa.array(sums[0].view(np.int64)),
                        pa.array(sums[1].view(np.int64)),
                        _lists(band_hashes(signature)),
                        pa.array([small[i].tobytes() for i in range(len(small))], pa.binary()),
                    ],
                    names=["doc_id", "n", "d1", "d2", "bands", "signature"],
                )

    schema = "doc_id long, n long, d1 long, d2 long, bands array<long>, signature binary"
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, schema)


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose set sizes and signatures leave a link possible."""
    left = classes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("s_a"))
    right = classes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("s_b"))
    joined = pairs.join(left, "a").join(right, "b").filter(
        F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    )
    least = likeness(percent)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(n, WIDTH) for i in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((a == b).mean(1) >= least))

    return joined.select("a", "b", "s_a", "s_b").mapInArrow(keep, "a long, b long")


def shingle_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, bounds = flatten(batch.column(1))
            for low, high in slices(bounds):
                hashes, counts = shingles(flat[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low])
                ends = np.cumsum(counts)
                sets = [hashes[b - n : b].tobytes() for b, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(sets, pa.binary())], names=["node", "shingles"]
                )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "node long, shingles binary")


def sets_of(nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles) of the given nodes, made once for all steps that need sets.

    As long as the list of nodes is short enough to be sent to all tasks, the texts stay where
    they are; beyond that they are shuffled once."""
    nodes = materialize(nodes.select("node").distinct(), "wanted")
    nodes = F.broadcast(nodes) if nodes.count() <= MOST_SENT else nodes
    wanted = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
    wanted = wanted.join(nodes, "node", "left_semi")
    return materialize(shingle_sets(wanted, "node", "text").dropDuplicates(["node"]), "shingles")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union, on the full sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                common = len(x) + len(y) - len(np.union1d(x, y))
                held.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(held, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def among(met: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that connect the classes that met one head and are not yet connected.

    Whatever shares a bucket has met that bucket's head, so all pairs of buckets are
    among these. A large circle is cut into blocks by rows and by bytes, and each task
    compares two blocks: likely pairs are confirmed there, on the full sets, unless what was
    found before already connects them. Only links that connect leave the task, fewer
    than the rows of its two blocks; refuted pairs never become rows.
    """
    met = met.select("head", "node", F.coalesce("root", "node").alias("comp"))
    sized = met.join(classes.select("node", "n"), "node")
    size = sized.groupBy("head").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("rows"), F.sum("n").alias("values")
    )
    spread = F.least(F.ceil(F.col("rows") / SMALL_BLOCK), F.lit(SMALL_BLOCKS))
    blocks = F.greatest(spread, F.ceil(F.col("rows") / BLOCK), F.ceil(F.col("values") * 8 / BLOCK_BYTES)).cast("int")
    # Written first: a join of two plain exchanges is one whose hot keys Spark can split.
    circles = materialize(size.filter("low < high").select("head", blocks.alias("blocks")), "circles")
    inside = met.join(circles, "head")
    rows = inside.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # A pair that met several heads is left to the first of them.
    common = met.groupBy("node").agg(F.sort_array(F.collect_set("head")).alias("heads"))
    rows = rows.select(
        "head", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "comp"
    ).join(common, "node").join(classes.select("node", "n", "signature"), "node").join(sets, "node")
    rows = rows.repartition("head", "i", "j").sortWithinPartitions("head", "i", "j")
    least = likeness(percent)

    def compare(group: pa.Table) -> pa.RecordBatch:
        own, node, comp, n = (group[c].to_numpy() for c in ("own", "node", "comp", "n"))
        signature = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint8).reshape(-1, WIDTH)
        head, heads = group["head"][0].as_py(), [set(x) for x in group["heads"].to_pylist()]
        sets = [np.frombuffer(x.as_buffer(), U64) for x in group["shingles"]]
        same = group["i"][0] == group["j"][0]
        first = np.flatnonzero(own == group["i"][0].as_py())
        second = first if same else np.flatnonzero(own != group["i"][0].as_py())
        joined = np.unique(comp, return_inverse=True)[1]
        links = []
        for k, x in enumerate(first.tolist()):
            may = second[k + 1 :] if same else second
            may = may[joined[may] != joined[x]]
            low, high = np.minimum(n[may], n[x]), np.maximum(n[may], n[x])
            may = may[low * 100 >= high * percent]
            alike = (signature[may] == signature[x]).mean(1)
            likely = np.flatnonzero(alike >= least)
            may = may[likely[np.argsort(-alike[likely], kind="stable")]]
            may = np.array([y for y in may.tolist() if min(heads[x] & heads[y]) == head], np.int64)
            while len(may):
                part, may = may[:64], may[64:]
                shingles = np.concatenate([sets[y] for y in part.tolist()])
                place = np.minimum(np.searchsorted(sets[x], shingles), len(sets[x]) - 1)
                shared = np.add.reduceat((sets[x][place] == shingles).astype(np.int64), np.cumsum(n[part]) - n[part])
                for y in part[100 * shared >= percent * (n[x] + n[part] - shared)].tolist():
                    if joined[y] != joined[x]:
                        links.append((node[x], node[y]))
                        joined[joined == joined[y]] = joined[x]
                may = may[joined[may] != joined[x]]
        pairs = np.array(links, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in (1, 2, 3)], 1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(key)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b > a:
                    if held and held[-1].select(["head", "i", "j"]).slice(0, 1).to_pylist() != batch.select([1, 2, 3]).slice(a, 1).to_pylist():
                        yield compare(pa.concat_tables(held))
                        held = []
                    held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
        if held:
            yield compare(pa.concat_tables(held))

    columns = ["node", "head", "i", "j", "own", "comp", "n", "signature", "heads", "shingles"]
    return rows.select(*columns).mapInArrow(run, "a long, b long")


def links(docs: DataFrame, classes: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(node, root) for every class linked to another."""
    # Sets that differ reach the threshold only if large enough to lack one of their union.
    least = 1
    while 100 * least < percent * (least + 1):
        least += 1
    members = classes.filter(F.col("n") >= least).select(F.explode("bands").alias("key"), "node", "n")
    shared = members.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    members = members.join(shared.select("key"), "key")
    # Linked sets differ little in size: each bucket falls into overlapping bins of size,
    # such that two sets whose sizes allow a link meet in one.
    width = math.log(100 / percent) * 1.001
    size_bin = F.floor(F.log(F.col("n").cast("double")) / width)
    members = members.select(
        F.col("node").alias("node"),
        F.col("node").alias("comp"),
        F.explode(F.transform(F.array(F.lit(0), F.lit(1)), lambda i: F.xxhash64("key", size_bin + i))).alias("key"),
    )
    buckets = materialize(members, "buckets")
    heads = buckets.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last")).filter("head < last")
    met = materialize(buckets.join(heads, "key").select("head", "node").distinct(), "met")
    pairs = met.filter("head <> node").select(F.col("head").alias("a"), F.col("node").alias("b"))
    sets = sets_of(met, docs, id_col, text_col)
    found = confirm(materialize(likely(pairs, classes, percent), "pairs"), sets, percent)
    found = materialize(found, "links")
    roots = components(found)
    rest = among(met.join(roots, "node", "left"), classes, sets, percent)
    rest = materialize(rest, "links")
    return roots if rest.isEmpty() else components(found.unionByName(rest))


def groups(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id (smallest id reachable) and kept."""
    signed = materialize(sign(docs, id_col, text_col), "signatures")
    classes = materialize(
        signed.filter("n > 0 AND doc_id IS NOT NULL")
        .groupBy("n", "d1", "d2")
        .agg(F.min(F.struct("doc_id", "bands", "signature")).alias("least"))
        .select("n", "d1", "d2", "least.*")
        .withColumnRenamed("doc_id", "node"),
        "classes",
    )
    roots = links(docs, classes, percent, id_col, text_col)
    named = classes.select("n", "d1", "d2", "node").join(roots, "node", "left")
    named = named.select("n", "d1", "d2", F.coalesce("root", "node").alias("component_id"))
    own = signed.select("doc_id", "n", "d1", "d2").join(named, ["n", "d1", "d2"], "left")
    own = own.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return own.select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def dedupe(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of near duplicates, with all columns.

    Of rows that repeat an id and its text one stays. Rows without an id are not judged
    and stay; so do different texts under the id that is kept.
    """
    gone = groups(docs, percent, id_col, text_col).filter("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    kept = docs.join(gone.withColumnRenamed("doc_id", id_col), id_col, "left_anti").select(*docs.columns)
    ids = docs.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("rows"))
    repeated = materialize(ids.filter("rows > 1").select(id_col), "repeated-ids")
    if repeated.isEmpty():
        return kept
    # Only rows of such ids move; equal ones are combined before they do.
    once = kept.join(repeated, id_col, "left_semi").select(*docs.columns).dropDuplicates([id_col, text_col])
    return kept.join(repeated, id_col, "left_anti").select(*docs.columns).unionByName(once)
