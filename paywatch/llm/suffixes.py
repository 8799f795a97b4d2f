"""Repeated passages: every byte under a 50-byte string that starts in an earlier document goes.

Positions are thinned without loss. Every 50-byte string contains an anchor: the
least 24-byte gram of its 27. Equal strings have equal anchors at equal offsets, so
only anchors that occur in two documents matter. Around those, the bytes that any
50-byte string with this anchor can hold are gathered, and their suffixes are
sorted: prefix polynomial hashes and binary search give the common extension of two
suffixes in six steps, a mergesort uses it as its comparison, and neighbours that
agree over 50 bytes are compared byte by byte before the smallest id keeps them.

Work is dealt by the hash of the anchor, in packed arrays. Before anything is sent,
a task settles what its own rows show: of an anchor met in several of its documents
one copy is sent, and of equal surroundings only the smallest id's. So a passage of
a third of all documents costs one row per task. Intermediate tables lie in the
shared folder.

In a run of one byte all grams tie. Anchors whose surroundings lie inside the run say
no more than those at its edges and are left out; where 50 bytes of a run go, all of it
goes, since all its 50-byte strings are equal. Long texts are cut into anchors by
overlapping pieces, and surroundings are gathered by slices of bounded size.

Ids are distinct; rows that repeat get the same answer. A null or empty text is
empty, and a row without an id neither loses bytes nor takes them from others.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywatch.llm.flat import BASE, BASE_INVERSE, BYTE_VALUES, U64, flatten, mix, powers, prefix_hashes, slices
from paywatch.session import materialize

SPAN, GRAM = 50, 24
#: Grams in a string of SPAN bytes; also bytes that may lie on either side of an anchor.
WINDOW = SPAN - GRAM + 1
SIDE = WINDOW - 1
AROUND = GRAM + 2 * SIDE
#: Bytes of text that a task settles at once, and that one part of the work stands for.
CHUNK_BYTES, PART_BYTES = 8 << 20, 8 << 20
#: Rows sorted at once, and surroundings gathered at once.
SORT_ROWS = 1 << 16
#: Bytes of a long text that are searched for anchors at once.
PIECE_BYTES = 1 << 20
#: Partitions of one shuffle; each holds several parts, one after another, when there are more.
MOST_PARTITIONS = 20_000

#: Ids are spread by a product modulo a prime, which stays within 64 bits.
PRIME, FACTOR = (1 << 31) - 1, 1_583_458_089

PACKED = "kind int, part int, ids binary, counts binary, at binary, more binary, body binary"


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Least or largest of each `width` neighbours."""
    out, span = values, 1
    while span * 2 <= width:
        out = pick(out[:-span], out[span:])
        span *= 2
    if span < width:
        n = len(values) - width + 1
        out = pick(out[:n], out[width - span : width - span + n])
    return out


def anchors(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place in it and gram hash of every anchor."""
    n = len(flat) - GRAM + 1
    if len(flat) < SPAN:
        none = np.zeros(0, np.int64)
        return none, none, none.view(U64)
    prefix = prefix_hashes(flat)
    grams = mix((prefix[GRAM:] - prefix[:n]) * powers(BASE_INVERSE, n))
    least = sliding(grams, WINDOW, np.minimum)
    # Strings that begin in one text and end in the next have no say.
    starts = np.arange(len(least))
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    least = np.where(row[starts] == row[starts + SPAN - 1], least, U64(0))
    pad = np.zeros(WINDOW - 1, U64)
    most = sliding(np.concatenate([pad, least, pad]), WINDOW, np.maximum)
    at = np.flatnonzero(grams == most)
    at = at[~inside_run(flat, bounds, at)]
    return row[at], at - bounds[row[at]], grams[at]


def run_edges(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where runs of one byte begin, none across two texts, and the end of the last."""
    new = np.ones(len(flat) + 1, bool)
    np.not_equal(flat[1:], flat[:-1], out=new[1:-1])
    new[bounds] = True
    return np.flatnonzero(new)


def may_hold_run(flat: np.ndarray) -> bool:
    """False where no SPAN bytes in a row are equal: of such, two are places of this grid, with equal bytes between."""
    step = SPAN // 2
    heads = flat[::step]
    same = np.flatnonzero(heads[1:] == heads[:-1])
    for d in range(5, step, 5):
        same = same[flat[same * step + d] == heads[same]]
    return len(same) > 0


def inside_run(flat: np.ndarray, bounds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether all bytes around an anchor belong to one run."""
    if not may_hold_run(flat):
        return np.zeros(len(at), bool)
    edges = run_edges(flat, bounds)
    run = np.searchsorted(edges, at, "right") - 1
    return (at - SIDE >= edges[run]) & (at + GRAM + SIDE <= edges[run + 1])


def anchors_by_piece(flat: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """As `anchors`, in bounded memory: each 50-byte string lies in one of a long text's pieces."""
    if len(bounds) != 2 or len(flat) <= PIECE_BYTES + SPAN:
        yield anchors(flat, bounds)
        return
    for begin in range(0, len(flat) - SPAN + 1, PIECE_BYTES):
        piece = flat[begin : begin + PIECE_BYTES + SPAN - 1]
        row, at, grams = anchors(piece, np.array([0, len(piece)]))
        yield row, at + begin, grams


def whole_runs(text: np.ndarray, gone: np.ndarray) -> None:
    """Mark all of a run in `gone` where SPAN bytes of it in a row are marked."""
    if not may_hold_run(text):
        return
    edges = run_edges(text, np.array([0, len(text)]))
    long = np.flatnonzero(np.diff(edges) >= SPAN)
    for a, b in zip(edges[long].tolist(), edges[long + 1].tolist(), strict=True):
        marks = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].view(np.int8), [0]])))
        if (marks[1::2] - marks[::2] >= SPAN).any():
            gone[a:b] = True


def _pack(kind: int, part: int, ids: np.ndarray, at: np.ndarray, more: np.ndarray | None = None, body: np.ndarray | None = None) -> tuple:
    """One row; ids, which come in runs, are stored once per run."""
    new = np.r_[True, ids[1:] != ids[:-1]]
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(ids))).astype(np.uint32)
    return (
        kind,
        part,
        ids[first].tobytes(),
        counts.tobytes(),
        at.astype(np.uint32).tobytes(),
        b"" if more is None else np.ascontiguousarray(more).tobytes(),
        b"" if body is None else np.ascontiguousarray(body).tobytes(),
    )


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 7
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
        names=["kind", "part", "ids", "counts", "at", "more", "body"],
    )


def _unpack(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, bytes, bytes]:
    ids = [np.repeat(np.frombuffer(r["ids"], np.int64), np.frombuffer(r["counts"], np.uint32)) for r in rows]
    at = [np.frombuffer(r["at"], np.uint32) for r in rows]
    return (
        np.concatenate([*ids, np.zeros(0, np.int64)]),
        np.concatenate([*at, np.zeros(0, np.uint32)]).astype(np.int64),
        b"".join(r["more"] for r in rows),
        b"".join(r["body"] for r in rows),
    )


def part_of(ids: np.ndarray, parts: int) -> np.ndarray:
    """Part of each document, by its id, as `beside_texts` has it; ids may share factors with `parts`."""
    return ids % PRIME * FACTOR % PRIME % parts


def _dealt(kind: int, owner: np.ndarray, ids: np.ndarray, at: np.ndarray, more=None, body=None) -> Iterator[tuple]:
    """Packed rows by part, ordered by id within each."""
    if not len(owner):
        return
    order = np.lexsort((at, ids, owner))
    owner, ids, at = owner[order], ids[order], at[order]
    more = None if more is None else more[order]
    body = None if body is None else body[order]
    cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    for a, b in zip(cuts, [*cuts[1:], len(owner)], strict=True):
        yield _pack(kind, int(owner[a]), ids[a:b], at[a:b], None if more is None else more[a:b], None if body is None else body[a:b])


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin of each run of equal rows, and the run of each row; keys are sorted."""
    n = len(keys[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new), np.cumsum(new) - 1


def find_anchors(parts: int):
    """Task of the first pass: (id, text) to anchors dealt by hash, and those already met twice."""

    def settle(ids: np.ndarray, at: np.ndarray, grams: np.ndarray) -> Iterator[tuple]:
        order = np.lexsort((ids, grams))
        ids, at, grams = ids[order], at[order], grams[order]
        first, run = _runs(grams)
        if not len(first):
            return
        last = np.append(first[1:], len(ids)) - 1
        several = (ids[first] != ids[last])[run]
        yield from _dealt(1, part_of(ids[several], parts), ids[several], at[several])
        send = ~several
        send[first] = True
        owner = (grams[send] % U64(parts)).astype(np.int64)
        low = grams[send].view(np.uint8).reshape(-1, 8)[:, 2:]
        yield from _dealt(0, owner, ids[send], at[send], more=low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            known = batch.column(0).is_valid()
            batch = batch.filter(known)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            flat, bounds = flatten(batch.column(1))
            for low, high in slices(bounds):
                for row, at, grams in anchors_by_piece(flat[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]):
                    held.append((ids[low + row], at, grams))
                    size += int(min(bounds[high] - bounds[low], PIECE_BYTES))
                    if size >= CHUNK_BYTES:
                        yield _rows(list(settle(*(np.concatenate(x) for x in zip(*held, strict=True)))))
                        held, size = [], 0
        if held:
            yield _rows(list(settle(*(np.concatenate(x) for x in zip(*held, strict=True)))))

    return run


def _by_part(batches: Iterator[pa.RecordBatch], work) -> Iterator[pa.RecordBatch]:
    """Rows of one part after another to `work`; rows of kind 1 are already settled and pass."""
    held: list[dict] = []
    for batch in batches:
        passed = []
        for row in batch.to_pylist():
            if row["kind"] == 1:
                passed.append(tuple(row.values()))
                continue
            if held and held[0]["part"] != row["part"]:
                yield _rows(list(work(held)))
                held = []
            held.append(row)
        if passed:
            yield _rows(passed)
    if held:
        yield _rows(list(work(held)))


def shared_anchors(parts: int):
    """Anchors that two documents have, dealt by document."""

    def work(rows: list[dict]) -> Iterator[tuple]:
        ids, at, more, _ = _unpack(rows)
        wide = np.zeros((len(ids), 8), np.uint8)
        wide[:, 2:] = np.frombuffer(more, np.uint8).reshape(-1, 6)
        grams = wide.view(U64).ravel()
        order = np.lexsort((ids, grams))
        ids, at, grams = ids[order], at[order], grams[order]
        first, run = _runs(grams)
        last = np.append(first[1:], len(ids)) - 1
        both = (ids[first] != ids[last])[run]
        yield from _dealt(1, part_of(ids[both], parts), ids[both], at[both])

    return lambda batches: _by_part(batches, work)


def _windows_to_spans(ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Join stretches of one document that touch; ends grow with begins."""
    order = np.lexsort((ends, begins, ids))
    ids, begins, ends = ids[order], begins[order], ends[order]
    if not len(ids):
        return ids, begins, ends
    # Running end within a document, by a shift that keeps documents apart.
    _, run = _runs(ids)
    reach = np.maximum.accumulate(ends + run * (1 << 40)) - run * (1 << 40)
    new = np.r_[True, (ids[1:] != ids[:-1]) | (begins[1:] > reach[:-1])]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(ids)) - 1
    return ids[first], begins[first], reach[last]


def _spans(parts: int, ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> Iterator[tuple]:
    ids, begins, ends = _windows_to_spans(ids, begins, ends)
    yield from _dealt(1, part_of(ids, parts), ids, begins, more=ends.astype(np.uint32))


def _whole(ids: np.ndarray, at: np.ndarray, clip: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The stretch that all strings around an anchor cover, where there is any such string."""
    begins = at - SIDE + clip[:, 0].astype(np.int64)
    ends = at + GRAM + SIDE - clip[:, 1].astype(np.int64)
    long = ends - begins >= SPAN
    return ids[long], begins[long], ends[long]


def _equal_bodies(ids: np.ndarray, body: np.ndarray, clip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows to keep and rows whose surroundings a smaller id has too."""
    key = np.zeros(len(ids), U64)
    for column in (*body.T, *clip.T):
        key = key * BASE + BYTE_VALUES[column]
    key = mix(key)
    order = np.lexsort((ids, key))
    first, run = _runs(key[order])
    head = order[first][run]
    equal = (body[order] == body[head]).all(1) & (clip[order] == clip[head]).all(1)
    gone = equal & (ids[order] > ids[head])
    return order[~gone], order[gone]


def gather(parts: int):
    """Task of the second pass: the bytes around shared anchors, dealt by anchor."""

    def settle(ids: np.ndarray, at: np.ndarray, body: np.ndarray, clip: np.ndarray) -> Iterator[tuple]:
        keep, gone = _equal_bodies(ids, body, clip)
        yield from _spans(parts, *_whole(ids[gone], at[gone], clip[gone]))
        ids, at, body, clip = ids[keep], at[keep], body[keep], clip[keep]
        gram = np.zeros(len(ids), U64)
        for column in body[:, SIDE : SIDE + GRAM].T:
            gram = gram * BASE + BYTE_VALUES[column]
        owner = (mix(gram) % U64(parts)).astype(np.int64)
        yield from _dealt(0, owner, ids, at, more=clip, body=body)

    def around(text: np.ndarray, at: np.ndarray) -> Iterator[tuple]:
        padded = np.concatenate([np.zeros(SIDE, np.uint8), text, np.zeros(SIDE, np.uint8)])
        windows = np.lib.stride_tricks.sliding_window_view(padded, AROUND)
        for k in range(0, len(at), SORT_ROWS):
            mine = at[k : k + SORT_ROWS]
            left, right = np.maximum(SIDE - mine, 0), np.maximum(mine + GRAM + SIDE - len(text), 0)
            yield mine, windows[mine], np.stack([left, right], 1).astype(np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for ids, at, flat, bounds in _with_places(batches):
            if ids is None:
                continue
            for mine, body, clip in around(flat[bounds[0] : bounds[1]], at):
                held.append((np.full(len(mine), ids), mine, body, clip))
                size += body.nbytes
                if size >= 4 * CHUNK_BYTES:
                    yield _rows(list(settle(*(np.concatenate(x) for x in zip(*held, strict=True)))))
                    held, size = [], 0
        if held:
            yield _rows(list(settle(*(np.concatenate(x) for x in zip(*held, strict=True)))))

    return run


def _known(rows: list[dict]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places, and what goes with them, by document."""
    ids, at, more, _ = _unpack(rows)
    if not len(ids):
        return {}
    extra = np.frombuffer(more, np.uint32).astype(np.int64) if more else np.zeros(len(ids), np.int64)
    order = np.lexsort((at, ids))
    ids, at, extra = ids[order], at[order], extra[order]
    first, _ = _runs(ids)
    return {int(ids[a]): (at[a:b], extra[a:b]) for a, b in zip(first, np.append(first[1:], len(ids)), strict=True)}


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Each document with what is known of it; in a part, packed rows come before texts."""
    part, rows, known = None, [], None
    for batch in batches:
        packed = batch.column(1).to_numpy() == 1
        parts = batch.column(0).to_numpy()
        flat, bounds = flatten(batch.column(3))
        ids = batch.column(2).to_pylist()
        blobs = batch.select([4, 5, 6, 7]).filter(pa.array(packed)).to_pylist()
        nth = 0
        for i in range(len(parts)):
            if parts[i] != part:
                part, rows, known = parts[i], [], None
            if packed[i]:
                rows.append(blobs[nth] | {"body": b""})
                nth += 1
                continue
            if known is None:
                known, rows = _known(rows), []
            found = known.get(ids[i]) if ids[i] is not None else None
            yield ids[i], found, flat, bounds[i : i + 2]


def _with_places(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for doc_id, found, flat, bounds in _texts(batches):
        if found is not None:
            yield doc_id, np.unique(found[0]), flat, bounds


def beside_texts(docs: DataFrame, packed: DataFrame, parts: int) -> DataFrame:
    """Texts and packed rows of one part in one partition, packed rows first."""
    prime = F.lit(PRIME).cast("long")
    mixed = F.coalesce(F.pmod("doc_id", prime) * FACTOR % prime % parts, F.lit(0)).cast("int")
    none = F.lit(None).cast("binary")
    texts = docs.select(mixed.alias("part"), F.lit(2).alias("kind"), "doc_id", "text", *[none.alias(c) for c in ("ids", "counts", "at", "more")])
    rows = packed.select("part", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "ids", "counts", "at", "more")
    return texts.unionByName(rows).repartition(min(parts, MOST_PARTITIONS), "part").sortWithinPartitions("part", "kind")


class Suffixes:
    """Suffixes of the surroundings, compared by prefix hashes over at most SPAN bytes."""

    def __init__(self, body: np.ndarray):
        self.body = body
        width = body.shape[1]
        self.prefix = np.zeros((len(body), width + 1), U64)
        np.cumsum(BYTE_VALUES[body] * powers(BASE, width), axis=1, out=self.prefix[:, 1:])
        self.flat = self.prefix.ravel()

    def extension(self, a: np.ndarray, b: np.ndarray, begin: int) -> np.ndarray:
        """Bytes in common from `begin` on, by binary search on equal hashes."""
        a, b = (rows * self.prefix.shape[1] + begin for rows in (a, b))
        # Both start at one offset, so the hashes need no shift: where stretches are
        # equal, the prefix hashes behind them are as far apart as those before them.
        apart = self.flat.take(a) - self.flat.take(b)
        length = np.zeros(len(a), np.int64)
        step = 1 << (SPAN.bit_length() - 1)
        while step:
            end = np.minimum(length + step, SPAN)
            same = self.flat.take(a + end) - self.flat.take(b + end) == apart
            length = np.where(same, end, length)
            step >>= 1
        return length

    def compare(self, a: np.ndarray, b: np.ndarray, begin: int) -> np.ndarray:
        n = self.extension(a, b, begin)
        at = np.minimum(begin + n, self.body.shape[1] - 1)
        order = self.body[a, at].astype(np.int16) - self.body[b, at]
        return np.where(n >= SPAN, 0, order)

    def sort(self, rows: np.ndarray, run: np.ndarray, begin: int) -> np.ndarray:
        """Mergesort of the suffixes within each run of rows; all merges of a level at once."""
        first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if len(run) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(first, len(rows)))
        seg_first, seg_size = np.repeat(first, sizes), np.repeat(sizes, sizes)
        local = np.arange(len(rows)) - seg_first
        rows = rows.copy()
        width = 1
        while len(sizes) and width < sizes.max():
            go = np.flatnonzero(seg_size > width)
            base, i = seg_first[go], local[go]
            pair = i // (2 * width) * (2 * width)
            left = i - pair < width
            # The right half finds its places in the left half, which fills the rest in order.
            right = np.flatnonzero(~left)
            base, pair, own = base[right], pair[right], (i - pair - width)[right]
            start = base + pair
            low, high = start.copy(), start + width
            mine = rows[go[right]]
            while True:
                live = np.flatnonzero(low < high)
                if not len(live):
                    break
                mid = (low[live] + high[live]) // 2
                before = self.compare(rows[mid], mine[live], begin) <= 0
                low[live] = np.where(before, mid + 1, low[live])
                high[live] = np.where(before, high[live], mid)
            free = np.ones(len(rows), bool)
            free[low + own] = False
            others = rows[go[left]]
            rows[low + own] = mine
            rows[go[free[go]]] = others
            width *= 2
        return rows


def repeated(parts: int):
    """Stretches of later documents that an earlier one has."""

    def work(rows: list[dict]) -> Iterator[tuple]:
        ids, at, more, raw = _unpack(rows)
        clip = np.frombuffer(more, np.uint8).reshape(-1, 2)
        body = np.frombuffer(raw, np.uint8).reshape(-1, AROUND)
        keep, gone = _equal_bodies(ids, body, clip)
        found = [_whole(ids[gone], at[gone], clip[gone])]
        ids, at, body, clip = ids[keep], at[keep], body[keep], clip[keep]
        gram = np.zeros(len(ids), U64)
        for column in body[:, SIDE : SIDE + GRAM].T:
            gram = gram * BASE + BYTE_VALUES[column]
        order = np.argsort(gram, kind="stable")
        first, _ = _runs(gram[order])
        ends = np.append(first[1:], len(order))
        several = ends - first > 1
        first, ends = first[several], ends[several]
        i = 0
        while i < len(first):
            # Whole classes of one gram, as many as fit into one sort.
            j = i + 1
            total = ends[i] - first[i]
            while j < len(first) and total + ends[j] - first[j] <= SORT_ROWS:
                total += ends[j] - first[j]
                j += 1
            mine = np.concatenate([order[a:b] for a, b in zip(first[i:j], ends[i:j], strict=True)])
            run = np.repeat(np.arange(j - i), ends[i:j] - first[i:j])
            found.extend(_sorted_repeats(ids[mine], at[mine], body[mine], clip[mine], run))
            i = j
        yield from _spans(parts, *(np.concatenate(x) for x in zip(*found, strict=True)))

    return lambda batches: _by_part(batches, work)


def _sorted_repeats(ids: np.ndarray, at: np.ndarray, body: np.ndarray, clip: np.ndarray, run: np.ndarray) -> Iterator[tuple]:
    suffixes = Suffixes(body)
    for begin in range(WINDOW):
        # Strings that start `begin` bytes into the surroundings and lie inside their text.
        rows = np.flatnonzero((clip[:, 0] <= begin) & (begin + SPAN <= AROUND - clip[:, 1].astype(np.int64)))
        rows = suffixes.sort(rows, run[rows], begin)
        if not len(rows):
            continue
        equal = run[rows[1:]] == run[rows[:-1]]
        equal &= suffixes.extension(rows[1:], rows[:-1], begin) >= SPAN
        # Hashes may collide; bytes may not.
        equal[equal] = (body[rows[1:][equal], begin : begin + SPAN] == body[rows[:-1][equal], begin : begin + SPAN]).all(1)
        first = np.flatnonzero(np.r_[True, ~equal])
        least = np.minimum.reduceat(ids[rows], first)
        gone = rows[ids[rows] > np.repeat(least, np.diff(np.append(first, len(rows))))]
        start = at[gone] - SIDE + begin
        yield ids[gone], start, start + SPAN


def _release(df: DataFrame) -> None:
    """Let Spark's cleaner drop the shuffle files of steps whose result is written.

    It follows the driver's garbage collection; the second round gets what the
    listeners still held during the first.
    """
    for _ in range(2):
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
        time.sleep(1)


def removed_spans(docs: DataFrame) -> tuple[DataFrame, int]:
    """Packed removed stretches by part, and the number of parts; `docs` has doc_id and text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(size // PART_BYTES) + 1
    found = docs.mapInArrow(find_anchors(parts), PACKED).repartition(min(parts, MOST_PARTITIONS), "part").sortWithinPartitions("part")
    shared = materialize(found.mapInArrow(shared_anchors(parts), PACKED), "anchors")
    del found
    _release(docs)
    around = beside_texts(docs, shared, parts).mapInArrow(gather(parts), PACKED)
    around = around.repartition(min(parts, MOST_PARTITIONS), "part").sortWithinPartitions("part")
    spans = materialize(around.mapInArrow(repeated(parts), PACKED), "repeats")
    del around
    _release(docs)
    return spans, parts


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, removed (byte ranges) and kept (the bytes that stay) of each row."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spans, parts = removed_spans(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for doc_id, found, flat, bounds in _texts(batches):
            text = flat[bounds[0] : bounds[1]]
            gone = np.zeros(len(text), bool)
            if found is not None:
                _, begins, ends = _windows_to_spans(np.zeros(len(found[0]), np.int64), *found)
                for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
                    gone[a:b] = True
                whole_runs(text, gone)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
            ranges = [{"begin": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]
            out.append((doc_id, len(text), ranges, text[~gone].tobytes()))
            size += len(text)
            if size >= CHUNK_BYTES or len(out) >= 5000:
                yield _answers(out)
                out, size = [], 0
        yield _answers(out)

    schema = "doc_id long, n_bytes long, removed array<struct<begin: long, end: long>>, kept binary"
    return beside_texts(docs, spans, parts).mapInArrow(run, schema)


def _answers(rows: list[tuple]) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    columns = list(zip(*rows, strict=True)) if rows else [()] * 4
    types = [pa.int64(), pa.int64(), span, pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "n_bytes", "removed", "kept"]
    )


def digest(answers: DataFrame) -> DataFrame:
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return answers.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
