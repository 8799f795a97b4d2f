"""Texts of an Arrow batch as one flat byte array, and the hashes the operators build on it.

Everything here runs inside a task on one slice of a batch. Hashes are 64-bit
polynomials modulo 2^64 over a table of random byte values, taken from prefix
sums, so the hash of any stretch costs one subtraction and one product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of text worked on at once; a longer document is a slice of its own.
SLICE_BYTES = 1 << 20
BASE = U64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = U64(pow(int(BASE), -1, 1 << 64))
BYTE_VALUES = np.random.default_rng(20240607).integers(0, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)

#: Separators of the shingling operators: space and the controls tab to carriage return.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
#: ASCII bytes that are neither digit nor letter.
NOT_ALPHANUMERIC = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word (splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def flatten(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts behind each other, and where each begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(bounds: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges that hold at most `limit` bytes, or one longer row."""
    row, n = 0, len(bounds) - 1
    while row < n:
        end = int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


_powers: dict[int, np.ndarray] = {}


def powers(base: U64, n: int) -> np.ndarray:
    """base^0 … base^(n-1), kept for the next call."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, SLICE_BYTES + 64), base, U64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= 4 * SLICE_BYTES:
            _powers[int(base)] = known
    return known[:n]


def prefix_hashes(flat: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of value[k] * BASE^k over i <= k < j."""
    out = np.zeros(len(flat) + 1, U64)
    if len(flat):
        np.cumsum(BYTE_VALUES[flat] * powers(BASE, len(flat)), out=out[1:])
    return out


def lowered(flat: np.ndarray) -> np.ndarray:
    """A to Z in lower case; every other byte stays."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table[flat]


def words(flat: np.ndarray, bounds: np.ndarray, separators: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, lower-cased, and the number of words of each text."""
    if not len(flat):
        return np.zeros(0, U64), np.zeros(len(bounds) - 1, np.int64)
    table = np.ones(256, bool)
    table[list(separators)] = False
    table[ord("A") : ord("Z") + 1] = table[ord("a") : ord("z") + 1]
    inside = table[flat]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    edges = bounds[:-1][bounds[:-1] < len(flat)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    prefix = prefix_hashes(lowered(flat))
    hashes = (prefix[ends] - prefix[starts]) * powers(BASE_INVERSE, len(flat))[starts]
    hashes = mix(hashes + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))
    return hashes, np.diff(np.searchsorted(starts, bounds))


def grams(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive values (at most len - k + 1 of them)."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for i in range(k):
        out = out * BASE + values[i : i + n]
    return mix(out + U64(k))


def row_of(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)
