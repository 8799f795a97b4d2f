"""Repeated passages in runs of one byte, over many parts, against brute force."""

import numpy as np
from brute import cut_repeats

from paywatch.llm import suffixes

RUN, OTHER = "x" * 300, " some words stand between the runs and differ here "
TEXTS = [
    OTHER + "1" + RUN + "tail one",
    RUN[:49] + "|" + OTHER + "2",
    "left" + RUN[:49],
    RUN[:49] + "right",
    "left" + RUN[:98] + "right",
    "left" + RUN[:99] + "right",
    RUN * 9 + OTHER + "7" + RUN,
    "y" * 400 + RUN[:50],
    "z" + "y" * 75 + "z",
    "y" * 50,
    "ab" * 200,
    "ba" * 200,
    "é" * 120,
    "",
    None,
    "-" * 60 + OTHER + "1" + "=" * 60,
    "-" * 61 + "=" * 200,
]


def test_runs_are_cut_as_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PART_BYTES", 1 << 10)
    monkeypatch.setattr(suffixes, "MOST_PARTITIONS", 3)
    for ids in (range(len(TEXTS)), range(-len(TEXTS) * 7, 0, 7)):
        docs = list(zip(ids, TEXTS, strict=True))
        want = cut_repeats(docs)
        got = suffixes.digest(suffixes.cut(spark.createDataFrame(docs, "doc_id long, text string"))).collect()
        assert {r.doc_id: tuple(r)[1:] for r in got} == want
        # The run that only the sides of earlier ones cover keeps its middle.
        assert want[ids[5]][1] > 0


def test_long_runs_have_few_anchors_and_pieces_lose_none(monkeypatch):
    flat = np.full(1 << 20, 120, np.uint8)
    assert len(suffixes.anchors(flat, np.array([0, len(flat)]))[0]) <= 2 * suffixes.AROUND
    monkeypatch.setattr(suffixes, "PIECE_BYTES", 100)
    flat = np.random.default_rng(5).integers(97, 100, 5000).astype(np.uint8)
    flat[1000:1400] = 97
    pieces = np.unique(np.concatenate([at for _, at, _ in suffixes.anchors_by_piece(flat, np.array([0, len(flat)]))]))
    assert set(suffixes.anchors(flat, np.array([0, len(flat)]))[1]) <= set(pieces)


def test_ids_with_a_common_factor_spread_over_parts():
    for parts in (8, 97, 1000):
        counts = np.bincount(suffixes.part_of(np.arange(100 * parts, dtype=np.int64) * parts, parts), minlength=parts)
        assert counts.max() < 200
