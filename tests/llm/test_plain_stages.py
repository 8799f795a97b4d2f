"""Sharding and the near-duplicate stage against plain versions, on a whole table."""

import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline

from paywatch.llm import slots

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, length=5):
    found = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + length]) for i in range(max(len(found) - length + 1, 1)))


def plain_groups(rows, percent):
    """The group of each id: every pair that shares a shingle is compared on full sets."""
    sets = {i: shingles(text) for i, text in rows}
    holders = defaultdict(list)
    for i, items in sets.items():
        for item in items:
            holders[item].append(i)
    above = {i: i for i in sets}

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    for i, items in sets.items():
        for j, common in Counter(j for item in items for j in holders[item] if j < i).items():
            if 100 * common >= percent * (len(items) + len(sets[j]) - common):
                a, b = sorted((top(i), top(j)))
                above[b] = a
    return {i: top(i) for i in sets}


def test_sharding_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "ä€"), (-3, "ä€"), (None, "x")], "doc_id long, text string")
    docs = docs.unionByName(odd)
    rows = slots.shard(docs, 7).collect()
    plain = Counter(
        (r.doc_id, len((r.text or "").encode()) + 16, None if r.text is None else zlib.crc32(r.text.encode()))
        for r in docs.collect()
    )
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == plain
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    held, homes, loads = defaultdict(list), defaultdict(set), Counter()
    for r in rows:
        held[r.shard].append(r.slot)
        homes[r.virtual_slot].add(r.shard)
        loads[r.shard] += r.size
    assert set(held) == set(range(7)) and all(sorted(s) == list(range(len(s))) for s in held.values())
    assert all(len(shards) == 1 for shards in homes.values())
    # No move of one slot narrows the gap further, so it is below the largest slot.
    largest = max(Counter({s: sum(r.size for r in rows if r.virtual_slot == s) for s in homes}).values())
    assert max(loads.values()) - min(loads.values()) <= largest


def test_near_duplicate_stage_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    groups = plain_groups([(r.doc_id, r.text) for r in docs.collect()], corpus_pipeline.SIMILAR_PERCENT)
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    kept = stage(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    found = [r.doc_id for r in kept.collect()]
    # One document of every group stays, whole; every document without a near copy is among them.
    assert sorted(groups[i] for i in found) == sorted(set(groups.values()))
    assert len(set(groups.values())) < len(groups)
    assert kept.exceptAll(docs).count() == 0
