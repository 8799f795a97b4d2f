"""The stages in turn, each held against what it got."""

import re

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def windows(text, length=10):
    lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    found = WORD.findall(lowered)
    return {tuple(found[i : i + length]) for i in range(max(len(found) - length + 1, 0))}


def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, FOLDER), f"test-{name}")
        assert docs.columns == columns
        kept[name] = docs.select("doc_id", "text").collect()
    assert {r.doc_id for r in kept["near_duplicates"]} < {r.doc_id for r in kept["quality"]}
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    # Items of fewer than ten words are not in this table.
    assert all(windows(t) for t in items)
    listed = set().union(*map(windows, items))
    clean = {r.doc_id for r in kept["near_duplicates"] if not windows(r.text) & listed}
    assert {r.doc_id for r in kept["decontamination"]} == clean
    assert {r.doc_id for r in kept["mixing"]} <= clean
    dealt = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert sorted(r.doc_id for r in dealt.collect()) == sorted(r.doc_id for r in kept["mixing"])
