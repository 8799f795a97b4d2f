"""Columns of the caller that are named like the operators' own come out unchanged."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from paywatch.llm import mixing, superminhash, url_filter, winnowing

FOLDER = "/root/testdata/sf0.001"
NAMES = ["quality_score", "n_words", "hit_spans", "hit_items", *mixing.ADDED, *mixing.INNER, "Score", "stats", "part", "node", "n"]


@pytest.mark.parametrize("name", ["quality", "decontamination", "mixing", "near_duplicates"])
def test_stages_leave_columns_as_they_are(spark, name):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = docs.withColumns({c: F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")) for c in NAMES})
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, odd, FOLDER)
    assert got.columns == odd.columns
    rows = got.select("doc_id", *NAMES).collect()
    assert rows and all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in NAMES)
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in stage(spark, docs, FOLDER).select("doc_id").collect())


def test_url_filter_leaves_columns_as_they_are(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (2, None)], "page_id long, url string")
    odd = pages.withColumns({c: F.lit(c) for c in url_filter.INNER})
    for most in (url_filter.MOST_BYTES, 0):
        got = url_filter.filter_urls(odd, [("block", "net/")], most_bytes=most)
        assert got.columns == [*odd.columns, "host", "path", "rule", "verdict"]
        rows = got.orderBy("page_id").collect()
        assert [r.rule for r in rows] == ["net/", None] and all(r[c] == c for r in rows for c in url_filter.INNER)
    assert url_filter.filter_urls(pages.limit(0), [("block", "net/")]).count() == 0


def test_added_columns_that_clash_are_refused(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s")], "doc_id long, text string, lang string, source string")
    with pytest.raises(ValueError, match="N_Words"):
        winnowing.mark(docs.withColumn("N_Words", F.lit(1)), docs.select(F.lit("i").alias("item_id"), "text"))
    with pytest.raises(ValueError, match="mix_domain"):
        mixing.mix(docs.withColumn("mix_domain", F.lit(1)), F.lit("d"), {})


def test_one_of_repeated_rows_stays(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, text), (2, text + " end"), (3, "other words"), (3, "different ones"), (None, "no id"), (4, None), (4, None)]
    kept = superminhash.dedupe(spark.createDataFrame(rows, "doc_id long, text string"), 80).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, "no id"), (1, text), (3, "different ones"), (3, "other words"), (4, "")]
