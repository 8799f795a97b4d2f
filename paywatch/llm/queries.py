"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paywatch.llm import (
    curves,
    hard_negatives,
    masked_lm,
    mixing,
    quality,
    simhash,
    slots,
    suffixes,
    superminhash,
    token_files,
    url_filter,
    whitening,
    winnowing,
)
from paywatch.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
SHARDS = 40
#: Quality score from which a document is predicted to be good.
KEEP_SCORE = 0.3
#: Target weights by level; names not listed weigh 1.
MIX_WEIGHTS = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
}
MIX_PERCENT, MIX_EPOCHS, MIX_SEED = 100, 2, 7


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def domain_of(source: str = "source"):
    """The test sources carry a number; four domains share them out."""
    number = F.expr(f"try_cast(regexp_extract({source}, '([0-9]+)$', 1) AS INT)")
    return F.concat(F.lit("domain"), F.pmod(number, F.lit(4)).cast("string"))


def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return curves.nearest(table(spark, folder, "embeddings"), every=20, k=20)


def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(table(spark, folder, "documents"), path)
    blocks = token_files.scan(token_files.read_blocks(spark, path))
    counts = token_files.count_tokens(token_files.joined(blocks))
    return counts.select(F.col("file").alias("part"), "position", "n_tokens", "terminated")


def pseudo_likelihoods(spark: SparkSession, folder: str) -> DataFrame:
    return masked_lm.train_and_score(table(spark, folder, "documents"))


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return superminhash.groups(table(spark, folder, "documents"), percent=85)


def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= KEEP_SCORE).cast("int"))


def benchmark_hits(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return winnowing.digest(winnowing.mark(docs, table(spark, folder, "benchmark")))


def sharded(spark: SparkSession, folder: str) -> DataFrame:
    return slots.shard(table(spark, folder, "documents"), SHARDS)


def mixed(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    drawn = mixing.mix(docs, domain_of(), MIX_WEIGHTS, MIX_PERCENT, MIX_EPOCHS, MIX_SEED)
    return drawn.select(
        "doc_id",
        F.col("mix_domain").alias("domain"),
        "lang",
        "source",
        F.col("mix_epoch").alias("epoch"),
        F.col("mix_tokens").alias("tokens"),
        F.col("mix_taken").alias("taken_tokens"),
    )


def repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.digest(suffixes.cut(table(spark, folder, "documents")))


def close_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.groups(table(spark, folder, "documents"), radius=4)


def mined_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(vectors, every=100, positives=5, negatives=5, low_percent=80, high_percent=100, scale=256)


def whitened(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"), most=32, scale=64, shift=1_000_000)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def llm_queries() -> dict[str, Query]:
    return {
        "pipeline": pipeline,
        "op1_url_filter": url_verdicts,
        "op2_curve_neighbours": nearest_vectors,
        "op3_token_counts": token_counts,
        "op4_superminhash": near_duplicates,
        "op5_virtual_slots": sharded,
        "op6_quality_trees": quality_scores,
        "op7_winnowing": benchmark_hits,
        "op8_masked_likelihood": pseudo_likelihoods,
        "op9_source_mixing": mixed,
        "op10_suffix_dedup": repeated_passages,
        "op11_simhash_tiles": close_fingerprints,
        "op12_hard_negatives": mined_negatives,
        "op13_whitening": whitened,
    }
