"""From raw documents to dealt shards: five stages, each over all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet
and read again as the documents of the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paywatch.llm import mixing, quality, slots, superminhash, winnowing
from paywatch.llm.aside import set_aside
from paywatch.llm.queries import (
    KEEP_SCORE,
    MIX_EPOCHS,
    MIX_PERCENT,
    MIX_SEED,
    MIX_WEIGHTS,
    SHARDS,
    domain_of,
    table,
)
from paywatch.session import materialize

#: Near duplicates share this percentage of their five-word shingles.
SIMILAR_PERCENT = 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; a column quality_score of their own stays."""
    docs, restore = set_aside(docs, ["quality_score"])
    scored = quality.classify_rows(docs, table(spark, sf_dir, "labels"))
    return restore(scored.filter(scored["quality_score"] >= KEEP_SCORE).drop("quality_score"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return superminhash.dedupe(docs, SIMILAR_PERCENT)


def keep_clear_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return winnowing.clean(docs, table(spark, sf_dir, "benchmark"))


def draw_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights; one drawn in two epochs comes twice.

    The last document of a leaf's prefix comes whole, so a leaf's tokens may pass its
    budget by less than one document. Columns of the documents come out unchanged.
    """
    docs, restore = set_aside(docs, mixing.ADDED)
    drawn = mixing.mix(docs, domain_of(), MIX_WEIGHTS, MIX_PERCENT, MIX_EPOCHS, MIX_SEED)
    return restore(drawn.drop(*mixing.ADDED))


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return slots.shard(docs, SHARDS)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", keep_clear_of_benchmark),
    ("mixing", draw_mixture),
    ("sharding", deal_shards),
]

#: The classifier cannot be stated in SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
