"""Mixing sources to target weights by hierarchical budgets; DataFrame functions only.

The tree is domain, language, source. Each node's budget is dealt to its children
by weight; a child that cannot supply its share gives what it has, and what is
missing goes to its siblings in proportion to their weights. As a node is never
given more than all below it can supply, shortages reach the ancestors only when
the siblings are exhausted. A leaf then yields whole epochs of its documents and a
prefix, in tokens, of one more epoch, ordered by a seeded hash.

Tokens are words between blanks. Null language or source is the node ''. Null or
empty texts have no tokens: they follow whole epochs of their leaf and come with a
prefix when the hash orders them before its end; a leaf without tokens yields
nothing. Rows that repeat are separate documents. Ties in the hash are ordered by
id, then tokens. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paywatch.llm.aside import refuse, set_aside
from paywatch.session import materialize

#: Leading hex digits of the order hash by which a leaf's prefix is located.
DIGITS = 4
#: Digits by which it is located first; a leaf's totals then meet in groups of 16^2 rows.
COARSE = 2
#: Leaves up to which their table is broadcast, and parts in which a leaf's documents meet it beyond.
MOST_SENT, PARTS = 100_000, 64
WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ["mix_domain", "mix_lang", "mix_source"]
#: Columns of the result beside those of the documents, and columns in between.
ADDED = ["mix_domain", "mix_epoch", "mix_tokens", "mix_taken"]
INNER = ["mix_lang", "mix_source", "mix_part", "mix_full", "mix_rest", "mix_bucket", "mix_last", "mix_begin", "mix_key", "mix_in", "mix_copies", "mix_before"]


def weight_of(name: Column, weights: Mapping[str, int]) -> Column:
    """Integer weight by name, 1 where none is given."""
    if not weights:
        return F.lit(1).cast("long")
    pairs = F.create_map(*chain.from_iterable((F.lit(k), F.lit(int(v))) for k, v in weights.items()))
    return F.coalesce(pairs[name], F.lit(1)).cast("long")


def fill(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Deal `budget` of each parent to its children by `weight`, at most `supply` each.

    Children are met in the order of supply / weight. One is exhausted if its supply
    is below its share of what the earlier ones leave; the rest is dealt in whole
    tokens by running sums, so the shares add up exactly.
    """
    over = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = over.orderBy(F.col("supply") / F.col("weight"), name)
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    exact = lambda c: F.col(c).cast("decimal(38,0)") if isinstance(c, str) else c.cast("decimal(38,0)")
    marked = (
        children.filter("weight > 0")
        .withColumn("left", F.col("budget") - F.coalesce(F.sum("supply").over(earlier), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(later))
        .withColumn("exhausted", exact("supply") * F.col("weights") <= exact("left") * F.col("weight"))
    )
    open_weight = F.when(~F.col("exhausted"), F.col("weight")).otherwise(0)
    dealt = (
        marked.withColumn("rest", F.col("budget") - F.sum(F.when(F.col("exhausted"), F.col("supply")).otherwise(0)).over(over))
        .withColumn("total", F.sum(open_weight).over(over))
        .withColumn("running", F.sum(open_weight).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    )
    part = "CAST(rest AS DECIMAL(19,0)) * CAST({} AS DECIMAL(19,0)) DIV CAST(total AS DECIMAL(19,0))"
    share = F.expr(f"{part.format('running')} - {part.format('(running - weight)')}")
    return dealt.withColumn("budget", F.when(F.col("exhausted"), F.col("supply")).otherwise(share)).drop(
        "left", "weights", "exhausted", "rest", "total", "running"
    )


def leaf_budgets(leaves: DataFrame, weights: Mapping[str, Mapping[str, int]], percent: int, epochs: int) -> DataFrame:
    """Budget of each leaf: `percent` of all tokens, no leaf more than `epochs` times over.

    `leaves` has the three level columns and `tokens`; it has one row per source.
    """
    leaves = leaves.withColumn("supply", F.col("tokens") * epochs)
    level = leaves.agg(F.sum("supply").alias("all"), F.sum("tokens").alias("tokens")).select(
        F.least(F.floor(F.col("tokens") * percent / 100), F.col("all")).cast("long").alias("budget")
    )
    for depth, name in enumerate(LEVELS):
        parent, keys = LEVELS[:depth], LEVELS[: depth + 1]
        nodes = leaves.groupBy(*keys).agg(F.sum("supply").alias("supply"))
        nodes = nodes.withColumn("weight", weight_of(F.col(name), weights.get(name.removeprefix("mix_"), {})))
        nodes = nodes.join(level, parent) if parent else nodes.join(F.broadcast(level))
        level = fill(nodes, parent, name).select(*keys, "budget")
    return leaves.join(level, LEVELS).select(*LEVELS, "tokens", "budget")


def order_hash(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def join_leaves(docs: DataFrame, leaves: DataFrame) -> DataFrame:
    """Each document with its leaf's row; a large leaf is never gathered in one task."""
    if leaves.count() <= MOST_SENT:
        return docs.join(F.broadcast(leaves), LEVELS)
    copies = leaves.withColumn("mix_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int")
    return docs.withColumn("mix_part", part).join(copies, [*LEVELS, "mix_part"]).drop("mix_part")


def _last_before_rest(sums: DataFrame, bucket: str, offset: Column) -> DataFrame:
    """The last bucket of each leaf that begins before `mix_rest`, and where it begins."""
    order = Window.partitionBy(*LEVELS).orderBy(bucket)
    return (
        sums.withColumn("begin", offset + F.sum("n").over(order) - F.col("n"))
        .filter("begin < mix_rest")
        .groupBy(*LEVELS)
        .agg(F.max(bucket).alias("mix_last"), F.max("begin").alias("mix_begin"))
    )


def mix(
    docs: DataFrame,
    domain: Column,
    weights: Mapping[str, Mapping[str, int]],
    percent: int = 100,
    epochs: int = 2,
    seed: int = 1,
) -> DataFrame:
    """Rows of `docs`, once per epoch they are drawn in, with `mix_domain`, `mix_epoch`,
    `mix_tokens` and `mix_taken` (tokens drawn; less than all only at the prefix's end).

    Columns of `docs` come out unchanged; one named like one of these four is an error.
    Texts do not move: only rows in the hash bucket where a leaf's prefix ends are
    shuffled. Bucket totals are combined before they are.
    """
    refuse(docs, ADDED)
    docs, restore = set_aside(docs, INNER)
    marked = docs.withColumns(
        {
            "mix_domain": F.coalesce(domain, F.lit("")),
            "mix_lang": F.coalesce(F.col("lang"), F.lit("")),
            "mix_source": F.coalesce(F.col("source"), F.lit("")),
            "mix_tokens": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
        }
    )
    counted = materialize(marked.select("doc_id", *LEVELS, "mix_tokens"), "mix-tokens")
    leaves = counted.groupBy(*LEVELS).agg(F.sum("mix_tokens").alias("tokens"))
    budgets = leaf_budgets(leaves, weights, percent, epochs).filter("budget > 0")
    budgets = materialize(
        budgets.select(
            *LEVELS,
            F.expr("budget DIV tokens").alias("mix_full"),
            (F.col("budget") % F.col("tokens")).alias("mix_rest"),
        ),
        "mix-budgets",
    )
    key = order_hash(seed, F.col("mix_full"), F.col("doc_id"))
    bucket = F.substring(key, 1, DIGITS)
    # The bucket in which the prefix ends: first by the leading digits, then within those.
    sums = (
        join_leaves(counted, budgets)
        .groupBy(*LEVELS, "mix_rest", bucket.alias("mix_bucket"))
        .agg(F.sum("mix_tokens").alias("n"))
        .withColumn("mix_coarse", F.substring("mix_bucket", 1, COARSE))
    )
    coarse = sums.groupBy(*LEVELS, "mix_rest", "mix_coarse").agg(F.sum("n").alias("n"))
    coarse = _last_before_rest(coarse, "mix_coarse", F.lit(0).cast("long"))
    coarse = coarse.select(*LEVELS, F.col("mix_last").alias("mix_coarse"), F.col("mix_begin").alias("mix_offset"))
    ends = _last_before_rest(sums.join(coarse, [*LEVELS, "mix_coarse"]), "mix_bucket", F.col("mix_offset"))
    plan = materialize(budgets.join(ends, LEVELS, "left"), "mix-plan")
    known = join_leaves(marked, plan).withColumn("mix_key", key).withColumn("mix_bucket", bucket)
    whole = known.withColumn("mix_in", F.coalesce(F.col("mix_bucket") < F.col("mix_last"), F.lit(False)).cast("long"))
    whole = (
        whole.withColumn("mix_copies", F.col("mix_full") + F.col("mix_in"))
        .filter("mix_copies > 0")
        .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mix_copies") - 1)))
        .withColumn("mix_taken", F.col("mix_tokens"))
    )
    end = known.filter(F.col("mix_bucket") == F.col("mix_last"))
    ordered = Window.partitionBy(*LEVELS).orderBy("mix_key", "doc_id", "mix_tokens")
    before = F.col("mix_begin") + F.sum("mix_tokens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - F.col("mix_tokens")
    end = (
        end.withColumn("mix_before", before)
        .filter("mix_before < mix_rest")
        .withColumn("mix_epoch", F.col("mix_full"))
        .withColumn("mix_taken", F.least(F.col("mix_tokens"), F.col("mix_rest") - F.col("mix_before")))
    )
    columns = [F.col(f"`{c}`") for c in (*docs.columns, *ADDED)]
    return restore(whole.select(*columns).unionByName(end.select(*columns)))
