"""URL filters by a cascade of Bloom filters.

Level 0 holds the listed keys, level 1 those other keys of the corpus that level 0
takes for listed, level 2 the listed keys that level 1 takes for such, and so on
until no key is left. Over the universe it was built for, the cascade answers
exactly, and a lookup needs no join.

A rule is a host and a path prefix. The keys of a URL are the suffixes of its host,
no longer than any rule's, each with the prefixes of its path that have the length
of some rule's path. Null URLs and URLs without '://' have an empty host and path
and fit no rule. Repeated rows are judged each. An empty table gives no rows, and
an empty list fits nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywatch.llm.aside import set_aside

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits per key of level 0 and of the others; later levels hold few keys.
FIRST_BITS, LATER_BITS = 12.0, 2.9
#: Beyond so many bytes of filters, keys are joined instead of looked up.
MOST_BYTES = 256 << 20
#: Names of columns in between; a table's own columns of these names come out unchanged.
INNER = ("url_keys", "url_h1", "url_h2", "url_place", "url_kind", "url_row", "best")


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: np.ndarray

    def holds(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        found = np.ones(len(h1), bool)
        first, step = h1 % self.bits, h2 % self.bits
        for i in range(self.hashes):
            at = (first + i * step) % self.bits
            found &= (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
        return found


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def lists(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether each key of the universe is listed."""
        answer = np.full(len(h1), len(self.levels) % 2 == 1)
        going = np.arange(len(h1))
        for depth, level in enumerate(self.levels):
            held = level.holds(h1[going], h2[going])
            answer[going[~held]] = depth % 2 == 1
            going = going[held]
        return answer


def key_hashes(key: Column, seed: int = 0) -> list[Column]:
    """128 bits of hash in two columns."""
    return [F.xxhash64(F.lit(seed), key).alias("h1"), F.xxhash64(F.lit(seed + 1), key).alias("h2")]


def build_level(keys: DataFrame, n: int, bits_per_key: float, depth: int = 0) -> Level:
    """One Bloom filter; its words are combined in Spark and have a size known beforehand.

    Small filters of one length would confuse the same keys at every depth, so each
    depth has a length of its own.
    """
    bits = max(64, math.ceil(n * bits_per_key / 64) * 64) - depth % 31
    hashes = max(1, round(bits_per_key * math.log(2)))
    first, step = F.pmod("h1", F.lit(bits)), F.pmod("h2", F.lit(bits))
    places = F.array(*[F.pmod(first + i * step, F.lit(bits)) for i in range(hashes)])
    set_words = (
        keys.select(F.explode(places).alias("at"))
        .groupBy(F.expr("at DIV 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
        .collect()
    )
    words = np.zeros(bits // 64 + 1, np.uint64)
    for word, value in set_words:
        words[word] = np.uint64(value & 0xFFFFFFFFFFFFFFFF)
    return Level(bits, hashes, words)


def held_by(keys: DataFrame, level: Level) -> DataFrame:
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = (batch.column(i).to_numpy() for i in (0, 1))
            yield batch.filter(pa.array(level.holds(h1, h2)))

    return keys.select("h1", "h2").mapInArrow(keep, "h1 long, h2 long")


def build_cascade(listed: DataFrame, universe: DataFrame, most_bytes: int = MOST_BYTES) -> Cascade | None:
    """Cascade for `listed` over `universe` (columns h1, h2); None if it would be too large."""
    listed = listed.select("h1", "h2").distinct().persist()
    wrong = universe.select("h1", "h2").distinct().join(listed, ["h1", "h2"], "left_anti")
    mine, levels, size = listed, [], 0
    try:
        n = mine.count()
        while n:
            per_key = LATER_BITS if levels else FIRST_BITS
            size += n * per_key / 8
            if size > most_bytes:
                return None
            level = build_level(mine, n, per_key, len(levels))
            levels.append(level)
            # What the new level takes for its own is the next level's content.
            mine, wrong = held_by(wrong, level).persist(), mine
            n = mine.count()
        return Cascade(tuple(levels))
    finally:
        listed.unpersist()


def parts(url: Column) -> tuple[Column, Column]:
    """Host, in ASCII lower case, and path of a URL."""
    rest = F.when(url.contains("://"), F.regexp_replace(url, r"(?s)^.*?://", ""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def candidate_keys(host: Column, path: Column, rules: Sequence[str]) -> Column:
    """Keys of a URL that some rule could equal, longest first, then by text."""
    most = max((rule.split("/", 1)[0].count(".") + 1 for rule in rules), default=0)
    lengths = sorted({len(rule) - rule.index("/") for rule in rules})
    labels = F.split(host, r"\.")
    n = F.size(labels)
    starts = F.sequence(F.greatest(F.lit(1), n - most + 1), n)
    suffixes = F.transform(starts, lambda i: F.concat_ws(".", F.slice(labels, i, n - i + 1)))
    prefixes = F.array_compact(
        F.array(*[F.when(F.length(path) >= k, F.substring(path, 1, k)) for k in lengths])
    )
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    ordered = F.array_sort(F.transform(keys, lambda k: F.struct((-F.length(k)).alias("n"), k.alias("key"))))
    return ordered["key"]


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], default: str = "allow", most_bytes: int = MOST_BYTES) -> DataFrame:
    """`pages` with `host`, `path`, `rule` (longest that fits) and `verdict`.

    `rules` are (verdict, rule) pairs, such as ("block", "example.com/de/"); a rule
    without a path fits none. All columns of `pages` stay; one that is named like one of
    these four is replaced.
    """
    spark = pages.sparkSession
    texts = [rule for _, rule in rules]
    if len(set(texts)) < len(texts):
        raise ValueError("A rule is listed twice")
    if any("/" not in rule for rule in texts):
        raise ValueError("A rule needs a path, at least /")
    host, path = parts(F.col("url"))
    pages, restore = set_aside(pages, INNER)
    judged = pages.withColumns({"host": host, "path": path})
    if not rules:
        return restore(judged.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)}))
    judged = judged.withColumn("url_keys", candidate_keys(F.col("host"), F.col("path"), texts))
    universe = judged.select(F.explode("url_keys").alias("key")).distinct().select(*key_hashes(F.col("key"))).persist()
    verdicts = list(dict.fromkeys(verdict for verdict, _ in rules))
    cascades = []
    try:
        for verdict in verdicts:
            mine = spark.createDataFrame([(rule,) for v, rule in rules if v == verdict], "key string")
            cascades.append(build_cascade(mine.select(*key_hashes(F.col("key"))), universe, most_bytes))
    finally:
        universe.unpersist()
    if any(cascade is None for cascade in cascades):
        return restore(_joined(judged, rules, default))
    lookup = spark.sparkContext.broadcast(cascades)

    def first_listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = None
        for batch in batches:
            names = names or batch.schema.names
            keys = batch.column(names.index("url_h1"))
            h1, h2 = (batch.column(names.index(c)).flatten().to_numpy(zero_copy_only=False) for c in ("url_h1", "url_h2"))
            ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(keys), 0).to_numpy())])
            which = np.zeros(len(h1), np.int32)
            for k, cascade in enumerate(lookup.value, 1):
                which[(which == 0) & cascade.lists(h1, h2)] = k
            hits = np.flatnonzero(which)
            first = np.searchsorted(hits, ends[:-1])
            has = first < len(hits)
            has[has] = hits[first[has]] < ends[1:][has]
            place, kind = np.zeros(len(keys), np.int32), np.zeros(len(keys), np.int32)
            place[has] = hits[first[has]] - ends[:-1][has] + 1
            kind[has] = which[hits[first[has]]]
            kept = batch.select([c for c in names if c not in ("url_h1", "url_h2")])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(place), pa.array(kind)], names=[*kept.schema.names, "url_place", "url_kind"]
            )

    hashed = judged.withColumns(
        {
            "url_h1": F.transform("url_keys", lambda k: key_hashes(k)[0]),
            "url_h2": F.transform("url_keys", lambda k: key_hashes(k)[1]),
        }
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in judged.schema)
    found = hashed.mapInArrow(first_listed, f"{schema}, url_place int, url_kind int")
    names = F.array(*[F.lit(v) for v in verdicts])
    found = found.withColumns(
        {
            "rule": F.when(F.col("url_place") > 0, F.element_at("url_keys", F.col("url_place"))),
            "verdict": F.coalesce(F.when(F.col("url_kind") > 0, F.element_at(names, F.col("url_kind"))), F.lit(default)),
        }
    )
    return restore(found.drop("url_keys", "url_place", "url_kind"))


def _joined(judged: DataFrame, rules: Sequence[tuple[str, str]], default: str) -> DataFrame:
    """The same answers by a join on the keys, for lists too long to broadcast."""
    spark = judged.sparkSession
    table = spark.createDataFrame([(r, v) for v, r in rules], "listed string, listed_verdict string")
    keys = judged.select(F.explode("url_keys").alias("key")).distinct()
    known = keys.join(table.hint("merge"), F.col("key") == F.col("listed")).drop("key")
    numbered = judged.withColumn("url_row", F.struct("host", "path"))
    shapes = numbered.select("url_row", "url_keys").dropDuplicates(["url_row"])
    best = (
        shapes.select("url_row", F.posexplode("url_keys").alias("nth", "key"))
        .join(known, F.col("key") == F.col("listed"))
        .groupBy("url_row")
        .agg(F.min_by(F.struct("listed", "listed_verdict"), "nth").alias("best"))
    )
    return (
        numbered.join(best, "url_row", "left")
        .withColumns({"rule": F.col("best.listed"), "verdict": F.coalesce(F.col("best.listed_verdict"), F.lit(default))})
        .drop("url_row", "url_keys", "best")
    )
