"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of slots, bytes are summed per slot, and a
small versioned table says which shard holds which slot. Rebalancing edits that
table; the hash of a record never changes.

Null and empty texts have size 16 and hash like any other row; a null text has a
null checksum. Null ids are hashed by their text alone. Repeated rows share a slot.
An empty table gives no rows. Columns other than the named ones are not touched.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paywatch.session import materialize, scratch_path

SLOTS = 16_384
#: Bytes that a record takes besides its text.
RECORD_BYTES = 16
#: Rows ordered together when places within a shard are numbered.
RUN_ROWS = 100_000
MAP_SCHEMA = "version int, virtual_slot int, shard int, bytes long"


def record_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """Id, size, checksum and virtual slot of each record."""
    crc = F.crc32(F.col(text_col))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + RECORD_BYTES).alias("size"),
        crc.alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(id_col), crc), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def first_map(shards: int, slots: int = SLOTS) -> dict[int, int]:
    return {slot: slot % shards for slot in range(slots)}


def edit_map(current: Mapping[int, int], slot_bytes: Mapping[int, int], shards: int) -> dict[int, int]:
    """Move slots from the fullest shard to the emptiest while that narrows their gap.

    Works on the slot table alone (its length is fixed). New shards start empty; of
    each pair the slot nearest to half the gap moves, so few slots change place.
    """
    if shards < 1:
        raise ValueError("At least one shard is needed")
    edited = dict(current)
    loads = [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    homeless = []
    for slot, shard in current.items():
        size = slot_bytes.get(slot, 0)
        if shard >= shards:
            homeless.append((size, slot))
        else:
            loads[shard] += size
            held[shard].append((size, slot))
    for size, slot in sorted(homeless, reverse=True):
        shard = loads.index(min(loads))
        edited[slot] = shard
        loads[shard] += size
        held[shard].append((size, slot))
    for slots in held:
        slots.sort()
    while True:
        high, low = loads.index(max(loads)), loads.index(min(loads))
        gap = loads[high] - loads[low]
        place = bisect_left(held[high], ((gap + 1) // 2, -1))
        near = [p for p in (place - 1, place) if 0 <= p < len(held[high]) and 0 < held[high][p][0] < gap]
        if not near:
            return edited
        size, slot = held[high].pop(min(near, key=lambda p: abs(2 * held[high][p][0] - gap)))
        insort(held[low], (size, slot))
        loads[high] -= size
        loads[low] += size
        edited[slot] = low


def write_map(spark: SparkSession, path: str, version: int, shards: Mapping[int, int], slot_bytes: Mapping[int, int]) -> None:
    """Add one version to the stored map."""
    rows = [(version, slot, shard, slot_bytes.get(slot, 0)) for slot, shard in sorted(shards.items())]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(path).filter(F.col("version") == version)


def measured_bytes(sizes: DataFrame) -> dict[int, int]:
    """Bytes per virtual slot: at most as many rows as there are slots."""
    return {r[0]: r[1] for r in sizes.groupBy("virtual_slot").agg(F.sum("size")).collect()}


def place(sizes: DataFrame, slot_map: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """Shard and place of every record; places are gapless from 0 in each shard.

    A shard lists its slots in order, each slot its runs in order. Rows are numbered
    within a run only; where runs begin comes from counts, so no task sees a shard.
    """
    runs = max(1, sizes.count() // (run_rows * SLOTS) + 1)
    sizes = sizes.withColumn("run", F.pmod(F.xxhash64(F.lit(1), "doc_id", "text_crc32"), F.lit(runs)).cast("int"))
    counts = (
        sizes.groupBy("virtual_slot", "run")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(F.broadcast(slot_map.select("virtual_slot", "shard", "version")), "virtual_slot")
    )
    before = Window.partitionBy("shard").orderBy("virtual_slot", "run")
    begins = counts.select(
        "virtual_slot",
        "run",
        "shard",
        "version",
        (F.sum("n").over(before) - F.col("n")).alias("begin"),
    )
    within = Window.partitionBy("virtual_slot", "run").orderBy("doc_id", "text_crc32", "size")
    return (
        sizes.withColumn("nth", F.row_number().over(within))
        .join(begins, ["virtual_slot", "run"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("begin") + F.col("nth") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot",
            F.col("version").alias("map_version"),
        )
    )


def shard(
    docs: DataFrame, shards: int, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text", map_path: str | None = None
) -> DataFrame:
    """Deal records into shards of nearly equal bytes.

    The texts are read once; what follows works on sizes. Version 0 of the map deals
    slots in turn, version 1 is version 0 edited by the measured bytes.
    """
    spark = docs.sparkSession
    sizes = materialize(record_sizes(docs, id_col, text_col, slots), "sizes")
    slot_bytes = measured_bytes(sizes)
    path = map_path or scratch_path(spark, "slot-map")
    initial = first_map(shards, slots)
    write_map(spark, path, 0, initial, slot_bytes)
    write_map(spark, path, 1, edit_map(initial, slot_bytes, shards), slot_bytes)
    return place(sizes, read_map(spark, path, 1))
