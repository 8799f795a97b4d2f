"""Counts of each sender's payments in sliding windows, with one state row for many senders.

A grouped count keeps a state row for each sender and window, width / step of them a payment.
Here senders are dealt into groups, and a group's state is one table: for each sender and stretch
of payments that share their windows, the ends of the first and the last that is open, and how
many payments. Payments of such a stretch are combined before the shuffle, so a dominant sender
is no larger than their stretches, and a group's stretches come packed, since each row that
Spark hands to a stateful Python function costs it several microseconds.

The counts, and the batch in which a window comes out, are those of the grouped count: besides
the stretches a group is sent an empty row for each end of their windows. Spark drops the rows
whose end the batch before had closed, so the least that is left is the group's first open end.
A timer wakes the group when the watermark reaches its next end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from paywatch.functions import micros

#: Keyed state with timers needs this store.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SHORT_STORE = "rocksdb"
#: Groups that senders are dealt into, and payments of a task that are combined together, and their windows.
GROUPS, ROWS_COMBINED, WINDOWS_COMBINED = 256, 1 << 20, 1 << 23
#: The mark by which Spark knows the column that it holds against the watermark.
DELAY = "spark.watermarkDelayMs"
KEYS = ["sender", "first", "last"]


def use_rocksdb(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") not in (STORE, SHORT_STORE):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


def _packed(stretches: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, stretches.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_table(stretches)
    return sink.getvalue().to_pybytes()


def _unpacked(stretches: bytes) -> pa.Table:
    return pa.ipc.open_stream(stretches).read_all()


class WindowCounts(StatefulProcessor):
    """Gives a group's closed windows with more than `threshold` payments of a sender; all times in microseconds."""

    def __init__(self, threshold: int, width: int, step: int):
        self.threshold, self.width, self.step = threshold, width, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "stretches binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        packed, ends = [], []
        for frame in rows:
            ends.append(int(frame["end"].min()))
            packed.extend(frame["stretches"].dropna())
        came = pa.concat_tables([_unpacked(each) for each in packed])
        open_end = min(ends)
        came = came.filter(pa.array(came["last"].to_numpy() >= open_end))
        if not len(came):
            return iter([])
        first = np.maximum(came["first"].to_numpy(), open_end)
        came = came.set_column(1, "first", pa.array(first))
        held = self._held()
        self._keep(pa.concat_tables([held, came]) if held is not None else came)
        earliest = int(first.min())
        if held is None or earliest < int(held["first"].to_numpy().min()):
            self._wake(earliest)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held, reached = self._held(), timerValues.getCurrentWatermarkInMs() * 1000
        if held is None:
            return
        first, last, n = (held[name].to_numpy() for name in ("first", "last", "n"))
        closed = np.maximum(0, (np.minimum(last, reached) - first) // self.step + 1)
        left = first + closed * self.step
        stays = left <= last
        if not stays.any():
            self.open.clear()
        elif closed.any():
            self._keep(held.set_column(1, "first", pa.array(left)).filter(pa.array(stays)))
            self._wake(int(left[stays].min()))
        names = held["sender"].combine_chunks().dictionary_encode(null_encoding="encode")
        row = np.repeat(np.arange(len(closed)), closed)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(closed) - closed, closed)
        windows = pa.table([names.indices.take(pa.array(row)), first[row] + nth * self.step, n[row]], ["sender", "end", "n"])
        counts = windows.group_by(["sender", "end"], use_threads=False).aggregate([("n", "sum")]).to_pandas()
        busy = counts[counts["n_sum"] > self.threshold]
        if len(busy):
            sender = names.dictionary.take(pa.array(busy["sender"])).to_pandas()
            yield pd.DataFrame({"sender_vpa": sender.to_numpy(), "end": busy["end"].to_numpy(), "txns": busy["n_sum"].to_numpy()})

    def close(self) -> None:
        pass

    def _held(self) -> pa.Table | None:
        held = self.open.get()
        return _unpacked(held[0]) if held else None

    def _keep(self, stretches: pa.Table) -> None:
        whole = stretches.group_by(KEYS, use_threads=False).aggregate([("n", "sum")]).select([*KEYS, "n_sum"]).rename_columns([*KEYS, "n"])
        self.open.update((_packed(whole),))

    def _wake(self, end: int) -> None:
        # The watermark is kept in whole milliseconds.
        self.handle.registerTimer(-(-end // 1000))


def _micros_of(spark: SparkSession, width: str, step: str) -> tuple[int, int]:
    """The lengths of a window and of a step."""
    time = F.timestamp_micros(F.lit(0).cast("long"))
    lengths = [F.unix_micros(w["end"]) - F.unix_micros(w["start"]) for w in (F.window(time, width), F.window(time, step))]
    return tuple(spark.range(1).select(each.alias("n")).head().n for each in lengths)


def _stretches(transactions: DataFrame, width: int, step: int, groups: int) -> DataFrame:
    """(group, at, end, stretches): the stretches of a group of senders, packed, with the last of their ends, and
    a row without any for each end of their windows. `at` is the latest time of the payments combined."""
    together = max(1, min(ROWS_COMBINED, WINDOWS_COMBINED // (-(-width // step))))

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            at = rows["at"].to_numpy()
            ends = {"first": at - np.mod(at - width, step) + step, "last": at - np.mod(at, step) + width}
            for name, values in ends.items():
                rows = rows.append_column(name, pa.array(values))
            whole = rows.group_by(["group", *KEYS], use_threads=False).aggregate([("at", "count")]).sort_by("group")
            group, first, last = (whole[name].to_numpy() for name in ("group", "first", "last"))
            whole = whole.select([*KEYS, "at_count"]).rename_columns([*KEYS, "n"]).combine_chunks()
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            packs = [_packed(whole.slice(i, n)) for i, n in zip(starts, np.diff(starts, append=len(group)))]
            # Ends lie whole steps apart; each of a group's once. The group stands in the bits above the end's number.
            earliest, above = first.min(), group.astype(np.int64) << 40
            begins, stops = (first - earliest) // step + above, (last - earliest) // step + above
            order = np.argsort(begins)
            begins, stops = begins[order], stops[order]
            begins[1:] = np.maximum(begins[1:], np.maximum.accumulate(stops)[:-1] + 1)
            many = np.maximum(stops - begins + 1, 0)
            marks = np.repeat(begins - np.cumsum(many) + many, many) + np.arange(many.sum())
            table = pa.table(
                {
                    "group": np.concatenate([group[starts], marks >> 40]).astype(np.int32),
                    "at": np.full(len(packs) + len(marks), at.max()),
                    "end": np.concatenate([np.maximum.reduceat(last, starts), earliest + (marks & (1 << 40) - 1) * step]),
                    "stretches": pa.concat_arrays([pa.array(packs, pa.binary()), pa.nulls(len(marks), pa.binary())]),
                }
            )
            yield from table.to_batches(max_chunksize=65_536)

        waiting, held = [], 0
        for batch in batches:
            for i in range(0, len(batch), together):
                part = batch.slice(i, together)
                if held + len(part) > together:
                    yield from of(pa.Table.from_batches(waiting))
                    waiting, held = [], 0
                waiting.append(part)
                held += len(part)
        if held:
            yield from of(pa.Table.from_batches(waiting))

    group = F.pmod(F.xxhash64("sender_vpa"), F.lit(groups)).cast("int").alias("group")
    timed = transactions.select(group, F.col("sender_vpa").alias("sender"), micros(F.col("timestamp")).alias("at")).where("at IS NOT NULL")
    return timed.mapInArrow(combined, "group int, at long, end long, stretches binary")


def busy_windows(transactions: DataFrame, threshold: int, width: str, step: str, delay: str, groups: int = GROUPS) -> DataFrame:
    """(sender_vpa, start, end, txns) of the closed windows with more than `threshold` payments of a sender."""
    spark = transactions.sparkSession
    use_rocksdb(spark)
    length, shift = _micros_of(spark, width, step)
    timed = _stretches(transactions, length, shift, groups).withColumn("_event_time", F.timestamp_micros("at")).withWatermark("_event_time", delay)
    # Held against the watermark like a window, by its end.
    mark = next(field.metadata[DELAY] for field in timed.schema if field.name == "_event_time")
    rows = timed.select("group", "end", "stretches", F.timestamp_micros("end").alias("_closes", metadata={DELAY: mark}))
    counted = rows.groupBy("group").transformWithStateInPandas(
        WindowCounts(threshold, length, shift), "sender_vpa string, end long, txns long", "append", "EventTime"
    )
    return counted.select("sender_vpa", (F.col("end") - length).alias("start"), "end", "txns")
