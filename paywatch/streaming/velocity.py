"""The trailing count of every streamed payment, in the batch in which the payment comes.

State per sender: for each bucket of time the instants of its payments and how many fell on
each. A payment at t counts the sender's payments in [t - width, t), like the batch feature;
payments of its own instant do not count each other. The instants make the count exact, the
buckets make it cheap to keep: a batch writes only the buckets it adds to, and a bucket is
removed whole once it ends `width` before the watermark, or `width` and the delay before the
sender's own latest payment, since the watermark will have come as far by the next batch. So a
sender holds at most (width + delay) / bucket + 2 buckets, whatever their history and however
much one batch brings, and payments that share an instant take one entry. A timer clears a
sender who has fallen silent.

Payments that come in the order of their times get what the batch feature gives. One that
comes late, but within the delay, is counted with what is known by then; payments that went
out before it are not corrected. Later ones are dropped by the watermark. A batch holds one
sender's new payments in one task, as two numbers each, so `files_per_batch` bounds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from paywatch.functions import micros
from paywatch.plans.operations import VELOCITY_THRESHOLD
from paywatch.streaming.live import _ntz, _timed
from paywatch.streaming.windows import use_rocksdb

HOUR = 3_600_000_000
MINUTE = 60_000_000


class TrailingCounts(StatefulProcessor):
    """Counts a sender's payments before each payment; all times in microseconds."""

    def __init__(self, width: int, bucket: int, delay: int):
        # The watermark is kept in whole milliseconds.
        self.width, self.bucket, self.delay = width, bucket, delay + 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buckets = handle.getMapState("buckets", "bucket long", "instants binary, counts binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        frames = [frame[["txn_id", "at"]] for frame in rows]
        came = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]
        at = came["at"].to_numpy(np.int64)
        held = self._held()
        if not held:
            self._wake(int(at.max()))
        new, new_counts = np.unique(at, return_counts=True)
        instants = np.concatenate([new, *(i for i, _ in held.values())])
        counts = np.concatenate([new_counts, *(c for _, c in held.values())])
        order = np.argsort(instants, kind="stable")
        instants, before = instants[order], np.concatenate([[0], np.cumsum(counts[order])])
        until = before[np.searchsorted(instants, at, "left")]
        out_of = before[np.searchsorted(instants, at - self.width, "left")]
        passed = max(self._passed(timerValues), int(instants[-1]) - self.delay - self.width)
        self._remove(held, passed)
        self._add(held, new, new_counts, passed)
        yield pd.DataFrame({"sender_vpa": key[0], "txn_id": came["txn_id"], "at": at, "velocity": (until - out_of).astype(np.int32)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = self._held()
        self._remove(held, self._passed(timerValues))
        if held:
            self._wake(max(int(instants[-1]) for instants, _ in held.values()))
        return iter([])

    def close(self) -> None:
        pass

    def _held(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        return {b: (np.frombuffer(i, np.int64), np.frombuffer(c, np.int64)) for (b,), (i, c) in self.buckets.iterator()}

    def _passed(self, timers) -> int:
        """No payment to come counts one before this time."""
        return timers.getCurrentWatermarkInMs() * 1000 - self.width

    def _remove(self, held: dict, passed: int) -> None:
        for bucket in [b for b in held if (b + 1) * self.bucket <= passed]:
            del held[bucket]
            self.buckets.removeKey((bucket,))

    def _add(self, held: dict, new: np.ndarray, new_counts: np.ndarray, passed: int) -> None:
        number = new // self.bucket
        for bucket in np.unique(number[(number + 1) * self.bucket > passed]).tolist():
            own = number == bucket
            instants, counts = held.get(bucket, (np.zeros(0, np.int64),) * 2)
            instants, place = np.unique(np.concatenate([instants, new[own]]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, new_counts[own]]), len(instants)).astype(np.int64)
            self.buckets.updateValue((bucket,), (instants.tobytes(), counts.tobytes()))

    def _wake(self, latest: int) -> None:
        end = (latest // self.bucket + 1) * self.bucket + self.width
        self.handle.registerTimer(-(-end // 1000))


def payment_velocity_stream(
    transactions: DataFrame, width: int = HOUR, bucket: int = MINUTE, delay: int = 10 * MINUTE
) -> DataFrame:
    """txn_id, timestamp, sender_vpa and sender_txn_velocity of every payment; for append mode.

    `width`, `bucket` and `delay` are in microseconds. The session's state store is set to RocksDB,
    the one that keeps keyed state with timers."""
    if bucket <= 0 or width <= 0 or delay < 0:
        raise ValueError(f"Width and bucket must be positive, the delay not negative: {width}, {bucket}, {delay}")
    use_rocksdb(transactions.sparkSession)
    timed = _timed(transactions, f"{-(-delay // 1000)} milliseconds").select("sender_vpa", "txn_id", micros(F.col("timestamp")).alias("at"), "_event_time")
    counted = timed.groupBy("sender_vpa").transformWithStateInPandas(
        TrailingCounts(width, bucket, delay), "sender_vpa string, txn_id string, at long, velocity int", "append", "EventTime"
    )
    return counted.select(
        "txn_id", _ntz(F.timestamp_micros("at")).alias("timestamp"), "sender_vpa", F.col("velocity").alias("sender_txn_velocity")
    )


def payment_alerts_stream(
    transactions: DataFrame,
    threshold: int = VELOCITY_THRESHOLD,
    width: int = HOUR,
    bucket: int = MINUTE,
    delay: int = 10 * MINUTE,
) -> DataFrame:
    """Payments before which their sender made more than `threshold` others within `width`,
    each in the batch in which it comes."""
    counted = payment_velocity_stream(transactions, width, bucket, delay)
    return counted.where(F.col("sender_txn_velocity") > threshold)
