import os
from datetime import datetime, timedelta

import pytest
from conftest import column
from pyspark.sql import functions as F

from paywatch.functions import micros
from paywatch.plans import kpis
from paywatch.plans.features import add_new_receiver, build_features
from paywatch.schema import RAW
from paywatch.streaming import (
    append_to_table,
    daily_trend_stream,
    first_payments_stream,
    latest_to_table,
    new_pairs_stream,
    payment_alerts_stream,
    payment_velocity_stream,
    read_stream,
    velocity_alerts_stream,
    weekly_rate_stream,
)


@pytest.fixture
def arriving(spark, payments, tmp_path):
    """A stream that sees each list of rows as one batch, in this order."""

    def build(*batches):
        folder = tmp_path / "arriving"
        number = 0
        for i, rows in enumerate(batches):
            named = [row | {"txn_id": f"T{number + j:04d}"} for j, row in enumerate(rows)]
            number += len(rows)
            payments(*named).coalesce(1).write.mode("append").parquet(str(folder))
            # The source takes files in the order of their times.
            for part in folder.glob("*.parquet"):
                if not (tmp_path / part.name).exists():
                    (tmp_path / part.name).touch()
                    os.utime(part, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
        return read_stream(spark, str(folder), RAW, files_per_batch=1)

    return build


def flagged(stream):
    return stream.withColumns({"fraud_flag": F.col("is_fraud"), "fraud_probability": F.lit(0.0)})


def hour(day, h):
    return {"timestamp": datetime(2024, 1, day, h), "is_fraud": 1}


def test_late_rows_within_the_delay_count_and_later_ones_do_not(arriving):
    stream = arriving(
        [hour(1, 10)],
        [hour(2, 0)],
        [hour(1, 23)],  # one hour behind: still open
        [hour(3, 12)],  # moves the watermark past the first two days
        [hour(3, 13)],  # which come out with this batch
        [hour(1, 11)],  # too late
        [hour(4, 12)],
    )
    out = append_to_table(daily_trend_stream(flagged(stream), "2 hours"), "late")
    assert column(out, "fraud_txns", "txn_date") == [2, 1, 2]


def test_closed_days_equal_the_batch_result(arriving, payments):
    batches = [[hour(day, h) for h in range(0, 24, 5)] for day in range(1, 6)]
    stream = arriving(*batches)
    out = append_to_table(daily_trend_stream(flagged(stream)), "days").orderBy("txn_date").collect()
    batch = kpis.daily_trend(flagged(payments(*[row for rows in batches for row in rows])))
    assert out == batch.collect()[:4]


def test_weeks_from_monday(arriving):
    stream = arriving([hour(7, 23), hour(8, 0)], [hour(20, 0)])
    out = append_to_table(weekly_rate_stream(flagged(stream)), "weeks")
    assert column(out, "week_start", "week_start") == [datetime(2024, 1, 1), datetime(2024, 1, 8)]


def test_velocity_alert_needs_more_than_the_threshold(arriving):
    start = datetime(2024, 1, 1, 12)
    burst = [{"sender_vpa": "fast", "timestamp": start + timedelta(seconds=i)} for i in range(11)]
    calm = [{"sender_vpa": "calm", "timestamp": start + timedelta(seconds=i)} for i in range(10)]
    stream = arriving(burst[:6] + calm, burst[6:], [hour(2, 0)])
    out = append_to_table(velocity_alerts_stream(stream), "alerts")
    assert {r.sender_vpa for r in out.collect()} == {"fast"}
    # Every 5-minute step of the hour that holds the burst.
    assert column(out, "txns", "window_start") == [11] * 12


def grouped_alerts(stream, threshold, width, step, delay):
    """Plain version: a grouped count, with a state row for each sender and window."""
    timed = stream.withColumn("t", F.timestamp_micros(micros(F.col("timestamp")))).withWatermark("t", delay)
    counts = timed.groupBy(F.window("t", width, step), "sender_vpa").agg(F.count("*").alias("txns"))
    return counts.where(F.col("txns") > threshold).select("sender_vpa", F.unix_micros("window.start").alias("start"), "txns")


@pytest.mark.parametrize("width, step, threshold", [("1 hour", "5 minutes", 1), ("7 minutes", "3 minutes", 0)])
def test_velocity_alerts_of_late_payments(arriving, width, step, threshold):
    """Batches whose payments come late by more and less than the delay, some at a window's very end."""
    at = lambda m, s=0, us=0: datetime(2024, 1, 1, 12) + timedelta(minutes=m, seconds=s, microseconds=us)
    batches = [[(f"s{i % 3}", at(i * 7 % 40, i)) for i in range(30)] + [(None, at(3)), (None, at(4)), ("s0", None)]]
    batches.append([("s0", at(100)), ("s1", at(20)), ("s1", at(21)), ("old", at(30)), ("old", at(30, 1))])
    batches.append([("s2", at(m, 59, 999_999)) for m in (1, 24, 29, 30, 34, 35, 44, 45, 89, 90)] + [("old", at(44)), ("s1", at(76))])
    batches.append([("s0", at(170)), ("s2", at(99)), ("s2", at(99)), (None, at(95)), (None, at(96)), ("old", at(60))])
    batches += [[("s1", at(m)), ("s1", at(m, 0, 1)), ("old", at(m + 4))] for m in (90, 105, 110, 160)] + [[("end", at(400))]]
    stream = arriving(*[[{"sender_vpa": s, "timestamp": t} for s, t in batch] for batch in batches])
    want = append_to_table(grouped_alerts(stream, threshold, width, step, "10 minutes"), "plain")
    found = append_to_table(velocity_alerts_stream(stream, threshold, width, step), "alerts")
    found = found.select("sender_vpa", F.unix_micros(F.col("window_start").cast("timestamp")).alias("start"), "txns")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(found) == rows(want) and len(rows(want)) > 20


def test_velocity_alerts_keep_one_state_row_for_many_windows(arriving, tmp_path):
    many = [{"sender_vpa": f"s{i}", "timestamp": datetime(2024, 1, 1, 12) + timedelta(minutes=i)} for i in range(300)]
    query = velocity_alerts_stream(arriving(many)).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "p")).trigger(availableNow=True).start(str(tmp_path / "o"))
    query.awaitTermination()
    # State rows and timers of 300 payments in 3,600 windows.
    assert max(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]) <= 3 * 300


def test_first_payments_equal_the_batch_feature(arriving, payments):
    rows = [
        {"sender_vpa": s, "receiver_vpa": r, "timestamp": datetime(2024, 1, d)}
        for s, r, d in [("a", "x", 3), ("a", "y", 4), ("a", "x", 2), ("b", "x", 1), ("a", "y", 5)]
    ]
    seen = latest_to_table(first_payments_stream(arriving(rows[:2], rows[2:])), "firsts")
    firsts = {r.txn_id for r in first_payments_stream(seen).collect()}
    batch = add_new_receiver(payments(*rows)).where("is_new_receiver = 1")
    assert firsts == {r.txn_id for r in batch.collect()} == {"T0001", "T0002", "T0003"}


def test_daily_stream_and_batch_name_the_same_columns(arriving, payments):
    stream = daily_trend_stream(flagged(arriving([hour(1, 1)])))
    batch = kpis.daily_trend(flagged(payments(hour(1, 1))))
    assert stream.columns == batch.columns
    assert [f.dataType for f in stream.schema] == [f.dataType for f in batch.schema]


def ordered(days=2, senders=3, seed=1):
    """Payments in the order of their times, with bursts, ties and a sender who falls silent."""
    import random

    dice, t, rows = random.Random(seed), datetime(2024, 1, 1), []
    while t < datetime(2024, 1, 1 + days):
        sender = dice.randrange(senders)
        if not (sender == 0 and t.day > 1):
            rows += [{"sender_vpa": f"s{sender}" if sender else None, "timestamp": t}] * dice.choice([1, 1, 1, 3])
        t += timedelta(seconds=dice.choice([0, 0, 7, 400, 1500]), microseconds=dice.choice([0, 1]))
    return rows


@pytest.mark.parametrize("bucket", [7_000_000, 60_000_000, 3_600_000_000, 10_000_000_000])
def test_payment_velocity_equals_the_batch_feature(arriving, payments, bucket):
    rows = ordered()
    size = len(rows) // 6 + 1
    stream = payment_velocity_stream(arriving(*[rows[i : i + size] for i in range(0, len(rows), size)]), bucket=bucket)
    got = {r.txn_id: r.sender_txn_velocity for r in append_to_table(stream, "velocity").collect()}
    batch = build_features(payments(*rows), ["sender_txn_velocity_1h"])
    # A batch's ties may be cut in two: those of the later batch still do not count each other.
    assert got == {r.txn_id: r.sender_txn_velocity_1h for r in batch.collect()} and max(got.values()) > 5


def test_payment_velocity_keeps_a_bounded_state(spark, arriving, tmp_path):
    rows = ordered(days=4)
    size = len(rows) // 8 + 1
    stream = arriving(*[rows[i : i + size] for i in range(0, len(rows), size)], [{"sender_vpa": "late", "timestamp": datetime(2024, 2, 1)}],
                      [{"sender_vpa": "later", "timestamp": datetime(2024, 3, 1)}])
    path = str(tmp_path / "counted")
    minutes = 5
    append_to_table(payment_velocity_stream(stream, bucket=minutes * 60_000_000), "velocity", path)
    state = spark.read.format("statestore").option("stateVarName", "buckets").load(f"{path}-progress")
    held = state.groupBy("key.sender_vpa").count().collect()
    # The silent senders' state is gone, by timer; the last ones hold a bucket each.
    assert {r.sender_vpa for r in held} <= {"late", "later"} and all(r["count"] <= (60 + 10) // minutes + 2 for r in held)


def test_payment_alert_comes_in_the_batch_of_the_payment(arriving, spark, tmp_path):
    start = datetime(2024, 1, 1, 12)
    burst = [{"sender_vpa": "fast", "timestamp": start + timedelta(seconds=i)} for i in range(12)]
    late = {"sender_vpa": "fast", "timestamp": start - timedelta(minutes=5)}
    stream = payment_alerts_stream(arriving(burst[:6], burst[6:], [late, burst[11]]))
    got = append_to_table(stream, "alerts").orderBy("txn_id").collect()
    # The 12th payment has 11 before it; its repeat in the last batch also counts the late one.
    assert [(r.txn_id, r.sender_txn_velocity) for r in got] == [("T0011", 11), ("T0013", 12)]


def test_payment_velocity_refuses_empty_buckets(arriving):
    with pytest.raises(ValueError):
        payment_velocity_stream(arriving([hour(1, 1)]), bucket=0)


def test_new_pairs_are_forgotten_after_their_time(arriving):
    pair = {"sender_vpa": "a", "receiver_vpa": "x"}
    stream = arriving([pair | hour(1, 0)], [pair | hour(1, 5)], [{"sender_vpa": "b"} | hour(9, 0)], [{"sender_vpa": "c"} | hour(9, 1)], [pair | hour(9, 2)])
    got = sorted(r.sender_vpa for r in append_to_table(new_pairs_stream(stream, "2 days"), "pairs").collect())
    assert got == ["a", "a", "b", "c"]
