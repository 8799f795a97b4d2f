import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import BOTH_FORMS, at, column
from pyspark.sql import functions as F

from paywatch.functions import micros
from paywatch.operators import HeavyRule, Trailing, add_first_seen, add_trailing, add_usual_mismatch
from paywatch.operators.heavy import busy_instants, heavy_keys
from paywatch.operators.trailing import attach_trailing, bucketed, trailing_lookup
from paywatch.plans.features import (
    USUAL,
    add_amount_shape,
    add_amount_zscore,
    add_calendar,
    add_new_receiver,
    add_status,
    add_velocity,
    build_features,
)
from paywatch.schema import DERIVED, FEATURES


def test_night_is_eleven_to_six(payments):
    times = ["22:59:00", "23:00:00", "05:59:00", "06:00:00"]
    df = payments(*[{"timestamp": at(f"2024-01-03 {t}")} for t in times])
    assert column(add_calendar(df), "is_night_txn") == [0, 1, 1, 0]


def test_weekend_and_weekday(payments):
    df = add_calendar(payments(*[{"timestamp": datetime(2024, 1, day)} for day in (5, 6, 7, 8)]))
    assert column(df, "is_weekend") == [0, 1, 1, 0]
    assert column(df, "txn_day_of_week") == [4, 5, 6, 0]


def test_round_number_is_exact(payments):
    df = payments(*[{"amount": a} for a in ("500.00", "499.99", "1500.00", "250.00")])
    assert column(add_amount_shape(df), "amount_round_number") == [1, 0, 1, 0]


def test_only_success_counts(payments):
    df = payments(*[{"txn_status": s} for s in ("SUCCESS", "FAILED", "PENDING")])
    assert column(add_status(df), "txn_status_encoded") == [1, 0, 0]


@pytest.mark.parametrize("rule", BOTH_FORMS)
def test_velocity_edges_and_ties(payments, rule):
    times = ["00:00:00", "00:30:00", "00:30:00", "01:00:00", "01:30:00", "01:30:01"]
    df = payments(
        *[{"timestamp": at(f"2024-01-01 {t}"), "amount": 10 * (i + 1)} for i, t in enumerate(times)]
    )
    timed = df.withColumn("_at", micros(F.col("timestamp")))
    hour = Trailing(timedelta(hours=1), "n", "total")
    found = add_trailing(timed, "sender_vpa", "_at", "amount", [hour], rule)
    assert column(found, "n") == [0, 1, 1, 3, 3, 2]
    means = [None if n == 0 else float(s) / n for n, s in zip(column(found, "n"), column(found, "total"))]
    assert means == [None, 10, 10, 20, 30, 45]


@pytest.mark.parametrize("rule", BOTH_FORMS)
def test_left_edge_is_included_to_the_microsecond(payments, rule):
    df = payments(
        {"timestamp": at("2024-01-01 00:00:00")},
        {"timestamp": at("2024-01-01 01:00:00")},
        {"timestamp": at("2024-01-01 01:00:00.000001")},
    )
    assert column(add_velocity(df, rule), "sender_txn_velocity_1h") == [0, 1, 1]


@pytest.mark.parametrize("rule", BOTH_FORMS)
def test_senders_do_not_mix(payments, rule):
    df = payments({"sender_vpa": "a"}, {"sender_vpa": "b"}, {"sender_vpa": None}, {"sender_vpa": None, "timestamp": at("2024-01-01 00:10:00")})
    assert column(add_velocity(df, rule), "sender_txn_velocity_1h") == [0, 0, 0, 1]


@pytest.mark.parametrize("rule", BOTH_FORMS)
def test_single_payment_has_neutral_features(payments, rule):
    row = build_features(payments({"amount": "42.50"}), rule=rule).head()
    assert row.amount_zscore == 0
    assert row.sender_txn_count_30d == 0
    assert row.sender_avg_amount_30d == 42.5
    assert row.is_new_receiver == 1


@pytest.mark.parametrize("rule", BOTH_FORMS)
def test_equal_amounts_have_zscore_zero(payments, rule):
    df = payments(*[{"amount": "0.10"}] * 3)
    assert column(add_amount_zscore(df, rule), "amount_zscore") == [0, 0, 0]


@pytest.mark.parametrize("rule", BOTH_FORMS)
def test_zscore_is_cut_at_ten(payments, rule):
    df = payments(*[{"amount": "1.00"}] * 200, {"amount": "100000.00"})
    assert column(add_amount_zscore(df, rule), "amount_zscore")[-1] == 10


@pytest.mark.parametrize("rule", BOTH_FORMS)
def test_missing_amount_has_no_zscore_and_is_not_counted(payments, rule):
    df = payments(
        {"amount": 10},
        {"amount": None, "timestamp": at("2024-01-01 00:10:00")},
        {"amount": 30, "timestamp": at("2024-01-01 00:20:00")},
    )
    found = build_features(df, rule=rule)
    assert column(found, "amount_zscore")[1] is None
    assert column(found, "sender_txn_velocity_1h") == [0, 1, 1]


@pytest.mark.parametrize("rule", BOTH_FORMS)
def test_new_receiver(payments, rule):
    pairs = [("a", "x"), ("a", "x"), ("b", "x"), ("a", "y"), ("a|x", "y"), ("a", "x|y")]
    df = payments(*[{"sender_vpa": s, "receiver_vpa": r} for s, r in pairs])
    assert column(add_new_receiver(df, rule), "is_new_receiver") == [1, 0, 1, 1, 1, 1]


@pytest.mark.parametrize("rule", BOTH_FORMS)
def test_usual_device(payments, rule):
    devices = ["p", "q", "q", "p", "q", "r"]
    df = payments(
        *[{"device_id": d, "timestamp": datetime(2024, 1, 1, i)} for i, d in enumerate(devices)]
    )
    timed = df.withColumn("_at", micros(F.col("timestamp")))
    found = add_usual_mismatch(timed, "sender_vpa", "device_id", "_at", "off", rule)
    # Usual before each: none, p, q (later of two), q, p (reached 2 last), q.
    assert column(found, "off") == [0, 1, 0, 1, 1, 1]


def history(payments, seed, rows=300, senders=3, instants=120):
    """Random payments with many ties; one sender holds most rows."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    return [
        {
            "sender_vpa": rng.choice(["big"] * 4 + [f"s{i}" for i in range(senders)]),
            "receiver_vpa": f"r{rng.randrange(9)}",
            "device_id": f"d{rng.randrange(3)}",
            "amount": Decimal(rng.randrange(1, 10**6)) / 100,
            "timestamp": start + timedelta(minutes=17 * rng.randrange(instants) * rng.choice([1, 1, 40])),
        }
        for _ in range(rows)
    ]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("rule", BOTH_FORMS + [pytest.param(HeavyRule(floor=50), id="mixed")])
def test_features_against_plain_loops(payments, seed, rule):
    rows = history(payments, seed)
    found = {
        r.txn_id: r
        for r in build_features(
            payments(*rows), [*DERIVED.fieldNames(), *USUAL], rule
        ).collect()
    }
    assert len(found) == len(rows)
    for i, row in enumerate(rows):
        mine = found[f"T{i:04d}"]
        before = [
            o for o in rows if o["sender_vpa"] == row["sender_vpa"] and o["timestamp"] < row["timestamp"]
        ]

        def within(width):
            return [o for o in before if o["timestamp"] >= row["timestamp"] - width]

        month = within(timedelta(days=30))
        assert mine.sender_txn_velocity_1h == len(within(timedelta(hours=1)))
        assert mine.sender_txn_velocity_24h == len(within(timedelta(hours=24)))
        assert mine.sender_txn_count_30d == len(month)
        total = sum(o["amount"] for o in month)
        mean = float(total) / len(month) if month else float(row["amount"])
        assert mine.sender_avg_amount_30d == pytest.approx(mean)
        firsts = min(
            (o["timestamp"], j)
            for j, o in enumerate(rows)
            if (o["sender_vpa"], o["receiver_vpa"]) == (row["sender_vpa"], row["receiver_vpa"])
        )
        assert mine.is_new_receiver == int(firsts == (row["timestamp"], i))
        # The usual device: replay the instants of the sender's past.
        uses, best = {}, None
        for when in sorted({o["timestamp"] for o in before}):
            for o in before:
                if o["timestamp"] == when:
                    uses[o["device_id"]] = uses.get(o["device_id"], 0) + 1
            for device in {o["device_id"] for o in before if o["timestamp"] == when}:
                best = max(best or (0, when, ""), (uses[device], when, device))
        assert mine.usual_device_mismatch == int(bool(best) and best[2] != row["device_id"])


@pytest.mark.parametrize("floor", [0, 3, 10_000])
@pytest.mark.parametrize("bucket", [timedelta(seconds=1), timedelta(hours=7), timedelta(days=400)])
def test_bucket_length_does_not_matter(payments, bucket, floor):
    df = payments(*history(payments, 5)).withColumn("_at", micros(F.col("timestamp")))
    specs = [Trailing(timedelta(hours=1), "n1"), Trailing(timedelta(days=2), "n2", "total")]
    lookup = trailing_lookup(df, "sender_vpa", "_at", "amount", specs, bucket, HeavyRule(floor=floor))
    busy = busy_instants(df, "sender_vpa", "_at", HeavyRule(floor=2))
    assert busy.count() > 0
    split = attach_trailing(df, lookup, busy, "sender_vpa", "_at", specs)
    window = add_trailing(df, "sender_vpa", "_at", "amount", specs)
    for name in ("n1", "n2", "total"):
        assert column(split, name) == column(window, name)


def test_a_crowded_minute_is_cut(spark):
    """All rows of one key in one minute: no group holds more than a quarter second's."""
    minute, events = 60_000_000, spark.range(6000).selectExpr("'a' AS _key", "60000000 + id * 10000 AS _when")
    events = events.unionByName(spark.sql("SELECT 'b' AS _key, 60000000L AS _when"))
    cut = bucketed(events, minute, HeavyRule(floor=1000)).cache()
    sizes = {(r._key, r._bucket): r["count"] for r in cut.groupBy("_key", "_bucket").count().collect()}
    assert max(sizes.values()) == 25 and sum(sizes.values()) == 6001 and len(sizes) == 241
    assert cut.where("_bucket > _when OR _bucket + 250000 <= _when").count() == 0
    whole = bucketed(events, minute, HeavyRule())
    assert whole.select("_key", "_bucket").distinct().count() == 2


def test_result_does_not_depend_on_partitioning(payments):
    df = payments(*history(payments, 9, rows=120))

    def built(rows):
        # Standard deviations may differ in the last bit.
        digits = F.round("amount_zscore", 9)
        return build_features(rows).withColumn("amount_zscore", digits).orderBy("txn_id").collect()

    assert built(df.repartition(1)) == built(df.repartition(7, "amount"))


def test_only_the_features_asked_for(payments):
    df = build_features(payments({}), ["txn_hour", "is_new_receiver"])
    assert df.columns[-2:] == ["txn_hour", "is_new_receiver"]
    assert build_features(payments({})).columns == FEATURES.fieldNames()
    with pytest.raises(ValueError, match="txn_minute"):
        build_features(payments({}), ["txn_minute"])


def test_types_follow_the_schema(payments):
    built = build_features(payments({}))
    assert [f.dataType for f in built.schema] == [f.dataType for f in FEATURES]


def test_first_seen_tie_goes_to_the_lower_id(payments):
    df = payments({"txn_id": "B"}, {"txn_id": "A"})
    for rule in (HeavyRule(), HeavyRule(floor=0)):
        found = add_first_seen(df, "sender_vpa", "receiver_vpa", "timestamp", "txn_id", "first", rule)
        assert column(found, "first") == [1, 0]


def test_wall_clock_micros_ignore_the_session_zone(spark, payments):
    times = ["2024-03-10 01:30:00", "2024-03-10 02:30:00.000001", "2024-03-10 03:30:00", "1969-12-31 23:59:59.999999"]
    df = payments(*[{"timestamp": at(t)} for t in times])
    utc = column(df.withColumn("us", micros(F.col("timestamp"))), "us")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert column(df.withColumn("us", micros(F.col("timestamp"))), "us") == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert utc == [(at(t) - datetime(1970, 1, 1)) // timedelta(microseconds=1) for t in times]


def test_busy_instants_spread_and_stay_whole(payments):
    """Most rows at one instant of one sender: they join in several parts."""
    rows = [{"amount": i + 1} for i in range(60)] + [{"timestamp": at("2024-01-01 00:30:00")}] * 3
    df = payments(*rows).withColumn("_at", micros(F.col("timestamp")))
    rule = HeavyRule(floor=10)
    busy = busy_instants(df, "sender_vpa", "_at", rule)
    assert [r["_copies"] for r in busy.collect()] == [6]
    found = build_features(df.drop("_at"), ["sender_txn_velocity_1h", "usual_device_mismatch"], rule)
    assert column(found, "sender_txn_velocity_1h") == [0] * 60 + [60] * 3
    assert column(found, "usual_device_mismatch") == [0] * 63


def test_lists_of_heavy_keys_are_bounded(payments):
    df = payments(*[{"sender_vpa": s} for s in "aaabbbccd"])
    assert column(heavy_keys(df, "sender_vpa", HeavyRule(floor=1, most=2)), "_heavy", "_heavy") == ["a", "b"]
    # A key beyond the bound takes the window form: nothing is lost.
    rule = HeavyRule(floor=0, most=1)
    assert build_features(df, rule=rule).count() == 9


def test_usual_features_of_small_senders_stay_spread(spark, payments):
    """A task sorts its rows once per order, so AQE must not merge them into one task a core."""
    from pyspark.sql import functions as F

    rows = payments(*[{"sender_vpa": f"s{i % 50}", "device_id": f"D{i % 3}"} for i in range(300)])
    built = build_features(rows, ["is_new_receiver", "usual_device_mismatch", "usual_state_mismatch"])
    assert built.count() == 300
    tasks = built.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 2 * spark.sparkContext.defaultParallelism
