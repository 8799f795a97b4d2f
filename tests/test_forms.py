"""The window and split forms of an operator are one function; ties, streams and shares at their edges."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from paywatch.functions import rate_pct
from paywatch.operators import HeavyRule, add_first_seen, add_usual_mismatch
from paywatch.operators.histogram import histogram
from paywatch.plans import kpis, training
from paywatch.sources import read_raw, write_table
from paywatch.streaming import daily_trend_stream

WINDOW, SPLIT = HeavyRule(), HeavyRule(floor=0)


@pytest.fixture
def untidy(payments):
    """Repeated and null ids, null times, null senders, many rows at one instant."""
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(300):
        rows.append(
            {
                "txn_id": None if i % 7 == 0 else f"T{i // 2}",
                "timestamp": None if i % 11 == 0 else start + timedelta(minutes=(i * 37) % 50),
                "sender_vpa": [None, "a", "b"][i % 3],
                "receiver_vpa": f"r{i % 13}",
                "device_id": None if i % 17 == 0 else f"d{i * i % 5}",
            }
        )
    return payments(*rows)


def test_first_seen_forms_agree(untidy):
    def firsts(rule):
        found = add_first_seen(untidy, "sender_vpa", "receiver_vpa", "timestamp", "txn_id", "first", rule)
        assert found.count() == 300
        pairs = found.where("first = 1").select("sender_vpa", "receiver_vpa", "timestamp", "txn_id").collect()
        assert len({r[:2] for r in pairs}) == len(pairs)
        return sorted(map(repr, pairs))

    assert firsts(WINDOW) == firsts(SPLIT)
    assert len(firsts(SPLIT)) == 39


def test_usual_forms_agree(untidy):
    timed = untidy.withColumn("t", F.unix_micros(F.col("timestamp").cast("timestamp")))

    def marks(rule):
        found = add_usual_mismatch(timed, "sender_vpa", "device_id", "t", "odd", rule)
        assert found.where("t IS NULL AND odd = 1").count() == 0
        return sorted(map(repr, found.select("sender_vpa", "receiver_vpa", "t", "txn_id", "device_id", "odd").collect()))

    assert marks(WINDOW) == marks(SPLIT)


def test_percentages_at_ties(spark):
    rows = [(201, 20_000, 1.01), (203, 20_000, 1.02), (1, 3, 33.33), (0, 5, 0.0), (1, 0, None)]
    df = spark.createDataFrame(rows, "part long, whole long, expected double")
    for r in df.select("expected", rate_pct(F.col("part"), F.col("whole"), 2).alias("found")).collect():
        assert r.found == r.expected


def test_mean_amount_at_ties(payments):
    df = payments({"amount": "1.00"}, {"amount": "1.01"})
    assert df.select(kpis.mean_amount().alias("m")).head().m == 1.01


def test_nan_is_in_no_bin(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,), (None,)], "x double")
    assert [r["count"] for r in histogram(df, F.col("x"), 2).orderBy("bin").collect()] == [1, 1]


def test_shares_of_the_split(spark):
    ids = spark.range(20_000).select(F.col("id").cast("string").alias("txn_id"))
    for share, low, high in [(0.0, 0, 0), (0.001, 5, 45), (0.5, 9_700, 10_300), (1.0, 20_000, 20_000)]:
        assert low <= training.with_split(ids, share).where("is_test = 1").count() <= high
    with pytest.raises(ValueError):
        training.with_split(ids, 1.5)


def test_files_with_other_headers_and_bad_values(spark, payments, tmp_path):
    one = payments({})
    write_table(one, str(tmp_path / "a"), "csv")
    names = one.columns
    names[2], names[3] = names[3], names[2]
    write_table(one.select(*names), str(tmp_path / "b"), "csv")
    with pytest.raises(Exception):
        read_raw(spark, str(tmp_path / "{a,b}")).collect()
    write_table(one.withColumn("amount", F.lit("12.5x")), str(tmp_path / "c"), "csv")
    with pytest.raises(Exception):
        read_raw(spark, str(tmp_path / "c")).collect()
    assert read_raw(spark, str(tmp_path / "a")).count() == 1


@pytest.mark.parametrize("zone", ["Asia/Kolkata", "America/New_York"])
def test_stream_days_in_every_zone(spark, payments, zone):
    start = datetime(2024, 3, 9, 22)
    scored = payments(*[{"timestamp": start + timedelta(hours=i)} for i in range(60)])
    scored = scored.withColumn("fraud_flag", F.lit(1)).withColumn("fraud_probability", F.lit(0.9))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ours = sorted(map(tuple, daily_trend_stream(scored).collect()))
        assert ours == sorted(map(tuple, kpis.daily_trend(scored).collect()))
        assert ours[0][0] == date(2024, 3, 9)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
