from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import at, column
from pyspark.sql import functions as F

from paywatch.functions import risk_tier, round_half_up
from paywatch.operators import histogram
from paywatch.plans import exploration, kpis, operations
from paywatch.plans.features import build_features
from paywatch.plans.scoring import require_columns, rule_score, scoring_summary, with_risk
from paywatch.schema import FEATURE_COLUMNS


@pytest.fixture
def scored(payments):
    """Payments with the probabilities given."""

    def build(*rows):
        chances = [row.pop("p", 0.0) for row in rows]
        features = build_features(payments(*rows)).orderBy("txn_id")
        named = [(f"T{i:04d}", p) for i, p in enumerate(chances)]
        given = features.sparkSession.createDataFrame(named, "txn_id string, p double")
        return with_risk(features.join(given, "txn_id"), F.col("p")).drop("p")

    return build


def test_tier_and_flag_limits(spark):
    values = [0.70, 0.6999, 0.50, 0.4999, 0.40, 0.3999, None, float("nan")]
    df = with_risk(spark.createDataFrame(list(enumerate(values)), "i int, p double"), F.col("p"))
    assert column(df, "risk_tier", "i") == ["HIGH", "MEDIUM", "MEDIUM", "MEDIUM", "MEDIUM", "LOW", "LOW", "LOW"]
    assert column(df, "fraud_flag", "i") == [1, 1, 1, 0, 0, 0, 0, 0]
    bare = spark.range(1).select(risk_tier(F.lit(None)).alias("t"))
    assert bare.head().t == "LOW"


def test_missing_feature_is_named(payments):
    df = build_features(payments({})).drop("amount_log")
    with pytest.raises(ValueError, match="amount_log"):
        require_columns(df)


def test_threshold_is_a_parameter(spark):
    df = spark.createDataFrame([(0.3,)], "p double")
    assert with_risk(df, F.col("p"), threshold=0.3).head().fraud_flag == 1


def test_groups_without_flags(scored):
    df = scored({"p": 0.1})
    assert kpis.daily_trend(df).head().fraud_amount == 0
    totals = df.agg(kpis.flagged_amount(None).alias("a"), kpis.flagged_amount(0).alias("b")).head()
    assert (totals.a, totals.b) == (None, 0)
    assert kpis.top_senders(df).count() == 0
    assert kpis.overall_kpis(df).head().avg_fraud_ticket_size is None


def test_overall_kpis_of_nothing(scored):
    row = kpis.overall_kpis(scored({}).where("false")).head()
    assert row.total_transactions == 0
    assert row.fraud_rate_pct is None


def test_quiet_days_are_filled(scored):
    df = scored({"p": 0.9}, {"p": 0.9, "timestamp": datetime(2024, 1, 3)})
    assert [tuple(r) for r in kpis.daily_flagged(df).collect()] == [
        (date(2024, 1, 1), 1),
        (date(2024, 1, 2), 0),
        (date(2024, 1, 3), 1),
    ]


def test_absent_tiers_are_listed(scored):
    rows = kpis.tier_counts(scored({"p": 0.0}, {"p": 0.1})).collect()
    assert [tuple(r) for r in rows] == [("HIGH", None), ("MEDIUM", None), ("LOW", 2)]


def test_tiers_add_up(scored):
    row = scoring_summary(scored({"p": 0.9}, {"p": 0.5}, {"p": 0.2}, {"p": 0.2})).head()
    assert row.high_risk + row.medium_risk + row.low_risk == row.records_scored == 4
    assert (row.flagged, row.flagged_pct) == (2, 50.0)


def test_top_senders_break_ties_by_name(scored):
    df = scored(*[{"p": 0.9, "sender_vpa": s} for s in "cab"], {"p": 0.9, "sender_vpa": "b"})
    assert column(kpis.top_senders(df, 2), "sender_vpa", F.desc("fraud_txns")) == ["b", "a"]


def test_queue_takes_one_day(scored):
    df = scored(
        {"p": 0.9, "timestamp": at("2024-01-02 00:00:00")},
        {"p": 0.8, "timestamp": at("2024-01-02 23:59:59.999999")},
        {"p": 0.9, "timestamp": at("2024-01-03 00:00:00")},
        {"p": 0.5, "timestamp": at("2024-01-02 10:00:00")},
    )
    queue = operations.high_risk_queue(df, date(2024, 1, 2))
    assert [r.txn_id for r in queue.collect()] == ["T0000", "T0001"]
    assert operations.high_risk_queue(df).count() == 0


def test_velocity_abuse_default_threshold(scored):
    minutes = [{"timestamp": datetime(2024, 1, 1, 0, i)} for i in range(12)]
    row = operations.velocity_abuse(scored(*minutes)).collect()
    assert [(r.sender_vpa, r.max_1h_velocity, r.total_txns) for r in row] == [("a", 11, 1)]
    assert operations.velocity_abuse(scored(*minutes[:11])).count() == 0


def test_compound_risk_limits(scored):
    base = {"device_mismatch": 1, "amount": "50000.01"}
    df = scored(
        base | {"sender_vpa": "a"},
        base | {"sender_vpa": "b", "amount": "50000.00"},
        base | {"sender_vpa": "c", "device_mismatch": 0},
        base | {"sender_vpa": "a", "timestamp": datetime(2024, 1, 2)},
    )
    assert column(operations.compound_risk(df), "txn_id") == ["T0000"]


def test_rolling_rate_spans_gaps(scored):
    days = [1, 2, 8, 9]
    df = scored(*[{"p": 0.9, "timestamp": datetime(2024, 1, d)} for d in days])
    assert column(kpis.rolling_rate(df), "txns_7d", "txn_date") == [1, 2, 2, 2]


def test_weeks_start_on_monday(scored):
    df = scored({"timestamp": at("2024-01-07 23:59:59")}, {"timestamp": at("2024-01-08 00:00:00")})
    starts = column(kpis.weekly_rate(df), "week_start", "week_start")
    assert starts == [datetime(2024, 1, 1), datetime(2024, 1, 8)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 9.99, 10, 10)], "v double")
    rows = histogram(df, F.col("v"), 10).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [1, 1, 0, 0, 0, 0, 0, 0, 0, 3]
    assert rows[-1].lower_edge == 9


def test_histogram_of_one_value_and_of_an_absent_class(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    classes = {"here": F.col("v") == 5, "absent": F.col("v") == 6}
    rows = histogram(df, F.col("v"), 4, classes).where("count > 0").collect()
    assert [(r["class"], r.bin, r["count"]) for r in rows] == [("here", 2, 2)]


def test_constant_feature_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0), (1.0, 4.0, 1), (1.0, None, 0)], "c double, v double, is_fraud int")
    found = {r.feature: r.correlation for r in exploration.label_correlation(df, ["c", "v"]).collect()}
    assert found["c"] is None
    assert found["v"] == pytest.approx(1)


def test_correlation_matrix_marks_constants(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (1.0, 4.0, 5.0), (1.0, 5.0, 2.0)], "c double, v double, w double")
    found = {
        (r.feature_a, r.feature_b): r.correlation
        for r in exploration.correlation_matrix(df, ["c", "v", "w"]).collect()
    }
    assert found["c", "v"] is None
    assert found["c", "c"] is None
    assert found["v", "v"] == 1
    assert found["v", "w"] == found["w", "v"]


def test_rate_matrix_has_all_weekdays(payments):
    df = build_features(payments({"is_fraud": 1}), ["txn_hour", "txn_day_of_week"])
    row = exploration.rate_matrix(df).head()
    assert row.Mon == 1 and row.Sun is None


def test_half_up(spark):
    df = spark.createDataFrame([(0.5,), (1.25,), (2.345,)], "v double")
    assert [r[0] for r in df.select(round_half_up(F.col("v"), 1)).collect()] == [0.5, 1.3, 2.3]


def test_rule_score_adds_its_points(payments):
    row = rule_score(
        build_features(
            payments({"device_mismatch": 1, "geo_anomaly": 1, "amount": 60000, "timestamp": at("2024-01-01 23:30:00")})
        )
    ).head()
    assert row.fraud_probability == 1.0
    assert row.risk_tier == "HIGH"
    assert row.amount == Decimal("60000.00")
    assert len(FEATURE_COLUMNS) == 15
