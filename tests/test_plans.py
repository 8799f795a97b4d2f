"""What the plans must look like to hold at any size."""

import re

import pytest
from conftest import BOTH_FORMS

from paywatch.contract import queries
from paywatch.plans import evaluation, exploration, kpis, operations
from paywatch.plans.features import build_features
from paywatch.sources import write_lookup_table

FOLDER = "/root/testdata/sf0.001"


def executed(df):
    """The plan as AQE left it after running."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0].split("+- == Final Plan ==")[-1]


def test_features_take_one_shuffle_of_the_rows(spark):
    plan = executed(build_features(queries.raw(spark, FOLDER)))
    exchanges = re.findall(r"Exchange (\w+)\((\w+)", plan)
    assert exchanges == [("hashpartitioning", "sender_vpa")]
    assert len(re.findall(r"\bSort \[", plan)) == 2
    assert "Join" not in plan and "Union" not in plan


def test_features_without_history_take_no_shuffle(spark):
    plan = executed(build_features(queries.raw(spark, FOLDER), ["txn_hour", "amount_log"]))
    assert "Exchange" not in plan


@pytest.mark.parametrize("rule", BOTH_FORMS)
def test_no_window_runs_over_all_rows(spark, rule):
    plan = build_features(queries.raw(spark, FOLDER), rule=rule)._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[-1]
    for window in re.findall(r"Window \[.*", physical):
        assert "windowspecdefinition(_key" in window or "windowspecdefinition(sender_vpa" in window
    assert "CartesianProduct" not in physical
    assert "BroadcastNestedLoopJoin" not in physical


def test_split_form_never_gathers_a_sender(spark):
    """With every sender heavy, windows run per bucket or over bucket totals."""
    built = build_features(queries.raw(spark, FOLDER), rule=queries.HeavyRule(floor=0))
    plan = executed(built)
    for spec in re.findall(r"windowspecdefinition\(([^)]*)\)?", plan):
        # A receiver's part is a pair's salted share.
        assert "_bucket" in spec or "_part" in spec


@pytest.mark.parametrize(
    "query",
    [kpis.overall_kpis, kpis.fraud_by_bank, kpis.top_senders, kpis.tier_breakdown, evaluation.confusion],
)
def test_aggregates_combine_before_the_shuffle(spark, query):
    plan = query(queries.scored(spark, FOLDER))._jdf.queryExecution().toString()
    assert "partial_sum" in plan or "partial_count" in plan


def test_top_senders_does_not_sort_everything(spark):
    plan = kpis.top_senders(queries.scored(spark, FOLDER))._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject(limit=10" in plan


def test_no_python_in_the_plans(spark):
    for name in ("f18_build_features", "f18_build_features_split", "r1_scored", "k16_class_contrast"):
        plan = queries.all_queries()[name](spark, FOLDER)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan


def test_days_are_filled_in_one_scan(spark):
    plan = executed(kpis.daily_flagged(queries.scored(spark, FOLDER)))
    assert len(re.findall(r"FileScan parquet", plan)) == 1


def test_label_correlations_take_one_scan(spark):
    rows = queries.raw(spark, FOLDER)
    plan = executed(exploration.label_correlation(rows, ["amount", "device_mismatch", "geo_anomaly"]))
    assert len(re.findall(r"FileScan parquet", plan)) == 1


def scanned(df):
    """Rows that came out of the scan, after files and row groups were skipped."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_lookups_skip_folders_and_row_groups(spark, tmp_path):
    path = str(tmp_path / "lookup")
    rows = spark.range(60_000).selectExpr(
        "concat('T', id) AS txn_id",
        "timestamp_ntz'2024-01-01' + make_dt_interval(id % 3) AS timestamp",
        "concat('user', (id * 7919) % 30000) AS sender_vpa",
        "CASE WHEN id % 50 < 2 THEN 'HIGH' WHEN id % 50 < 10 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier",
        "CAST(id % 50 < 4 AS int) AS fraud_flag",
    )
    write_lookup_table(rows, path, senders=30_000, row_group_bytes=1 << 15)
    table = spark.read.parquet(path)
    assert table.count() == 60_000
    chosen = {
        "tier": operations.of_tier(table, "HIGH"),
        "flag": operations.flagged(table),
        "sender": operations.of_sender(table, "user12345"),
        "nobody": operations.of_sender(table, "user1234x"),
    }
    right = {k: v.count() for k, v in chosen.items()}
    assert right == {"tier": 2400, "flag": 4800, "sender": 2, "nobody": 0}
    read = {k: scanned(v) for k, v in chosen.items()}
    assert read["tier"] == 2400 and read["flag"] < 12_000 and read["sender"] < 6_000 and read["nobody"] < 3_000


def test_lookup_table_keeps_rows_without_tier_or_sender(spark, tmp_path):
    shape = "txn_id string, timestamp timestamp_ntz, sender_vpa string, risk_tier string, fraud_flag int"
    rows = spark.createDataFrame([("a", None, None, None, None)], shape)
    write_lookup_table(rows, str(tmp_path / "odd"))
    assert spark.read.parquet(str(tmp_path / "odd")).select("txn_id").head()[0] == "a"
    with pytest.raises(ValueError, match="risk_tier"):
        write_lookup_table(rows.drop("risk_tier"), str(tmp_path / "lacking"))
