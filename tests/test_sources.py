import re
from datetime import date, datetime

import pytest
from conftest import column
from pyspark.sql import functions as F

from paywatch.plans import kpis, operations
from paywatch.plans.features import build_features
from paywatch.plans.scoring import rule_score
from paywatch.schema import FEATURES, IMPORTANCES, RAW, SCORED
from paywatch.sources import (
    read_features,
    read_importances,
    read_raw,
    read_scored,
    read_table,
    register_transactions,
    write_table,
)

HEADER = "timestamp,txn_id,sender_vpa,receiver_vpa,amount,bank,device_id,app_name,merchant_name,sender_state,txn_status,failure_reason,device_mismatch,geo_anomaly,is_fraud"


def test_csv_is_bound_by_name(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(
        f"{HEADER}\n"
        "2023-05-06 07:08:09,T1,a,x,12.50,B,D,P,M,S,SUCCESS,,0,0,0\n"
        '2023-05-06 07:08:10.25,T2,a,x,7,B,D,P,M,S,FAILED,"",0,1,1\n'
    )
    df = read_raw(spark, str(tmp_path / "raw.csv"))
    assert df.schema == RAW
    assert column(df, "timestamp") == [
        datetime(2023, 5, 6, 7, 8, 9),
        datetime(2023, 5, 6, 7, 8, 10, 250000),
    ]
    assert column(df, "failure_reason") == [None, None]
    assert column(df, "geo_anomaly") == [0, 1]


def test_csv_with_more_and_with_fewer_columns(spark, tmp_path):
    (tmp_path / "wide.csv").write_text("other,feature,importance_gain\nz,a,0.5\n")
    assert read_importances(spark, str(tmp_path / "wide.csv")).collect() == [("a", 0.5)]
    (tmp_path / "narrow.csv").write_text("feature\na\n")
    with pytest.raises(ValueError, match="importance_gain"):
        read_table(spark, str(tmp_path / "narrow.csv"), IMPORTANCES, "csv")


def test_features_csv_round_trip(spark, payments, tmp_path):
    features = build_features(payments({"amount": "10.10"}, {"sender_vpa": "b"}))
    path = str(tmp_path / "features")
    write_table(features, path, "csv")
    again = read_features(spark, path, "csv")
    assert again.schema == FEATURES
    assert again.orderBy("txn_id").collect() == features.orderBy("txn_id").collect()


def test_overwrite_replaces(spark, payments, tmp_path):
    path = str(tmp_path / "t")
    write_table(payments({}, {}), path)
    write_table(payments({}), path)
    assert read_table(spark, path, RAW).count() == 1


@pytest.fixture
def by_day(spark, payments, tmp_path):
    rows = [{"timestamp": datetime(2024, 1, d, 12), "sender_vpa": f"s{d % 3}"} for d in range(1, 10)]
    path = str(tmp_path / "scored")
    write_table(rule_score(build_features(payments(*rows))), path, by_day=True)
    return path


def test_layout_by_day_prunes_folders_and_pushes_filters(spark, by_day):
    table = spark.read.parquet(by_day)
    day = operations.of_days(table, date(2024, 1, 4))
    plan = day._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*txn_date", plan)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(timestamp", plan)
    sender = table.where(F.col("sender_vpa") == "s1")._jdf.queryExecution().toString()
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(sender_vpa,s1\)", sender)
    assert day.count() == 1
    assert read_scored(spark, by_day).schema == SCORED


def test_only_needed_columns_are_read(spark, by_day):
    plan = kpis.fraud_by_bank(read_scored(spark, by_day))._jdf.queryExecution().toString()
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)[-1]
    assert {part.split(":")[0] for part in read.split(",") if ":" in part} == {"amount", "bank", "fraud_flag"}


def test_sql_view(spark, by_day):
    register_transactions(read_scored(spark, by_day), "payments_view")
    rows = spark.sql("SELECT count(*) AS n FROM payments_view WHERE `timestamp` < '2024-01-03'")
    assert rows.head().n == 2
