"""Transactions derived from other tables, as deterministic projections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from paywatch.schema import RAW

EVENT_COLUMNS = {
    "txn_id": "'TXN' || lpad(cast(event_id AS string), 8, '0')",
    "timestamp": "ts",
    "sender_vpa": "if(fraud AND event_id % 5 < 3, 'new' || event_id || '@ybl', 'user' || user_id || '@upi')",
    "receiver_vpa": "'user' || k || '@paytm'",
    "amount": "if(fraud AND event_id % 10 < 3, cast(50000 + k * 1500 AS decimal(15,2)), "
    "cast(cast(value AS decimal(15,2)) * 50 AS decimal(15,2)))",
    "bank": "'BANK_' || k % 10",
    "device_id": "if(device_off, 'DEV-X' || event_id, 'DEV-' || user_id)",
    "app_name": "'APP_' || user_id % 6",
    "merchant_name": "if(k % 15 = 0, 'P2P', 'M_' || k % 15)",
    "sender_state": "'STATE_' || if(state_off, (user_id + 1) % 10, user_id % 10)",
    "txn_status": "if(event_type = 'error', 'FAILED', 'SUCCESS')",
    "failure_reason": "if(event_type = 'error', 'REASON_' || k % 5, NULL)",
    "device_mismatch": "device_off",
    "geo_anomaly": "state_off",
    "is_fraud": "fraud",
}

ORDER_COLUMNS = {
    "txn_id": "'TXN' || lpad(cast(o_orderkey AS string), 8, '0')",
    "timestamp": "o_orderdate",
    "sender_vpa": "'user' || o_custkey || '@upi'",
    "receiver_vpa": "'shop' || o_orderkey % 7",
    "amount": "o_totalprice",
    "bank": "'BANK_' || o_custkey % 10",
    "device_id": "'DEV-' || o_orderkey % 3",
    "app_name": "'APP_' || o_custkey % 6",
    "merchant_name": "'P2P'",
    "sender_state": "'STATE_' || o_orderkey % 4",
    "txn_status": "if(o_orderstatus = 'F', 'FAILED', 'SUCCESS')",
    "failure_reason": "NULL",
    "device_mismatch": "0",
    "geo_anomaly": "0",
    "is_fraud": "0",
}


def _shaped(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.selectExpr(
        *[f"cast({columns[f.name]} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in RAW]
    )


def transactions_from_events(events: DataFrame) -> DataFrame:
    """The event stream as payments: 35 in 1000 are fraud, by event number."""
    marked = events.selectExpr(
        "*",
        "cast(regexp_extract(props, '[0-9]+', 0) AS int) AS k",
        "(event_id * 7919) % 1000 < 35 AS fraud",
    ).selectExpr(
        "*",
        "fraud AND event_id % 20 < 11 AS device_off",
        "fraud AND event_id % 5 < 2 AS state_off",
    )
    return _shaped(marked, EVENT_COLUMNS)


def transactions_from_orders(orders: DataFrame) -> DataFrame:
    """Orders as payments: times are midnights only, so many share an instant."""
    return _shaped(orders, ORDER_COLUMNS)
