import sys
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from paywatch.operators import HeavyRule  # noqa: E402
from paywatch.schema import RAW  # noqa: E402
from paywatch.session import local_session  # noqa: E402

DEFAULTS = {
    "txn_id": None,
    "timestamp": datetime(2024, 1, 1),
    "sender_vpa": "a",
    "receiver_vpa": "x",
    "amount": Decimal("100.00"),
    "bank": "B",
    "device_id": "D",
    "app_name": "P",
    "merchant_name": "M",
    "sender_state": "S",
    "txn_status": "SUCCESS",
    "failure_reason": None,
    "device_mismatch": 0,
    "geo_anomaly": 0,
    "is_fraud": 0,
}


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", "6g")
    yield session
    session.stop()


@pytest.fixture
def payments(spark):
    """Payments from partial rows; ids count up in the order given."""

    def build(*rows, **shared):
        full = []
        for i, row in enumerate(rows):
            merged = DEFAULTS | {"txn_id": f"T{i:04d}"} | shared | row
            merged["amount"] = None if merged["amount"] is None else Decimal(str(merged["amount"]))
            full.append(tuple(merged[name] for name in RAW.fieldNames()))
        return spark.createDataFrame(full, RAW)

    return build


# Ordinary keys only, and every key as a heavy one.
BOTH_FORMS = [pytest.param(HeavyRule(), id="window"), pytest.param(HeavyRule(floor=0), id="split")]


def column(df, name, order="txn_id"):
    return [row[name] for row in df.orderBy(order).select(name).collect()]


def at(text):
    return datetime.fromisoformat(text)
