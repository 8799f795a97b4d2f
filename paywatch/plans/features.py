"""The behavioural features of a transaction.

Definitions worth knowing:
  night      23:00 to 05:59
  z-score    over the sender's whole history, later payments included
  trailing   [t - width, t): a payment at the very same instant does not count
  average    the payment's own amount where the last 30 days are empty
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paywatch.functions import NIGHT_END_HOUR, NIGHT_START_HOUR, micros
from paywatch.operators.deviation import (
    add_zscore,
    attach_zscore,
    zscore_lookup,
    zscore_windowed,
)
from paywatch.operators.first_seen import (
    add_first_seen,
    first_seen_split,
    first_seen_windowed,
)
from paywatch.operators.heavy import HeavyRule, busy_instants, heavy_keys, split_heavy
from paywatch.operators.trailing import (
    Trailing,
    add_trailing,
    attach_trailing,
    trailing_lookup,
    trailing_windowed,
)
from paywatch.operators.usual import attach_usual, usual_lookup, usual_of_uses, with_uses
from paywatch.schema import DERIVED, RAW

SENDER, RECEIVER, AMOUNT, TIME, ROW_ID = (
    "sender_vpa",
    "receiver_vpa",
    "amount",
    "timestamp",
    "txn_id",
)

# The three trailing widths.
VELOCITY_1H = Trailing(timedelta(hours=1), "sender_txn_velocity_1h")
VELOCITY_24H = Trailing(timedelta(hours=24), "sender_txn_velocity_24h")
HISTORY_30D = Trailing(timedelta(days=30), "sender_txn_count_30d", "_total_30d")

# Fixed value: amounts divisible by this are "round".
ROUND_STEP = 500

# Which trailing window each feature comes from.
_TRAILING = {
    "sender_txn_velocity_1h": VELOCITY_1H,
    "sender_txn_velocity_24h": VELOCITY_24H,
    "sender_txn_count_30d": HISTORY_30D,
    "sender_avg_amount_30d": HISTORY_30D,
}

# Derived anomaly flags and the column each one follows.
USUAL = {"usual_device_mismatch": "device_id", "usual_state_mismatch": "sender_state"}


def add_calendar(df: DataFrame) -> DataFrame:
    """Hour, weekday (Monday = 0), night and weekend marks."""
    hour, weekday = F.hour(TIME), F.weekday(TIME)
    night = (hour >= NIGHT_START_HOUR) | (hour <= NIGHT_END_HOUR)
    return df.withColumns(
        {
            "txn_hour": hour,
            "txn_day_of_week": weekday,
            "is_night_txn": F.when(night, 1).otherwise(0),
            "is_weekend": F.when(weekday >= 5, 1).otherwise(0),
        }
    )


def add_amount_shape(df: DataFrame) -> DataFrame:
    """log(1 + amount) and the round-number mark, the latter in exact decimals."""
    amount = F.col(AMOUNT)
    return df.withColumns(
        {
            "amount_log": F.log1p(amount.cast("double")),
            "amount_round_number": F.when(amount % ROUND_STEP == 0, 1).otherwise(0),
        }
    )


def add_status(df: DataFrame) -> DataFrame:
    """1 for SUCCESS, 0 for every other status."""
    return df.withColumn(
        "txn_status_encoded", F.when(F.col("txn_status") == "SUCCESS", 1).otherwise(0)
    )


def add_amount_zscore(df: DataFrame, rule: HeavyRule = HeavyRule()) -> DataFrame:
    return add_zscore(df, SENDER, AMOUNT, "amount_zscore", rule)


def _with_average(df: DataFrame) -> DataFrame:
    """Mean amount of the last 30 days from the exact sum, else the own amount."""
    mean = F.try_divide(F.col("_total_30d").cast("double"), F.col("sender_txn_count_30d"))
    own = F.col(AMOUNT).cast("double")
    return df.withColumn("sender_avg_amount_30d", F.coalesce(mean, own)).drop("_total_30d")


def add_velocity(df: DataFrame, rule: HeavyRule = HeavyRule()) -> DataFrame:
    """The sender's payment counts in the hour, day and 30 days before, and their mean."""
    timed = df.withColumn("_at", micros(F.col(TIME)))
    specs = [VELOCITY_1H, VELOCITY_24H, HISTORY_30D]
    counted = add_trailing(timed, SENDER, "_at", AMOUNT, specs, rule)
    return _with_average(counted).drop("_at")


def add_new_receiver(df: DataFrame, rule: HeavyRule = HeavyRule()) -> DataFrame:
    """1 on the sender's first payment to a receiver."""
    return add_first_seen(df, SENDER, RECEIVER, TIME, ROW_ID, "is_new_receiver", rule)


# The steps that need only the row itself, and what each one adds.
_STATELESS = (
    (add_calendar, {"txn_hour", "txn_day_of_week", "is_night_txn", "is_weekend"}),
    (add_amount_shape, {"amount_log", "amount_round_number"}),
    (add_status, {"txn_status_encoded"}),
)


def _parts(spark: SparkSession) -> int:
    """Parts of a shuffle that AQE leaves as they are."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def build_features(
    df: DataFrame,
    only: Iterable[str] | None = None,
    rule: HeavyRule = HeavyRule(),
) -> DataFrame:
    """RAW -> FEATURES. `only` names the derived columns wanted; default all of FEATURES.

    `only` may also name `usual_device_mismatch` and `usual_state_mismatch`, the
    two anomaly flags derived from the sender's past instead of read.

    Ordinary senders take the window forms: one shuffle on the sender carries
    the pair, time and whole-history windows. Heavy senders take the split
    forms, each computed from the rows as they come and then joined to them.
    A plan that needs no sender history has no shuffle at all.
    """
    derived = DERIVED.fieldNames() + list(USUAL)
    chosen = set(DERIVED.fieldNames() if only is None else only)
    unknown = sorted(chosen - set(derived))
    if unknown:
        raise ValueError(f"Unknown features: {unknown}")
    wanted = [name for name in derived if name in chosen]
    base = df.select(*[name for name in df.columns if name not in derived])
    rows = base
    for step, columns in _STATELESS:
        if chosen & columns:
            rows = step(rows)

    specs = list(dict.fromkeys(_TRAILING[name] for name in wanted if name in _TRAILING))
    usual = {name: column for name, column in USUAL.items() if name in wanted}
    pair, spread = "is_new_receiver" in wanted, "amount_zscore" in wanted
    if specs or pair or spread or usual:
        rows = rows.withColumn("_at", micros(F.col(TIME)))
        ordinary, heavy = split_heavy(rows, SENDER, heavy_keys(df, SENDER, rule))
        heavy_rows = heavy
        if specs or usual:
            busy = busy_instants(heavy_rows, SENDER, "_at", rule)
        # Windows on the sender alone come first: their shuffle then also serves
        # the windows on the sender and a second column.
        if usual:
            # One task holds its rows in a sort per order, so its share of them must not
            # grow to what AQE would merge for rows that are sorted once.
            ordinary = ordinary.repartition(_parts(df.sparkSession), SENDER)
        for name, column in usual.items():
            ordinary = with_uses(ordinary, SENDER, column, "_at", f"_uses_{name}")
        if specs:
            ordinary = trailing_windowed(ordinary, SENDER, "_at", AMOUNT, specs)
            lookup = trailing_lookup(heavy_rows, SENDER, "_at", AMOUNT, specs, rule=rule)
            heavy = attach_trailing(heavy, lookup, busy, SENDER, "_at", specs)
        if spread:
            ordinary = zscore_windowed(ordinary, SENDER, AMOUNT, "amount_zscore")
            # One row per heavy sender: the bound of the rule makes this small.
            lookup = F.broadcast(zscore_lookup(heavy_rows, SENDER, AMOUNT))
            heavy = attach_zscore(heavy, lookup, SENDER, AMOUNT, "amount_zscore")
        for name, column in usual.items():
            ordinary = usual_of_uses(ordinary, SENDER, column, "_at", f"_uses_{name}", name)
            lookup = usual_lookup(heavy_rows, SENDER, column, "_at")
            heavy = attach_usual(heavy, lookup, busy, SENDER, column, "_at", name)
        if pair:
            ordinary = first_seen_windowed(
                ordinary, SENDER, RECEIVER, "_at", ROW_ID, "is_new_receiver"
            )
            heavy = first_seen_split(heavy, SENDER, RECEIVER, "_at", ROW_ID, "is_new_receiver")
        rows = ordinary.unionByName(heavy)
        if HISTORY_30D in specs:
            rows = _with_average(rows)

    kept = [name for name in RAW.fieldNames() if name in base.columns]
    extra = [name for name in base.columns if name not in kept]
    return rows.select(*kept, *extra, *wanted)
