"""The same results as plain SQL for DuckDB, for comparison."""

from __future__ import annotations

from paywatch.plans.evaluation import SWEEP_GRID
from paywatch.plans.exploration import WEEKDAYS
from paywatch.schema import DERIVED, FEATURE_COLUMNS, FEATURES, LABEL, RAW


def rounded(value: str, digits: int) -> str:
    scale = float(10**digits)
    return f"(floor(CAST({value} AS DOUBLE) * {scale} + 0.5) / {scale})"


def exact(units: str, whole: str, digits: int) -> str:
    """units / whole in whole numbers, up where the remainder is half or more."""
    return (
        f"(CAST(({units}) // nullif({whole}, 0) + CASE WHEN 2 * (({units}) % nullif({whole}, 0)) >= {whole} "
        f"THEN 1 ELSE 0 END AS DOUBLE) / {float(10**digits)}::DOUBLE)"
    )


def pct(part: str, whole: str, digits: int) -> str:
    return exact(f"CAST({part} AS HUGEINT) * {100 * 10**digits}", f"CAST({whole} AS HUGEINT)", digits)


def mean_money(case: str) -> str:
    return exact(f"CAST(sum({case}) * 100 AS HUGEINT)", f"CAST(count({case}) AS HUGEINT)", 2)


ROWS_EVENTS = """
numbered AS (
  SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
         (event_id * 7919) % 1000 < 35 AS f
  FROM events
),
raw AS (
  SELECT
    'TXN' || lpad(CAST(event_id AS VARCHAR), 8, '0') AS txn_id,
    ts AS "timestamp",
    CASE WHEN f AND event_id % 5 < 3 THEN 'new' || event_id || '@ybl'
         ELSE 'user' || user_id || '@upi' END AS sender_vpa,
    'user' || k || '@paytm' AS receiver_vpa,
    CAST(CASE WHEN f AND event_id % 10 < 3 THEN CAST(50000 + k * 1500 AS DECIMAL(15,2))
         ELSE CAST(CAST(value AS DECIMAL(15,2)) * 50 AS DECIMAL(15,2)) END AS DECIMAL(15,2)) AS amount,
    'BANK_' || (k % 10) AS bank,
    CASE WHEN f AND event_id % 20 < 11 THEN 'DEV-X' || event_id
         ELSE 'DEV-' || user_id END AS device_id,
    'APP_' || (user_id % 6) AS app_name,
    CASE WHEN k % 15 = 0 THEN 'P2P' ELSE 'M_' || (k % 15) END AS merchant_name,
    'STATE_' || (CASE WHEN f AND event_id % 5 < 2 THEN (user_id + 1) % 10
                 ELSE user_id % 10 END) AS sender_state,
    CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS txn_status,
    CASE WHEN event_type = 'error' THEN 'REASON_' || (k % 5) END AS failure_reason,
    CAST(f AND event_id % 20 < 11 AS INTEGER) AS device_mismatch,
    CAST(f AND event_id % 5 < 2 AS INTEGER) AS geo_anomaly,
    CAST(f AS INTEGER) AS is_fraud
  FROM numbered
)"""

ROWS_ORDERS = """
raw AS (
  SELECT
    'TXN' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS txn_id,
    o_orderdate AS "timestamp",
    'user' || o_custkey || '@upi' AS sender_vpa,
    'shop' || (o_orderkey % 7) AS receiver_vpa,
    CAST(o_totalprice AS DECIMAL(15,2)) AS amount,
    'BANK_' || (o_custkey % 10) AS bank,
    'DEV-' || (o_orderkey % 3) AS device_id,
    'APP_' || (o_custkey % 6) AS app_name,
    'P2P' AS merchant_name,
    'STATE_' || (o_orderkey % 4) AS sender_state,
    CASE WHEN o_orderstatus = 'F' THEN 'FAILED' ELSE 'SUCCESS' END AS txn_status,
    CAST(NULL AS VARCHAR) AS failure_reason,
    0 AS device_mismatch, 0 AS geo_anomaly, 0 AS is_fraud
  FROM orders
)"""


def trailing(width: str) -> str:
    return (
        'OVER (PARTITION BY sender_vpa ORDER BY "timestamp" RANGE BETWEEN '
        f"INTERVAL {width} PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)"
    )


def usual(attribute: str, name: str) -> str:
    return f"""CAST(usual_{attribute} IS NOT NULL
      AND usual_{attribute}.attribute IS DISTINCT FROM {attribute} AS INTEGER) AS {name}"""


FEATURE_STEPS = f"""
spread AS (
  SELECT sender_vpa AS sender, CAST(sum(amount) AS DOUBLE) / count(amount) AS mean,
         CASE WHEN min(amount) < max(amount)
              THEN coalesce(nullif(stddev_samp(CAST(amount AS DOUBLE)), 0), 1) ELSE 1 END AS sd
  FROM raw GROUP BY sender_vpa
),
features AS (
  SELECT raw.*,
    CAST(hour("timestamp") AS INTEGER) AS txn_hour,
    CAST(isodow("timestamp") - 1 AS INTEGER) AS txn_day_of_week,
    CASE WHEN hour("timestamp") >= 23 OR hour("timestamp") <= 5 THEN 1 ELSE 0 END AS is_night_txn,
    CASE WHEN isodow("timestamp") >= 6 THEN 1 ELSE 0 END AS is_weekend,
    ln(1 + CAST(amount AS DOUBLE)) AS amount_log,
    least(greatest((CAST(amount AS DOUBLE) - mean) / sd, -10.0::DOUBLE), 10.0::DOUBLE) AS amount_zscore,
    CAST(count(*) {trailing('1 HOUR')} AS BIGINT) AS sender_txn_velocity_1h,
    CAST(count(*) {trailing('24 HOUR')} AS BIGINT) AS sender_txn_velocity_24h,
    coalesce(CAST(sum(amount) {trailing('30 DAY')} AS DOUBLE)
             / nullif(count(*) {trailing('30 DAY')}, 0), CAST(amount AS DOUBLE)) AS sender_avg_amount_30d,
    CAST(count(*) {trailing('30 DAY')} AS BIGINT) AS sender_txn_count_30d,
    CASE WHEN row_number() OVER (PARTITION BY sender_vpa, receiver_vpa
                                 ORDER BY "timestamp", txn_id) = 1 THEN 1 ELSE 0 END AS is_new_receiver,
    CASE WHEN amount % 500 = 0 THEN 1 ELSE 0 END AS amount_round_number,
    CASE WHEN txn_status = 'SUCCESS' THEN 1 ELSE 0 END AS txn_status_encoded
  FROM raw JOIN spread ON sender_vpa = sender
),
points AS (
  SELECT *, 35 * device_mismatch + 25 * geo_anomaly + 10 * is_new_receiver
            + CASE WHEN amount > 50000 THEN 20 ELSE 0 END + 10 * is_night_txn AS p
  FROM features
),
scored AS (
  SELECT * EXCLUDE (p), CAST(p AS DOUBLE) / 100.0::DOUBLE AS fraud_probability,
         CASE WHEN p >= 50 THEN 1 ELSE 0 END AS fraud_flag,
         CASE WHEN p >= 70 THEN 'HIGH' WHEN p >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
  FROM points
)"""

USUAL_STEPS = """
uses AS (
  SELECT *,
    count(*) OVER (PARTITION BY sender_vpa, device_id ORDER BY "timestamp"
                   RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS device_uses,
    count(*) OVER (PARTITION BY sender_vpa, sender_state ORDER BY "timestamp"
                   RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS state_uses
  FROM features
),
usual AS (
  SELECT *,
    max({'uses': device_uses, 'at': "timestamp", 'attribute': device_id}) OVER before AS usual_device_id,
    max({'uses': state_uses, 'at': "timestamp", 'attribute': sender_state}) OVER before AS usual_sender_state
  FROM uses
  WINDOW before AS (PARTITION BY sender_vpa ORDER BY "timestamp"
                    RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)
)"""

ON_EVENTS = f"WITH {ROWS_EVENTS},{FEATURE_STEPS}"
ON_ORDERS = f"WITH {ROWS_ORDERS},{FEATURE_STEPS}"
USUAL_FLAGS = (
    usual("device_id", "usual_device_mismatch")
    + ", "
    + usual("sender_state", "usual_state_mismatch")
)

INEXACT = ("amount_log", "amount_zscore", "sender_avg_amount_30d")


def column(name: str) -> str:
    if name in INEXACT:
        return f"{rounded(name, 6)} AS {name}"
    return f'"{name}"'


def columns(*names: str) -> str:
    return ", ".join(column(name) for name in names)


def on_scored(select: str) -> str:
    return f"{ON_EVENTS} {select}"


RAW_LIST = columns(*RAW.fieldNames())
FEATURE_LIST = columns(*FEATURES.fieldNames())
SCORED_LIST = FEATURE_LIST + ", fraud_probability, fraud_flag, risk_tier"
FLAGGED = "CAST(sum(fraud_flag) AS BIGINT)"
FLAGGED_AMOUNT = (
    "CAST(sum(CASE WHEN fraud_flag = 1 THEN amount ELSE 0 END) AS DECIMAL(25,2))"
)
QUEUE = (
    'txn_id, "timestamp", sender_vpa, receiver_vpa, amount, bank, app_name, fraud_probability, '
    "risk_tier, device_mismatch, geo_anomaly, is_new_receiver, sender_txn_velocity_1h"
)
DAY_ONE = """"timestamp" >= TIMESTAMP '2024-01-01' AND "timestamp" < TIMESTAMP '2024-01-02'"""


def by(key: str, digits: int, rows: str, flagged: str, more: str = "", name: str = "") -> str:
    return on_scored(
        f"SELECT {key} AS {name or key}, count(*) AS {rows}, {FLAGGED} AS {flagged}, "
        f"{pct('sum(fraud_flag)', 'count(*)', digits)} AS fraud_rate_pct{more} "
        f"FROM scored GROUP BY {key}"
    )


def class_mean(value: str, label: int, digits: int = 2, factor: str = "1.0") -> str:
    case = f"CASE WHEN is_fraud = {label} THEN {value} END"
    return rounded(f"CAST(sum({case}) AS DOUBLE) / nullif(count({case}), 0) * {factor}::DOUBLE", digits)


def pearson(a: str, b: str) -> str:
    x, y = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    return f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"


def curve(rows: str) -> str:
    """Distinct scores with running totals, from a relation (score, label)."""
    return f"""
    grouped AS (
      SELECT score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
      FROM ({rows}) GROUP BY score
    ),
    curve AS (
      SELECT score, pos, neg,
             CAST(sum(pos) OVER (ORDER BY score DESC) AS BIGINT) AS tp,
             CAST(sum(neg) OVER (ORDER BY score DESC) AS BIGINT) AS fp
      FROM grouped
    ),
    whole AS (SELECT CAST(sum(pos) AS DOUBLE) AS p, CAST(sum(neg) AS DOUBLE) AS n FROM grouped),
    steps AS (
      SELECT *, tp / CAST(tp + fp AS DOUBLE) AS prec,
             lag(tp, 1, 0) OVER (ORDER BY score DESC) AS tp0,
             lag(fp, 1, 0) OVER (ORDER BY score DESC) AS fp0,
             lag(tp / CAST(tp + fp AS DOUBLE), 1, 1.0) OVER (ORDER BY score DESC) AS prec0
      FROM curve
    ),
    areas AS (
      SELECT sum((fp - fp0) / n * (tp + tp0) / (2 * p)) AS roc_auc,
             sum((tp - tp0) / p * prec) AS average_precision,
             sum((tp - tp0) / p * (prec + prec0) / 2) AS pr_auc
      FROM steps, whole
    )"""


RULE_CURVE = curve("SELECT fraud_probability AS score, is_fraud AS label FROM scored")
FINE_CURVE = curve("SELECT CAST(amount AS DOUBLE) / 300000 AS score, is_fraud AS label FROM raw")


def areas(steps: str, *names: str) -> str:
    wanted = ", ".join(f"{rounded(name, 6)} AS {name}" for name in names)
    return f"{ON_EVENTS}, {steps} SELECT {wanted} FROM areas"


GRID = ", ".join(f"({edge!r}::DOUBLE)" for edge in SWEEP_GRID)
SWEEP = f"""
    grid(threshold) AS (VALUES {GRID}),
    cells AS (
      SELECT threshold,
        count(*) FILTER (is_fraud = 1 AND fraud_probability >= threshold) AS tp,
        count(*) FILTER (is_fraud = 0 AND fraud_probability >= threshold) AS fp,
        count(*) FILTER (is_fraud = 1 AND fraud_probability < threshold) AS fn,
        count(*) FILTER (is_fraud = 0 AND fraud_probability < threshold) AS tn
      FROM grid, scored GROUP BY threshold
    ),
    sweep AS (
      SELECT *, coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0) AS prec,
             coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0) AS rec,
             coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0) AS f1
      FROM cells
    )"""


SIDES = """,
  dealt AS (
    SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY md5(txn_id))
              <= floor(count(*) OVER (PARTITION BY is_fraud) * 0.2 + 0.5) AS is_test
    FROM features
  ),
  train AS (SELECT * FROM dealt WHERE NOT is_test),
  test AS (SELECT * FROM dealt WHERE is_test)
"""
DECISIONS = on_scored(
    f"{SIDES} SELECT txn_id, is_fraud, true AS in_range, true AS as_expected, true AS flag_agrees, "
    "true AS tier_agrees FROM test"
)

LOOKUP = 'txn_id, "timestamp", sender_vpa, amount, fraud_probability, fraud_flag, risk_tier'


def best(j: str) -> str:
    return f"""{ON_EVENTS}, {SWEEP},
    ranked AS (SELECT threshold, {j} AS j FROM sweep WHERE tp + fp > 0),
    top AS (SELECT threshold, j FROM ranked WHERE j > 0 ORDER BY j DESC, threshold LIMIT 1)
    SELECT {rounded('coalesce(max(threshold), 0.5)', 6)} AS threshold,
           {rounded('coalesce(max(j), 0.0)', 6)} AS j FROM top"""


def histogram(parts: str, bins: int) -> str:
    """Equal-width bins of a relation (class, x)."""
    return f"""{ON_EVENTS},
    parts AS ({parts}),
    limits AS (
      SELECT class,
             min(x) - CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS low,
             max(x) + CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS high
      FROM parts GROUP BY class
    ),
    counts AS (
      SELECT class, least(CAST(floor({bins}.0::DOUBLE * (x - low) / (high - low)) AS INTEGER), {bins - 1}) AS bin,
             count(*) AS n
      FROM parts JOIN limits USING (class) GROUP BY 1, 2
    ),
    spine AS (SELECT class, low, high, CAST(unnest(range(0, {bins})) AS INTEGER) AS bin FROM limits)
    SELECT class, bin, {rounded(f'low + bin * (high - low) / {bins}.0::DOUBLE', 6)} AS lower_edge,
           coalesce(n, 0) AS count
    FROM spine LEFT JOIN counts USING (class, bin)"""


def closed(end: str, delay: str) -> str:
    return f'{end} <= (SELECT max("timestamp") FROM raw) - INTERVAL {delay}'


DAILY = on_scored(
    'SELECT CAST("timestamp" AS DATE) AS txn_date, count(*) AS total_txns, '
    f"{FLAGGED} AS fraud_txns, {pct('sum(fraud_flag)', 'count(*)', 3)} AS daily_fraud_rate_pct, "
    f"{FLAGGED_AMOUNT} AS fraud_amount FROM scored GROUP BY 1"
)
WEEKLY = on_scored(
    """SELECT CAST(date_trunc('week', "timestamp") AS TIMESTAMP) AS week_start, """
    f"count(*) AS weekly_txns, {FLAGGED} AS weekly_fraud, "
    f"{pct('sum(fraud_flag)', 'count(*)', 3)} AS weekly_fraud_rate_pct FROM scored GROUP BY 1"
)
ROLLING_STEPS = f"""
    daily AS (SELECT CAST("timestamp" AS DATE) AS d, count(*) AS t, sum(fraud_flag) AS f
              FROM scored GROUP BY 1)"""
ROLLED = (
    "CAST(sum(i.t) AS BIGINT) AS txns_7d, CAST(sum(i.f) AS BIGINT) AS fraud_7d, "
    f"{pct('sum(i.f)', 'sum(i.t)', 3)} AS fraud_rate_7d_pct"
)
ROLLING = f"""{ON_EVENTS}, {ROLLING_STEPS}
    SELECT o.d AS txn_date, {ROLLED}
    FROM daily o JOIN daily i ON i.d BETWEEN o.d - 6 AND o.d GROUP BY o.d"""
ROLLING_STREAM = f"""{ON_EVENTS}, {ROLLING_STEPS},
    ends AS (SELECT CAST(unnest(range(min(d), max(d) + 7, INTERVAL 1 DAY)) AS DATE) AS e FROM daily)
    SELECT e AS txn_date, {ROLLED}
    FROM ends JOIN daily i ON i.d BETWEEN e - 6 AND e
    WHERE {closed('e + INTERVAL 1 DAY', '1 HOUR')} GROUP BY e"""
ALERTS = f"""{ON_EVENTS},
    placed AS (
      SELECT sender_vpa,
             time_bucket(INTERVAL 5 MINUTE, "timestamp") - INTERVAL 5 MINUTE * unnest(range(0, 12)) AS start
      FROM raw
    )
    SELECT start AS window_start, start + INTERVAL 1 HOUR AS window_end, sender_vpa, count(*) AS txns
    FROM placed WHERE {closed('start + INTERVAL 1 HOUR', '10 MINUTE')}
    GROUP BY start, sender_vpa HAVING count(*) > 1"""

MATRIX_NAMES = [*FEATURE_COLUMNS, LABEL]
MATRIX = (
    f"{ON_EVENTS}, wide AS (SELECT "
    + ", ".join(
        f'{rounded(pearson(a, b), 6)} AS "{a}|{b}"' for a in MATRIX_NAMES for b in MATRIX_NAMES
    )
    + """ FROM features),
    long AS (FROM wide UNPIVOT INCLUDE NULLS (correlation FOR pair IN (COLUMNS(*))))
    SELECT split_part(pair, '|', 1) AS feature_a, split_part(pair, '|', 2) AS feature_b, correlation FROM long"""
)
LABEL_CORRELATION = (
    f"{ON_EVENTS}, wide AS (SELECT "
    + ", ".join(f"{rounded(pearson(name, LABEL), 6)} AS {name}" for name in FEATURE_COLUMNS)
    + " FROM features) SELECT feature, correlation FROM "
    "wide UNPIVOT INCLUDE NULLS (correlation FOR feature IN (COLUMNS(*)))"
)


def trailing_orders() -> str:
    return f"""{ON_ORDERS} SELECT txn_id, sender_txn_velocity_24h, sender_txn_count_30d,
      CAST(coalesce(sum(amount) {trailing('30 DAY')}, 0) AS DECIMAL(26,2)) AS total_30d
      FROM features"""


def features_orders() -> str:
    inner = columns("is_new_receiver", "amount_zscore", "sender_avg_amount_30d")
    return f"{ON_ORDERS}, {USUAL_STEPS} SELECT txn_id, {inner}, {USUAL_FLAGS} FROM usual"


def all_oracles() -> dict[str, str]:
    found = {
        "s1_s5_csv_round_trip": on_scored(f"SELECT {RAW_LIST} FROM raw"),
        "s2_features_round_trip": on_scored(f"SELECT {FEATURE_LIST} FROM features"),
        "s3_s7_scored_by_day": on_scored(f"SELECT {SCORED_LIST} FROM scored"),
        "s6_sql_view": on_scored(
            'SELECT risk_tier, CAST("timestamp" AS DATE) AS txn_date, count(*) AS txn_count, '
            f"{FLAGGED} AS fraud_count FROM scored GROUP BY 1, 2"
        ),
        "s7_pruned_day": on_scored(
            f"SELECT {QUEUE} FROM scored WHERE risk_tier = 'HIGH' AND {DAY_ONE}"
        ),
        "s7_sender_lookup": on_scored(f"SELECT {LOOKUP} FROM scored WHERE sender_vpa = 'user7@upi'"),
        "s7_tier_lookup": on_scored(f"SELECT {LOOKUP} FROM scored WHERE risk_tier = 'MEDIUM'"),
        "s7_flagged_lookup": on_scored(f"SELECT {LOOKUP} FROM scored WHERE fraud_flag = 1"),
        "s8_e7_saved_decision": f"""{ON_EVENTS}, {SWEEP},
            ranked AS (SELECT threshold, prec + rec - 1 AS j FROM sweep WHERE tp + fp > 0),
            top AS (SELECT threshold FROM ranked WHERE j > 0 ORDER BY j DESC, threshold LIMIT 1)
            SELECT txn_id, fraud_probability,
                   CAST(fraud_probability >= coalesce((SELECT threshold FROM top), 0.5) AS INTEGER) AS fraud_flag, risk_tier
            FROM scored""",
        "s10_transactions": on_scored(f"SELECT {RAW_LIST} FROM raw"),
        "s10_transactions_orders": f"WITH {ROWS_ORDERS} SELECT {RAW_LIST} FROM raw",
        "p1_p9_top_high_risk": on_scored(
            "SELECT txn_id, sender_vpa, amount, fraud_probability, bank FROM scored "
            "WHERE risk_tier = 'HIGH' ORDER BY txn_id LIMIT 5"
        ),
        "p4_labelled_fraud": on_scored(f"SELECT {RAW_LIST} FROM raw WHERE is_fraud = 1"),
        "p5_one_day": on_scored(f"SELECT {RAW_LIST} FROM raw WHERE {DAY_ONE}"),
        "x1_x15_scalar_time": on_scored(
            """SELECT txn_id, CAST("timestamp" AS DATE) AS txn_date,
            CAST(date_trunc('week', "timestamp") AS TIMESTAMP) AS week_start,
            CAST(hour("timestamp") AS INTEGER) AS hour,
            CAST(isodow("timestamp") - 1 AS INTEGER) AS weekday,
            strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS text,
            date_trunc('second', "timestamp") AS parsed,
            epoch_us("timestamp") AS micros FROM raw"""
        ),
        "x3_x13_scalar_number": on_scored(
            f"""SELECT txn_id, {rounded('CAST(amount AS DOUBLE) / 7', 2)} AS rounded,
            {rounded('100 * device_mismatch / 3.0::DOUBLE', 3)} AS percent,
            CAST(device_mismatch AS DOUBLE) AS as_double,
            {rounded('ln(1 + CAST(amount AS DOUBLE))', 6)} AS log_amount,
            CAST(amount % 500 AS DECIMAL(15,2)) AS remainder,
            least(greatest(CAST(amount AS DOUBLE), 100.0::DOUBLE), 2000.0::DOUBLE) AS clipped,
            coalesce(failure_reason, txn_status) AS reason_or_status,
            coalesce(nullif(device_mismatch, 0), 1) AS zero_to_one,
            CAST(amount > 1000 AS INTEGER) AS over_1000,
            sender_vpa || '|' || receiver_vpa AS pair FROM raw"""
        ),
        "x16_tiers": """SELECT event_id, CASE WHEN value / 100 >= 0.70::DOUBLE THEN 'HIGH'
            WHEN value / 100 >= 0.40::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
            'LOW' AS of_null FROM events""",
        "j1_zscore_by_join": on_scored(f"SELECT {columns('txn_id', 'amount_zscore')} FROM features"),
        "j3_tier_counts": on_scored(
            "SELECT risk_tier, n AS txn_count FROM (VALUES ('HIGH'), ('MEDIUM'), ('LOW')) t(risk_tier) "
            "LEFT JOIN (SELECT risk_tier, count(*) AS n FROM scored GROUP BY 1) USING (risk_tier)"
        ),
        "a8_sender_statistics": on_scored(
            "SELECT sender_vpa, count(*) AS txns, "
            f"{rounded('avg(CAST(amount AS DOUBLE))', 6)} AS mean_amount, "
            f"{rounded('stddev_samp(CAST(amount AS DOUBLE))', 6)} AS std_amount, "
            "max(amount) AS max_amount FROM raw GROUP BY sender_vpa"
        ),
        "a13_value_counts": on_scored("SELECT is_fraud, count(*) AS count FROM raw GROUP BY 1"),
        "a14_bank_label_rate": on_scored(
            f"SELECT bank, {rounded('avg(is_fraud)', 6)} AS mean_is_fraud FROM raw GROUP BY bank"
        ),
        "a16_correlation_matrix": MATRIX,
        "w1_trailing_orders": trailing_orders(),
        "w1_trailing_orders_split": trailing_orders(),
        "w4_features_orders": features_orders(),
        "w4_features_orders_split": features_orders(),
        "w5_curve": f"{ON_EVENTS}, {FINE_CURVE} SELECT {rounded('score', 6)} AS score, pos, neg, tp, fp FROM curve",
        "f18_build_features": on_scored(f"SELECT {FEATURE_LIST} FROM features"),
        "f18_build_features_split": on_scored(f"SELECT {FEATURE_LIST} FROM features"),
        "f16_f17_usual_split": f"{ON_EVENTS}, {USUAL_STEPS} SELECT txn_id, {USUAL_FLAGS} FROM usual",
    }
    for number, name in enumerate(FEATURE_COLUMNS, start=1):
        source = "features" if name in DERIVED.fieldNames() else "raw"
        found[f"f{number}_{name}"] = on_scored(f"SELECT {columns('txn_id', name)} FROM {source}")
    for number, (attribute, name) in enumerate(
        [("device_id", "usual_device_mismatch"), ("sender_state", "usual_state_mismatch")], start=16
    ):
        found[f"f{number}_{name}"] = (
            f"{ON_EVENTS}, {USUAL_STEPS} SELECT txn_id, {usual(attribute, name)} FROM usual"
        )

    found |= {
        "k1_overall_kpis": on_scored(
            f"SELECT count(*) AS total_transactions, {FLAGGED} AS flagged_transactions, "
            f"{pct('sum(fraud_flag)', 'count(*)', 2)} AS fraud_rate_pct, "
            f"{FLAGGED_AMOUNT} AS flagged_amount, "
            f"{mean_money('CASE WHEN fraud_flag = 1 THEN amount END')} AS avg_fraud_ticket_size, "
            f"{mean_money('CASE WHEN fraud_flag = 0 THEN amount END')} AS avg_legit_ticket_size "
            "FROM scored"
        ),
        "k2_daily_trend": DAILY,
        "k3_tier_breakdown": on_scored(
            f"SELECT risk_tier, count(*) AS txn_count, {FLAGGED} AS confirmed_fraud, "
            f"{rounded('avg(fraud_probability) * 100', 2)} AS avg_fraud_prob_pct, "
            "CAST(sum(amount) AS DECIMAL(25,2)) AS total_amount_at_risk FROM scored GROUP BY risk_tier"
        ),
        "k4_top_senders": on_scored(
            f"SELECT sender_vpa, count(*) AS total_txns, {FLAGGED} AS fraud_txns, "
            f"{pct('sum(fraud_flag)', 'count(*)', 1)} AS fraud_rate_pct, "
            "CAST(sum(CASE WHEN fraud_flag = 1 THEN amount END) AS DECIMAL(25,2)) AS total_fraud_amount "
            "FROM scored GROUP BY sender_vpa HAVING sum(fraud_flag) > 0 "
            "ORDER BY fraud_txns DESC, sender_vpa LIMIT 10"
        ),
        "k5_fraud_by_bank": by(
            "bank", 2, "total_txns", "fraud_txns", f", {FLAGGED_AMOUNT} AS fraud_exposure"
        ),
        "k6_fraud_by_hour": by("txn_hour", 3, "total_txns", "fraud_txns", name="hour_of_day"),
        "k7_fraud_by_app": by("app_name", 2, "total_txns", "fraud_txns"),
        "k8_fraud_by_device_mismatch": by("device_mismatch", 2, "txn_count", "fraud_count"),
        "k9_fraud_by_geo_anomaly": by(
            "geo_anomaly", 2, "txn_count", "fraud_count", f", {mean_money('amount')} AS avg_amount"
        ),
        "k10_high_risk_queue": on_scored(
            f"SELECT {QUEUE} FROM scored WHERE risk_tier = 'HIGH' AND {DAY_ONE}"
        ),
        "k11_velocity_abuse": on_scored(
            "SELECT sender_vpa, max(sender_txn_velocity_1h) AS max_1h_velocity, "
            f"count(*) AS total_txns, {FLAGGED} AS fraud_flags, "
            "CAST(sum(amount) AS DECIMAL(25,2)) AS total_amount FROM scored "
            "WHERE sender_txn_velocity_1h > 1 GROUP BY sender_vpa "
            "ORDER BY max_1h_velocity DESC, sender_vpa LIMIT 25"
        ),
        "k12_compound_risk": on_scored(
            'SELECT txn_id, "timestamp", sender_vpa, receiver_vpa, amount, fraud_probability, risk_tier '
            "FROM scored WHERE amount > 50000 AND is_new_receiver = 1 AND device_mismatch = 1"
        ),
        "k13_fraud_by_new_receiver": by("is_new_receiver", 2, "txn_count", "fraud_count"),
        "k14_weekly_rate": WEEKLY,
        "k15_rolling_rate": ROLLING,
        "k16_class_contrast": on_scored(
            "SELECT "
            + ", ".join(
                f"{class_mean(value, label)} AS {prefix}_{name}"
                for name, value in (
                    ("avg_hour", "txn_hour"),
                    ("avg_amount", "amount"),
                    ("avg_velocity_24h", "sender_txn_velocity_24h"),
                )
                for prefix, label in (("fraud", 1), ("legit", 0))
            )
            + f", {class_mean('device_mismatch', 1, 1, '100.0')} AS fraud_device_mismatch_pct"
            + f", {class_mean('device_mismatch', 0, 1, '100.0')} AS legit_device_mismatch_pct"
            + " FROM scored"
        ),
        "k17_kpi_snapshot": on_scored(
            f"SELECT count(*) AS total, {FLAGGED} AS flagged, "
            f"{pct('sum(fraud_flag)', 'count(*)', 2)} AS fraud_rate, "
            f"{mean_money('CASE WHEN fraud_flag = 1 THEN amount END')} AS avg_ticket, "
            "count(*) FILTER (risk_tier = 'HIGH') AS high_risk FROM scored"
        ),
        "k18_scoring_summary": on_scored(
            f"SELECT count(*) AS records_scored, {FLAGGED} AS flagged, "
            f"{pct('sum(fraud_flag)', 'count(*)', 2)} AS flagged_pct, "
            "count(*) FILTER (risk_tier = 'HIGH') AS high_risk, "
            "count(*) FILTER (risk_tier = 'MEDIUM') AS medium_risk, "
            "count(*) FILTER (risk_tier = 'LOW') AS low_risk FROM scored"
        ),
        "k19_rate_matrix": on_scored(
            "SELECT txn_hour, "
            + ", ".join(
                rounded(f"avg(CASE WHEN txn_day_of_week = {i} THEN is_fraud END)", 6) + f" AS {day}"
                for i, day in enumerate(WEEKDAYS)
            )
            + " FROM features GROUP BY txn_hour"
        ),
        "k20_amount_histogram": histogram(
            "SELECT CASE WHEN is_fraud = 1 THEN 'fraud' ELSE 'legit' END AS class, "
            "ln(1 + CAST(amount AS DOUBLE)) AS x FROM raw",
            50,
        ),
        "k20_probability_histogram": histogram(
            "SELECT 'all' AS class, fraud_probability AS x FROM scored", 80
        ),
        "k21_daily_flagged": f"""{ON_EVENTS},
            daily AS (SELECT CAST("timestamp" AS DATE) AS d, sum(fraud_flag) AS f FROM scored GROUP BY 1),
            days AS (SELECT CAST(unnest(range(min(d), max(d) + 1, INTERVAL 1 DAY)) AS DATE) AS d FROM daily)
            SELECT d AS txn_date, CAST(coalesce(f, 0) AS BIGINT) AS flagged FROM days LEFT JOIN daily USING (d)""",
        "k22_dataset_overview": on_scored(
            "SELECT count(*) AS rows, CAST(sum(is_fraud) AS BIGINT) AS fraud_rows, "
            f"{pct('sum(is_fraud)', 'count(*)', 2)} AS fraud_rate_pct FROM raw"
        ),
        "k23_label_correlation": LABEL_CORRELATION,
        "e1_roc_auc": areas(RULE_CURVE, "roc_auc"),
        "e2_average_precision": areas(RULE_CURVE, "average_precision"),
        "e3_pr_auc": areas(RULE_CURVE, "pr_auc"),
        "e1_e3_fine_score": areas(FINE_CURVE, "roc_auc", "average_precision", "pr_auc"),
        "e4_roc_points": f"{ON_EVENTS}, {RULE_CURVE} SELECT {rounded('score', 6)} AS threshold, "
        f"{rounded('fp / n', 6)} AS fpr, {rounded('tp / p', 6)} AS tpr FROM curve, whole",
        "e4_pr_points": f"{ON_EVENTS}, {RULE_CURVE} SELECT {rounded('score', 6)} AS threshold, "
        f"{rounded('tp / CAST(tp + fp AS DOUBLE)', 6)} AS precision, "
        f"{rounded('tp / p', 6)} AS recall FROM curve, whole",
        "e5_e6_confusion": f"""{ON_EVENTS}, cells AS (SELECT
            count(*) FILTER (is_fraud = 0 AND fraud_probability < 0.5) AS tn,
            count(*) FILTER (is_fraud = 0 AND fraud_probability >= 0.5) AS fp,
            count(*) FILTER (is_fraud = 1 AND fraud_probability < 0.5) AS fn,
            count(*) FILTER (is_fraud = 1 AND fraud_probability >= 0.5) AS tp FROM scored)
            SELECT *, {rounded('coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0)', 6)} AS precision,
            {rounded('coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0)', 6)} AS recall,
            {rounded('coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0)', 6)} AS f1 FROM cells""",
        "e7_threshold_sweep": f"{ON_EVENTS}, {SWEEP} SELECT {rounded('threshold', 6)} AS threshold, "
        f"tp, fp, fn, tn, {rounded('prec', 6)} AS precision, {rounded('rec', 6)} AS recall, "
        f"{rounded('f1', 6)} AS f1 FROM sweep",
        "e7_best_threshold": best("prec + rec - 1"),
        "e7_best_threshold_youden": best("rec - coalesce(fp / nullif(CAST(fp + tn AS DOUBLE), 0), 0)"),
        "r1_scored": on_scored(f"SELECT {SCORED_LIST} FROM scored"),
        "m1_class_weights": on_scored(
            "SELECT count(*) AS total, CAST(sum(is_fraud) AS BIGINT) AS fraud, "
            "CAST(sum(1 - is_fraud) AS BIGINT) AS legit, "
            f"{rounded('CAST(sum(1 - is_fraud) AS DOUBLE) / nullif(sum(is_fraud), 0)', 6)} AS scale_pos_weight "
            "FROM raw"
        ),
        "m2_split": on_scored(
            "SELECT txn_id, CAST(substr(md5(txn_id), 1, 8) < '33333333' AS INTEGER) AS is_test FROM raw"
        ),
        "m2_stratified_split": on_scored(
            "SELECT txn_id, CAST(row_number() OVER (PARTITION BY is_fraud ORDER BY md5(txn_id)) "
            "<= floor(count(*) OVER (PARTITION BY is_fraud) * 0.2 + 0.5) AS INTEGER) AS is_test FROM raw"
        ),
        "m3_m4_logistic_fit": on_scored(
            f"{SIDES} "
            + " UNION ALL ".join(
                f"SELECT '{name}' AS feature, {rounded(f'avg(CAST({name} AS DOUBLE))', 3)} AS mean, "
                f"{rounded(f'stddev_samp(CAST({name} AS DOUBLE))', 3)} AS deviation, true AS at_optimum FROM train"
                for name in FEATURE_COLUMNS
            )
            + " UNION ALL SELECT '(intercept)', 0.0::DOUBLE, 1.0::DOUBLE, true"
        ),
        "m6_m7_logistic_decisions": DECISIONS,
        "m5_s8_trees_decisions": DECISIONS,
        "m8_s4_importance_shares": "SELECT unnest(["
        + ", ".join(f"'{name}'" for name in FEATURE_COLUMNS)
        + "]) AS feature, true AS is_share, true AS adds_up",
        "e8_s9_t5_report_cells": on_scored(
            f"{SIDES} SELECT unnest(['logistic_regression', 'boosted_trees']) AS model, count(*) AS rows, "
            "CAST(sum(is_fraud) AS BIGINT) AS frauds, true AS measures_follow, true AS areas_in_range, "
            "true AS threshold_in_range, true AS top_five FROM test"
        ),
        "z1_daily_trend_stream": f"SELECT * FROM ({DAILY}) WHERE "
        "txn_date + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR",
        "z1_weekly_rate_stream": f"SELECT * FROM ({WEEKLY}) WHERE "
        "week_start + INTERVAL 7 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR",
        "z2_rolling_rate_stream": ROLLING_STREAM,
        "z3_velocity_alerts_stream": ALERTS,
        "z3_payment_velocity_stream": on_scored("SELECT txn_id, sender_txn_velocity_1h FROM features"),
        "z3_payment_alerts_stream": on_scored(
            'SELECT txn_id, "timestamp", sender_vpa, sender_txn_velocity_1h AS sender_txn_velocity '
            "FROM features WHERE sender_txn_velocity_1h > 1"
        ),
        "z4_scored_stream": on_scored(
            "SELECT txn_id, fraud_probability, fraud_flag, risk_tier FROM scored"
        ),
        "z5_first_payments_stream": on_scored(
            'SELECT sender_vpa, receiver_vpa, "timestamp", txn_id FROM features WHERE is_new_receiver = 1'
        ),
        "z5_new_pairs_stream": on_scored("SELECT DISTINCT sender_vpa, receiver_vpa FROM raw"),
    }
    return found
