"""Every operator and query as a callable over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paywatch.functions import micros, ratio, risk_tier, round_half_up
from paywatch.operators import HeavyRule, add_trailing
from paywatch.operators.deviation import attach_zscore, zscore_lookup
from paywatch.plans import evaluation, exploration, kpis, operations, training
from paywatch.plans.decision import RiskDecision, threshold_of
from paywatch.plans.features import (
    AMOUNT,
    HISTORY_30D,
    SENDER,
    USUAL,
    VELOCITY_24H,
    build_features,
)
from paywatch.plans.scoring import RULE_INPUTS, rule_score, score, scoring_summary
from paywatch.schema import DERIVED, FEATURE_COLUMNS, FEATURES, LABEL, REPORT
from paywatch.session import materialize, scratch_path
from paywatch.sources import (
    read_features,
    read_importances,
    read_lookup_table,
    read_raw,
    read_scored,
    read_table,
    register_transactions,
    transactions_from_events,
    transactions_from_orders,
    write_lookup_table,
    write_table,
)
from paywatch.streaming import (
    append_to_table,
    daily_trend_stream,
    first_payments_stream,
    latest_to_table,
    new_pairs_stream,
    payment_alerts_stream,
    payment_velocity_stream,
    read_stream,
    rolling_rate_stream,
    velocity_alerts_stream,
    weekly_rate_stream,
)

Query = Callable[[SparkSession, str], DataFrame]

# The test tables have no sender above the default bounds. With this rule every
# sender of more than one row takes the split forms.
SPLIT_MOST = HeavyRule(floor=1)
QUEUE_DAY = date(2024, 1, 1)


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return transactions_from_events(spark.read.parquet(f"{folder}/events.parquet"))


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return transactions_from_orders(spark.read.parquet(f"{folder}/orders.parquet"))


def features(spark: SparkSession, folder: str, *only: str) -> DataFrame:
    return build_features(raw(spark, folder), only or None)


def scored(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    """Rule-scored transactions with just the derived columns asked for."""
    return rule_score(features(spark, folder, *RULE_INPUTS, *more))


def six(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles that differ in the last bits between engines, to six digits."""
    return df.withColumns({name: round_half_up(F.col(name), 6) for name in columns})


def tidy(df: DataFrame) -> DataFrame:
    doubles = [name for name in ("amount_log", "amount_zscore", "sender_avg_amount_30d") if name in df.columns]
    return six(df, *doubles)


def _feature(*names: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return tidy(features(spark, folder, *names)).select("txn_id", *names)

    return run


def _kpi(plan: Callable[[DataFrame], DataFrame], *more: str) -> Query:
    return lambda spark, folder: plan(scored(spark, folder, *more))


# --- sources and sinks -------------------------------------------------------


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "raw-csv")
    write_table(raw(spark, folder), path, "csv")
    return read_raw(spark, path, "csv")


def features_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "features")
    write_table(features(spark, folder), path)
    return tidy(read_features(spark, path))


def scored_by_day(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "scored")
    write_table(rule_score(features(spark, folder)), path, by_day=True)
    return tidy(read_scored(spark, path))


def pruned_day(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "scored-days")
    write_table(rule_score(features(spark, folder)), path, by_day=True)
    return operations.high_risk_queue(read_scored(spark, path, with_day=True), QUEUE_DAY)


LOOKUP_COLUMNS = ["txn_id", "timestamp", "sender_vpa", "amount", "fraud_probability", "fraud_flag", "risk_tier"]
LOOKUP_SENDER = "user7@upi"


def lookup(choose: Callable[[DataFrame], DataFrame]) -> Query:
    """Rows found in a table laid out for look-ups."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        path = scratch_path(spark, "lookup")
        write_lookup_table(rule_score(features(spark, folder)), path)
        return choose(read_lookup_table(spark, path)).select(*LOOKUP_COLUMNS)

    return run


def sql_view(spark: SparkSession, folder: str) -> DataFrame:
    register_transactions(scored(spark, folder), "transactions")
    return spark.sql(
        """
        SELECT risk_tier, date(`timestamp`) AS txn_date, count(*) AS txn_count,
               sum(fraud_flag) AS fraud_count
        FROM transactions
        GROUP BY risk_tier, date(`timestamp`)
        ORDER BY risk_tier, txn_date
        """
    )


# --- projections, predicates, scalar functions ------------------------------


def scalar_time(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("timestamp")
    text = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return raw(spark, folder).select(
        "txn_id",
        F.to_date(ts).alias("txn_date"),
        F.date_trunc("week", ts).cast("timestamp_ntz").alias("week_start"),
        F.hour(ts).alias("hour"),
        F.weekday(ts).alias("weekday"),
        text.alias("text"),
        F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm:ss")).alias("parsed"),
        micros(ts).alias("micros"),
    )


def scalar_number(spark: SparkSession, folder: str) -> DataFrame:
    amount = F.col("amount").cast("double")
    device = F.col("device_mismatch")
    return raw(spark, folder).select(
        "txn_id",
        round_half_up(amount / 7, 2).alias("rounded"),
        round_half_up(ratio(100 * device, F.lit(3)), 3).alias("percent"),
        device.cast("double").alias("as_double"),
        round_half_up(F.log1p(amount), 6).alias("log_amount"),
        (F.col("amount") % 500).alias("remainder"),
        F.least(F.greatest(amount, F.lit(100.0)), F.lit(2000.0)).alias("clipped"),
        F.coalesce(F.col("failure_reason"), F.col("txn_status")).alias("reason_or_status"),
        F.coalesce(F.nullif(device, F.lit(0)), F.lit(1)).alias("zero_to_one"),
        (F.col("amount") > 1000).cast("int").alias("over_1000"),
        F.concat_ws("|", "sender_vpa", "receiver_vpa").alias("pair"),
    )


def tiers(spark: SparkSession, folder: str) -> DataFrame:
    p = F.col("value") / 100
    return spark.read.parquet(f"{folder}/events.parquet").select(
        "event_id", risk_tier(p).alias("risk_tier"), risk_tier(F.lit(None)).alias("of_null")
    )


# --- joins, windows, aggregates ---------------------------------------------


def zscore_by_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = raw(spark, folder)
    joined = attach_zscore(rows, zscore_lookup(rows, SENDER, AMOUNT), SENDER, AMOUNT, "amount_zscore")
    return tidy(joined).select("txn_id", "amount_zscore")


def trailing_orders(rule: HeavyRule) -> Query:
    """Trailing counts where many payments share an instant."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        timed = orders(spark, folder).withColumn("_at", micros(F.col("timestamp")))
        specs = [VELOCITY_24H, HISTORY_30D]
        counted = add_trailing(timed, SENDER, "_at", AMOUNT, specs, rule)
        return counted.select(
            "txn_id",
            VELOCITY_24H.count,
            HISTORY_30D.count,
            F.col(HISTORY_30D.total).alias("total_30d"),
        )

    return run


def features_orders(rule: HeavyRule) -> Query:
    names = ["is_new_receiver", "amount_zscore", "sender_avg_amount_30d", *USUAL]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return tidy(build_features(orders(spark, folder), names, rule)).select("txn_id", *names)

    return run


def features_split(spark: SparkSession, folder: str) -> DataFrame:
    built = build_features(raw(spark, folder), rule=SPLIT_MOST)
    return tidy(built).select(*FEATURES.fieldNames())


def usual_split(spark: SparkSession, folder: str) -> DataFrame:
    return build_features(raw(spark, folder), USUAL, SPLIT_MOST).select("txn_id", *USUAL)


def probability_histogram(spark: SparkSession, folder: str) -> DataFrame:
    # Two passes over the probabilities: written once, not scored twice.
    chances = materialize(scored(spark, folder).select("fraud_probability"), "chances")
    return six(exploration.probability_histogram(chances), "lower_edge")


def sender_statistics(spark: SparkSession, folder: str) -> DataFrame:
    grouped = raw(spark, folder).groupBy("sender_vpa").agg(
        F.count("*").alias("txns"),
        F.avg(F.col("amount").cast("double")).alias("mean_amount"),
        F.stddev_samp(F.col("amount").cast("double")).alias("std_amount"),
        F.max("amount").alias("max_amount"),
    )
    return six(grouped, "mean_amount", "std_amount")


def matrix(spark: SparkSession, folder: str) -> DataFrame:
    return six(exploration.correlation_matrix(features(spark, folder)), "correlation")


# --- measures of the score ---------------------------------------------------


def measure(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return six(evaluation.ranking_measures(scored(spark, folder)), *MEASURES).select(name)

    return run


MEASURES = ("roc_auc", "average_precision", "pr_auc")


def fine_score(spark: SparkSession, folder: str) -> DataFrame:
    """A score with thousands of values, most of them crowded near zero."""
    value = F.col("amount").cast("double") / 300000
    return raw(spark, folder).withColumn("fraud_probability", value)


def fine_curve(spark: SparkSession, folder: str) -> DataFrame:
    return six(evaluation.curve(fine_score(spark, folder), buckets=64), "score")


def fine_measures(spark: SparkSession, folder: str) -> DataFrame:
    return six(evaluation.ranking_measures(fine_score(spark, folder)), *MEASURES)


def sweep(spark: SparkSession, folder: str) -> DataFrame:
    swept = evaluation.threshold_sweep(scored(spark, folder))
    return six(swept, "threshold", "precision", "recall", "f1")


def best(criterion: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        swept = evaluation.threshold_sweep(scored(spark, folder))
        return six(evaluation.best_threshold(swept, criterion), "threshold", "j")

    return run


# --- models ------------------------------------------------------------------


def _inputs(spark: SparkSession, folder: str) -> DataFrame:
    wanted = features(spark, folder).select("txn_id", LABEL, *FEATURE_COLUMNS)
    return materialize(wanted, "model-inputs")


#: Folders of the models fitted so far, by session and input folder.
_FITTED: dict[tuple[str, str], str] = {}


def _inputs_and_models(spark: SparkSession, folder: str) -> str:
    """A folder with `inputs`, `logistic`, `trees`, `importances` and `report` of one training run.

    The run is made once a session and input folder; the queries below read what it saved.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _FITTED:
        inputs = _inputs(spark, folder)
        run = training.train_and_compare(inputs)
        path = scratch_path(spark, "models")
        write_table(inputs, f"{path}/inputs")
        training.save_model(run.logistic, f"{path}/logistic")
        training.save_model(run.trees, f"{path}/trees")
        write_table(run.importances, f"{path}/importances", "csv")
        write_table(run.report, f"{path}/report", "csv")
        _FITTED[key] = path
    return _FITTED[key]


def _sides(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return training.split(spark.read.parquet(f"{path}/inputs"))


def _model_scores(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        path = _inputs_and_models(spark, folder)
        return score(_sides(spark, path)[1], training.load_model(f"{path}/{name}"))

    return run


logistic_scores, trees_scores = _model_scores("logistic"), _model_scores("trees")


def _decisions(test: DataFrame, model: PipelineModel, expected: Column) -> DataFrame:
    """Per test row, whether probability, flag and tier are what they should be."""
    p = F.col("fraud_probability")
    return score(test, model).select(
        "txn_id",
        LABEL,
        p.between(0, 1).alias("in_range"),
        (F.abs(p - expected) < 1e-9).alias("as_expected"),
        (F.col("fraud_flag") == (p >= threshold_of(model)).cast("int")).alias("flag_agrees"),
        (F.col("risk_tier") == F.when(p >= 0.7, "HIGH").when(p >= 0.4, "MEDIUM").otherwise("LOW")).alias(
            "tier_agrees"
        ),
    )


def logistic_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """The saved model's decisions against its formula written out."""
    path = _inputs_and_models(spark, folder)
    model = training.load_model(f"{path}/logistic")
    return _decisions(_sides(spark, path)[1], model, training.logistic_probability(model))


def trees_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """The saved model's decisions against the weighted sum of its trees' leaves, written out."""
    path = _inputs_and_models(spark, folder)
    model = training.load_model(f"{path}/trees")
    test = training.with_margin(_sides(spark, path)[1], model, "_margin")
    chance = F.lit(1.0) / (F.lit(1.0) + F.exp(-2 * F.col("_margin")))
    return _decisions(test, model, chance)


def logistic_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Moments of the training rows as the model holds them, and whether it is at its optimum."""
    path = _inputs_and_models(spark, folder)
    model = training.load_model(f"{path}/logistic")
    slopes = dict(training.logistic_gradient(model, _sides(spark, path)[0]))
    rows = [(name, mean, sd, abs(slopes[name]) < 1e-4) for name, mean, sd, _ in training.logistic_terms(model)]
    fitted = spark.createDataFrame(rows, "feature string, mean double, deviation double, at_optimum boolean")
    return fitted.withColumns({name: round_half_up(F.col(name), 3) for name in ("mean", "deviation")})


def tree_importances(spark: SparkSession, folder: str) -> DataFrame:
    saved = read_importances(spark, f"{_inputs_and_models(spark, folder)}/importances")
    return saved.orderBy(F.desc("importance_gain"), "feature")


def importance_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Every feature's importance is a share, and the shares add up to 1."""
    gain = F.col("importance_gain")
    whole = tree_importances(spark, folder).agg(F.sum("importance_gain")).head()[0]
    return tree_importances(spark, folder).select(
        "feature", gain.between(0, 1).alias("is_share"), F.lit(abs(whole - 1) < 1e-9).alias("adds_up")
    )


def model_report(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, f"{_inputs_and_models(spark, folder)}/report", REPORT, "csv")


def report_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The report held against the test rows: cells that add up, measures that follow from
    them, areas in their range, and the five strongest features."""
    report = model_report(spark, folder)
    names = ["tn", "fp", "fn", "tp", "precision", "recall", "f1", "roc_auc", "average_precision", "pr_auc", "threshold"]
    cells = report.where(F.col("model") != "importance").groupBy("model").agg(
        *[F.max(F.when(F.col("metric") == name, F.col("value"))).alias(name) for name in names]
    )
    tn, fp, fn, tp = (F.col(name) for name in names[:4])
    follows = {"precision": (tp, tp + fp), "recall": (tp, tp + fn), "f1": (2 * tp, 2 * tp + fp + fn)}
    agree = [
        F.abs(F.col(name) - F.coalesce(F.try_divide(part, whole), F.lit(0.0))) < 1e-9
        for name, (part, whole) in follows.items()
    ]
    strongest = tree_importances(spark, folder).limit(5).select("feature", "importance_gain")
    named = report.where(F.col("model") == "importance").select("metric", "value")
    top_five = named.count() == 5 and not named.exceptAll(strongest).take(1)
    return cells.select(
        "model",
        (tn + fp + fn + tp).cast("bigint").alias("rows"),
        (tp + fn).cast("bigint").alias("frauds"),
        (agree[0] & agree[1] & agree[2]).alias("measures_follow"),
        (
            F.col("roc_auc").between(0, 1) & F.col("average_precision").between(0, 1) & F.col("pr_auc").between(0, 1)
        ).alias("areas_in_range"),
        F.col("threshold").between(0, 1).alias("threshold_in_range"),
        F.lit(top_five).alias("top_five"),
    )


def split_marks(spark: SparkSession, folder: str) -> DataFrame:
    return training.with_split(raw(spark, folder)).select("txn_id", "is_test")


def stratified_marks(spark: SparkSession, folder: str) -> DataFrame:
    rows = materialize(raw(spark, folder).select("txn_id", LABEL), "labelled")
    return training.with_stratified_split(rows).select("txn_id", "is_test")


def saved_decision(spark: SparkSession, folder: str) -> DataFrame:
    """The threshold tuned on the rule's score, saved, loaded and used."""
    rows = materialize(scored(spark, folder).select("txn_id", LABEL, "fraud_probability"), "rule-scores")
    threshold = evaluation.best_threshold(evaluation.threshold_sweep(rows)).head().threshold
    path = scratch_path(spark, "decision")
    training.save_model(PipelineModel([RiskDecision(threshold=threshold, probabilityCol="fraud_probability")]), path)
    return training.load_model(path).transform(rows).select("txn_id", "fraud_probability", "fraud_flag", "risk_tier")


# --- streams -------------------------------------------------------------------


def _raw_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    # A stream reads folders; the pattern also takes a table that is a single file.
    return transactions_from_events(read_stream(spark, f"{folder}/events*.parquet", schema))


def _scored_stream(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    wanted = features(spark, folder, *RULE_INPUTS, *more)
    path = scratch_path(spark, "stream-source")
    write_table(wanted, path)
    return rule_score(read_stream(spark, path, wanted.schema))


def _stream(plan: Callable[[DataFrame], DataFrame], name: str) -> Query:
    return lambda spark, folder: append_to_table(plan(_scored_stream(spark, folder)), name)


def stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    alerts = velocity_alerts_stream(_raw_stream(spark, folder), threshold=1)
    return append_to_table(alerts, "alerts")


def stream_velocity(spark: SparkSession, folder: str) -> DataFrame:
    counted = append_to_table(payment_velocity_stream(_raw_stream(spark, folder)), "velocity")
    return counted.select("txn_id", F.col("sender_txn_velocity").alias("sender_txn_velocity_1h"))


def stream_payment_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return append_to_table(payment_alerts_stream(_raw_stream(spark, folder), threshold=1), "payment-alerts")


def stream_new_pairs(spark: SparkSession, folder: str) -> DataFrame:
    # Longer than the table's span, so that a pair is new once.
    return append_to_table(new_pairs_stream(_raw_stream(spark, folder), "3650 days"), "new-pairs")


def stream_scores(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["txn_id", "fraud_probability", "fraud_flag", "risk_tier"]
    return append_to_table(_scored_stream(spark, folder).select(*columns), "stream-scores")


def stream_first_payments(spark: SparkSession, folder: str) -> DataFrame:
    seen = latest_to_table(first_payments_stream(_raw_stream(spark, folder)), "first-payments")
    return first_payments_stream(seen)


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "s1_s5_csv_round_trip": csv_round_trip,
        "s2_features_round_trip": features_round_trip,
        "s3_s7_scored_by_day": scored_by_day,
        "s6_sql_view": sql_view,
        "s7_pruned_day": pruned_day,
        "s7_sender_lookup": lookup(lambda df: operations.of_sender(df, LOOKUP_SENDER)),
        "s7_tier_lookup": lookup(lambda df: operations.of_tier(df, "MEDIUM")),
        "s7_flagged_lookup": lookup(operations.flagged),
        "s8_e7_saved_decision": saved_decision,
        "s10_transactions": raw,
        "s10_transactions_orders": orders,
        "p1_p9_top_high_risk": _kpi(operations.top_high_risk),
        "p4_labelled_fraud": lambda s, d: raw(s, d).where(F.col(LABEL) == 1),
        "p5_one_day": lambda s, d: operations.of_days(raw(s, d), QUEUE_DAY),
        "x1_x15_scalar_time": scalar_time,
        "x3_x13_scalar_number": scalar_number,
        "x16_tiers": tiers,
        "j1_zscore_by_join": zscore_by_join,
        "j3_tier_counts": _kpi(kpis.tier_counts),
        "a8_sender_statistics": sender_statistics,
        "a13_value_counts": lambda s, d: exploration.value_counts(raw(s, d), LABEL),
        "a14_bank_label_rate": lambda s, d: six(
            exploration.label_rate_by(raw(s, d), "bank"), "mean_is_fraud"
        ),
        "a16_correlation_matrix": matrix,
        "w1_trailing_orders": trailing_orders(HeavyRule()),
        "w1_trailing_orders_split": trailing_orders(SPLIT_MOST),
        "w4_features_orders": features_orders(HeavyRule()),
        "w4_features_orders_split": features_orders(SPLIT_MOST),
        "w5_curve": fine_curve,
        "f18_build_features": lambda s, d: tidy(features(s, d)),
        "f18_build_features_split": features_split,
        "f16_f17_usual_split": usual_split,
    }
    for number, name in enumerate(FEATURE_COLUMNS, start=1):
        # The two flags that come with the input are selected, not derived.
        if name in DERIVED.fieldNames():
            found[f"f{number}_{name}"] = _feature(name)
        else:
            found[f"f{number}_{name}"] = lambda s, d, name=name: raw(s, d).select("txn_id", name)
    for number, name in enumerate(USUAL, start=16):
        found[f"f{number}_{name}"] = _feature(name)

    found |= {
        "k1_overall_kpis": _kpi(kpis.overall_kpis),
        "k2_daily_trend": _kpi(kpis.daily_trend),
        "k3_tier_breakdown": _kpi(kpis.tier_breakdown),
        "k4_top_senders": _kpi(kpis.top_senders),
        "k5_fraud_by_bank": _kpi(kpis.fraud_by_bank),
        "k6_fraud_by_hour": _kpi(kpis.fraud_by_hour, "txn_hour"),
        "k7_fraud_by_app": _kpi(kpis.fraud_by_app),
        "k8_fraud_by_device_mismatch": _kpi(kpis.fraud_by_device_mismatch),
        "k9_fraud_by_geo_anomaly": _kpi(kpis.fraud_by_geo_anomaly),
        "k10_high_risk_queue": lambda s, d: operations.high_risk_queue(
            scored(s, d, "sender_txn_velocity_1h"), QUEUE_DAY
        ),
        "k11_velocity_abuse": lambda s, d: operations.velocity_abuse(
            scored(s, d, "sender_txn_velocity_1h"), threshold=1
        ),
        "k12_compound_risk": _kpi(operations.compound_risk),
        "k13_fraud_by_new_receiver": _kpi(kpis.fraud_by_new_receiver),
        "k14_weekly_rate": _kpi(kpis.weekly_rate),
        "k15_rolling_rate": _kpi(kpis.rolling_rate),
        "k16_class_contrast": _kpi(
            kpis.class_contrast, "txn_hour", "sender_txn_velocity_24h"
        ),
        "k17_kpi_snapshot": _kpi(kpis.kpi_snapshot),
        "k18_scoring_summary": _kpi(scoring_summary),
        "k19_rate_matrix": lambda s, d: six(
            exploration.rate_matrix(features(s, d, "txn_hour", "txn_day_of_week")),
            *exploration.WEEKDAYS,
        ),
        "k20_amount_histogram": lambda s, d: six(
            exploration.amount_histogram(raw(s, d)), "lower_edge"
        ),
        "k20_probability_histogram": probability_histogram,
        "k21_daily_flagged": _kpi(kpis.daily_flagged),
        "k22_dataset_overview": lambda s, d: exploration.dataset_overview(raw(s, d)),
        "k23_label_correlation": lambda s, d: six(
            exploration.label_correlation(features(s, d)), "correlation"
        ),
        "e1_roc_auc": measure("roc_auc"),
        "e2_average_precision": measure("average_precision"),
        "e3_pr_auc": measure("pr_auc"),
        "e1_e3_fine_score": fine_measures,
        "e4_roc_points": lambda s, d: six(
            evaluation.roc_points(scored(s, d)), "threshold", "fpr", "tpr"
        ),
        "e4_pr_points": lambda s, d: six(
            evaluation.pr_points(scored(s, d)), "threshold", "precision", "recall"
        ),
        "e5_e6_confusion": lambda s, d: six(
            evaluation.confusion(scored(s, d)), "precision", "recall", "f1"
        ),
        "e7_threshold_sweep": sweep,
        "e7_best_threshold": best("precision_recall"),
        "e7_best_threshold_youden": best("youden"),
        "r1_scored": lambda s, d: tidy(rule_score(features(s, d))),
        "m1_class_weights": lambda s, d: six(
            training.class_weights(raw(s, d)), "scale_pos_weight"
        ),
        "m2_split": split_marks,
        "m2_stratified_split": stratified_marks,
        "m3_m7_logistic_scores": logistic_scores,
        "m5_s8_trees_scores": trees_scores,
        "m8_s4_importances": tree_importances,
        "e8_s9_model_report": model_report,
        "m3_m4_logistic_fit": logistic_fit,
        "m6_m7_logistic_decisions": logistic_decisions,
        "m5_s8_trees_decisions": trees_decisions,
        "m8_s4_importance_shares": importance_shares,
        "e8_s9_t5_report_cells": report_cells,
        "z1_daily_trend_stream": _stream(daily_trend_stream, "daily"),
        "z1_weekly_rate_stream": _stream(weekly_rate_stream, "weekly"),
        "z2_rolling_rate_stream": _stream(rolling_rate_stream, "rolling"),
        "z3_velocity_alerts_stream": stream_alerts,
        "z3_payment_velocity_stream": stream_velocity,
        "z3_payment_alerts_stream": stream_payment_alerts,
        "z4_scored_stream": stream_scores,
        "z5_first_payments_stream": stream_first_payments,
        "z5_new_pairs_stream": stream_new_pairs,
    }
    return found
