import hashlib
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from paywatch.contract import queries
from paywatch.plans import training
from paywatch.plans.decision import RiskDecision, threshold_of, with_decision
from paywatch.plans.evaluation import ranking_measures
from paywatch.plans.scoring import score
from paywatch.schema import FEATURE_COLUMNS
from paywatch.session import materialize
from paywatch.streaming import append_to_table, read_stream

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def inputs(spark):
    built = queries.features(spark, FOLDER).select("txn_id", "is_fraud", *FEATURE_COLUMNS)
    return materialize(built, "test-inputs")


@pytest.fixture(scope="module")
def trained(inputs):
    train, test = training.split(inputs)
    logistic = training.train_logistic(train, max_iter=50)
    trees = training.train_trees(*training.split_validation(train), rounds=5)
    return logistic, trees, test


def test_split_keeps_shares_and_is_stable(inputs):
    train, test = training.split(inputs)
    rows, held = inputs.count(), test.count()
    assert train.count() + held == rows
    assert held / rows == pytest.approx(0.2, abs=0.02)
    share = inputs.agg(F.avg("is_fraud")).head()[0]
    assert test.agg(F.avg("is_fraud")).head()[0] == pytest.approx(share, rel=0.35)
    assert test.select("txn_id").exceptAll(training.split(inputs.repartition(3))[1].select("txn_id")).count() == 0


@pytest.mark.parametrize("share", [0, 0.2, 0.37, 1])
def test_every_class_has_its_share(spark, share):
    """Against a sort; with a missing label, a class of one and ids that come twice."""
    rows = [(f"T{i}", i % 3 % 2) for i in range(1000)] + [("x", None), ("y", None), ("z", None), (None, 5), ("twice", 7), ("twice", 7)]
    marked = training.with_stratified_split(spark.createDataFrame(rows, "txn_id string, is_fraud int"), share).collect()
    hashes = {}
    for i, label in rows:
        hashes.setdefault(label, []).append(hashlib.md5((i or "").encode()).hexdigest())
    for label, own in hashes.items():
        count = int(len(own) * share + 0.5)
        chosen = sorted(hashlib.md5((r.txn_id or "").encode()).hexdigest() for r in marked if r.is_fraud == label and r.is_test)
        if label == 7:
            assert len(chosen) in (0, 2)
        else:
            assert chosen == sorted(own)[:count]
    assert len(marked) == len(rows)


def test_split_of_no_rows_and_of_a_wrong_share(spark):
    nothing = spark.createDataFrame([], "txn_id string, is_fraud int")
    assert training.with_stratified_split(nothing).count() == 0
    with pytest.raises(ValueError):
        training.with_stratified_split(nothing, 1.5)


def test_close_hashes_need_further_digits(spark, monkeypatch):
    monkeypatch.setattr(training, "DIGITS", 1)
    rows = spark.range(3000).selectExpr("cast(id AS string) AS txn_id", "cast(id % 2 AS int) AS is_fraud")
    counts = training.with_stratified_split(rows, 0.1).groupBy("is_fraud").agg(F.sum("is_test")).collect()
    assert [r[1] for r in counts] == [150, 150]


def test_threshold_travels_with_the_model(trained, tmp_path):
    _, trees, test = trained
    tuned = with_decision(trees, 0.123)
    training.save_model(tuned, str(tmp_path / "tuned"))
    again = training.load_model(str(tmp_path / "tuned"))
    assert threshold_of(again) == 0.123 and threshold_of(trees) == 0.5
    rows = score(test, again).orderBy("txn_id").collect()
    assert rows == score(test, trees, 0.123).orderBy("txn_id").collect()
    assert all(r.fraud_flag == (r.fraud_probability >= 0.123) for r in rows)
    assert score(test, again, 0.9).where("fraud_flag = 1 AND fraud_probability < 0.9").count() == 0
    assert len(with_decision(again, 0.4).stages) == len(trees.stages) + 1


def test_decision_on_odd_probabilities(spark):
    rows = spark.createDataFrame([(None,), (float("nan"),), (0.5,), (1.0,)], "probability double")
    got = RiskDecision(threshold=0.5).transform(rows).select("fraud_flag", "risk_tier").collect()
    assert [tuple(r) for r in got] == [(0, "LOW"), (0, "LOW"), (1, "MEDIUM"), (1, "HIGH")]
    with pytest.raises(ValueError):
        RiskDecision(threshold=1.5)


def test_validation_is_apart_from_test(inputs):
    train, test = training.split(inputs)
    fit, held = training.split_validation(train)
    assert fit.count() + held.count() == train.count()
    assert held.join(test, "txn_id").count() == 0


def test_class_weights(inputs):
    row = training.class_weights(inputs).head()
    assert (row.total, row.fraud) == (10000, 350)
    assert row.scale_pos_weight == pytest.approx(9650 / 350)


def test_rounds_to_keep():
    assert training.rounds_to_keep([0.5, 0.6, 0.7, 0.65, 0.7]) == 3
    assert training.rounds_to_keep([0.5, 0.6, 0.5, 0.4, 0.9], patience=2) == 2
    assert training.rounds_to_keep([1]) == 1


def test_areas_of_all_rounds_like_one_round_at_a_time(inputs, trained, monkeypatch):
    """The rounds' areas from one pass against cut models, each scored and measured alone."""
    monkeypatch.setattr(training, "TREES_AT_ONCE", 2)
    train, test = training.split(inputs)
    model = training._trees(5).fit(train.withColumn("_weight", F.lit(1.0)))
    got = training.areas_by_round(test, model)
    each = [ranking_measures(score(test, training.first_trees(model, k))).head().average_precision for k in range(1, 6)]
    assert got == pytest.approx(each, abs=1e-3)
    monkeypatch.setattr(training, "MARGIN_STEP", 1e-12)
    assert training.areas_by_round(test, model) == pytest.approx(each, abs=1e-9)
    assert training.areas_by_round(test.limit(0), model) == []


def test_margins_are_those_of_the_model(inputs, trained):
    _, trees, test = trained
    marked = training.with_rounds(test, trees, "rounds")
    assert marked.columns == [*test.columns, "rounds"]
    chance = 1 / (1 + F.exp(-2 * F.element_at("rounds", -1)))
    both = score(marked, trees).select(F.max(F.abs(chance - F.col("fraud_probability")))).head()[0]
    assert both < 1e-12
    sizes = marked.select(F.size("rounds")).distinct().collect()
    assert [r[0] for r in sizes] == [trees.stages[-1].getNumTrees]


def test_margins_are_one_function_whatever_the_rounds(inputs, capsys):
    """The plan does not grow with the rounds."""
    model = training._trees(3).fit(inputs.withColumn("_weight", F.lit(1.0)))
    plans = []
    for kept in (1, 3):
        training.with_rounds(inputs, training.first_trees(model, kept), "rounds").explain()
        plans.append(capsys.readouterr().out)
    assert plans[0].count("UDF(") == plans[1].count("UDF(") and "ArrowEvalPython" in plans[0]


def test_margins_of_missing_features_are_those_of_the_model(spark, trained):
    _, trees, test = trained
    broken = test.limit(50).withColumns({name: F.lit(None).cast("double") for name in ("amount_log", "device_mismatch")})
    chance = 1 / (1 + F.exp(-2 * F.element_at("rounds", -1)))
    both = score(training.with_rounds(broken, trees, "rounds"), trees)
    assert both.select(F.max(F.abs(chance - F.col("fraud_probability")))).head()[0] < 1e-12
    assert training.with_rounds(test.limit(0), trees, "rounds").collect() == []


def test_last_margin_comes_without_the_rounds_before(inputs, trained):
    _, trees, test = trained
    both = training.with_margin(training.with_rounds(test, trees, "rounds"), trees, "last")
    assert both.schema["last"].dataType == DoubleType()
    assert both.where(F.col("last") != F.element_at("rounds", -1)).count() == 0 and both.where("last IS NULL").count() == 0
    assert training.with_margin(test.limit(0), trees, "last").collect() == []


def test_margins_are_combined_before_they_leave_the_worker(trained):
    _, trees, test = trained
    rows = test.limit(300).withColumn("is_fraud", F.when(F.col("txn_hour") % 5 > 0, F.col("is_fraud"))).localCheckpoint()
    again = rows.unionByName(rows).coalesce(1)
    rounds, counts = trees.stages[-1].getNumTrees, training._margin_counts(again, trees).collect()
    # Both copies of a row fall on one step, so at most half the margins come out.
    assert len(counts) <= 300 * rounds and len({(r.round, r.step) for r in counts}) == len(counts)
    positives = again.where("is_fraud = 1").count()
    for number in range(rounds):
        own = [r for r in counts if r.round == number]
        assert (sum(r.n for r in own), sum(r.pos for r in own)) == (600, positives)


def test_margins_are_combined_over_batches_of_a_part(spark, trained, monkeypatch):
    _, trees, test = trained
    rows = test.limit(300).localCheckpoint()
    again = rows.unionByName(rows).coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        counts = training._margin_counts(again, trees).collect()
        monkeypatch.setattr(training, "ROWS_COUNTED", 250)
        cut = training._margin_counts(again, trees).groupBy("round", "step").agg(F.sum("pos"), F.sum("n")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len({(r.round, r.step) for r in counts}) == len(counts)
    assert sorted(map(tuple, counts)) == sorted(map(tuple, cut))


def test_dealt_rows_are_kept_while_the_trees_are_fitted(spark, inputs, monkeypatch):
    monkeypatch.setattr(training, "EVEN_FROM", 1000)
    seen, trees = [], training._trees

    class Spy:
        def fit(self, rows):
            seen.append(rows)
            assert rows.storageLevel.useMemory and rows.storageLevel.useDisk
            return trees(2).fit(rows)

    monkeypatch.setattr(training, "_trees", lambda rounds: Spy())
    fit, held = training.split_validation(training.split(inputs)[0])
    assert 1 <= training.train_trees(fit, held, 2).stages[-1].getNumTrees <= 2
    assert len(seen) == 1 and not seen[0].storageLevel.useMemory


def test_both_models_are_fitted_side_by_side(spark, inputs, monkeypatch):
    begun = threading.Event()

    def trees(*args):
        begun.set()
        raise RuntimeError("no trees")

    seen = []
    monkeypatch.setattr(training, "train_trees", trees)
    monkeypatch.setattr(training, "train_logistic", lambda train: seen.append(begun.wait(60)))
    with pytest.raises(RuntimeError, match="no trees"):
        training.train_and_compare(inputs, 5)
    assert seen == [True]


def test_many_rows_are_dealt_out_evenly(spark, monkeypatch):
    rows = spark.range(1000).withColumn("part", F.when(F.col("id") < 900, 0).otherwise(F.col("id"))).repartition(7, "part")
    assert training._evenly(rows) is rows
    monkeypatch.setattr(training, "EVEN_FROM", 1000)
    monkeypatch.setattr(training, "ROWS_PER_PART", 130)
    sizes = training._evenly(rows).groupBy(F.spark_partition_id()).count().collect()
    cores = spark.sparkContext.defaultParallelism
    assert len(sizes) == 2 * cores and max(n for _, n in sizes) - min(n for _, n in sizes) <= 2 * cores
    assert training._evenly(rows).exceptAll(rows).count() == 0


def test_logistic_model_is_at_its_optimum(inputs):
    train, test = training.split(inputs)
    model = training.train_logistic(train)
    slopes = dict(training.logistic_gradient(model, train))
    assert set(slopes) == {*FEATURE_COLUMNS, training.INTERCEPT}
    assert max(abs(slope) for slope in slopes.values()) < 1e-4
    early = training.train_logistic(train, max_iter=2)
    assert max(abs(slope) for _, slope in training.logistic_gradient(early, train)) > 1e-3
    written = score(test, model).select(F.max(F.abs(training.logistic_probability(model) - F.col("fraud_probability"))))
    assert written.head()[0] < 1e-12


def test_model_cut_to_its_first_trees(inputs, trained, tmp_path):
    _, trees, test = trained
    rounds = trees.stages[-1].getNumTrees
    kept = max(rounds - 2, 1)
    cut = training.first_trees(trees, kept)
    assert cut.stages[-1].getNumTrees == kept
    assert cut.stages[-1].treeWeights == trees.stages[-1].treeWeights[:kept]
    strings = [t.toDebugString.split("\n", 1)[1] for t in cut.stages[-1].trees]
    assert strings == [t.toDebugString.split("\n", 1)[1] for t in trees.stages[-1].trees[:kept]]
    training.save_model(cut, str(tmp_path / "cut"))
    again = training.load_model(str(tmp_path / "cut"))
    assert score(test, cut).orderBy("txn_id").collect() == score(test, again).orderBy("txn_id").collect()


@pytest.mark.parametrize("query", [queries.trees_scores, queries.tree_importances, queries.model_report])
def test_registered_queries_fit_all_rounds(spark, monkeypatch, query):
    def asked(rounds):
        raise RuntimeError(f"{rounds} rounds")

    monkeypatch.setattr(queries, "_FITTED", {})
    monkeypatch.setattr(training, "_trees", asked)
    monkeypatch.setattr(training, "train_logistic", lambda train: None)
    with pytest.raises(RuntimeError, match=f"{training.ROUNDS} rounds"):
        query(spark, "/root/testdata/sf0.001")


def test_models_rank_well(trained):
    logistic, trees, test = trained
    first = ranking_measures(score(test, logistic)).head().roc_auc
    second = ranking_measures(score(test, trees)).head().roc_auc
    assert first > 0.8
    assert second >= first - 0.05


def test_reloaded_model_scores_the_same(trained, tmp_path):
    _, trees, test = trained
    training.save_model(trees, str(tmp_path / "model"))
    again = training.load_model(str(tmp_path / "model"))
    before = score(test, trees).orderBy("txn_id").collect()
    assert before == score(test, again).orderBy("txn_id").collect()


def test_importances_sum_to_one(spark, trained):
    rows = training.importances(spark, trained[1]).collect()
    assert {r.feature for r in rows} == set(FEATURE_COLUMNS)
    assert sum(r.importance_gain for r in rows) == pytest.approx(1)
    gains = [r.importance_gain for r in rows]
    assert gains == sorted(gains, reverse=True)


def test_missing_feature_scores_low_instead_of_failing(trained):
    _, trees, test = trained
    logistic = trained[0]
    broken = test.limit(3).withColumn("amount_zscore", F.lit(None).cast("double"))
    rows = score(broken, logistic).collect()
    assert {(r.fraud_flag, r.risk_tier) for r in rows} == {(0, "LOW")}
    assert score(broken, trees).count() == 3


def test_scoring_without_a_feature_fails_early(trained):
    with pytest.raises(ValueError, match="txn_hour"):
        score(trained[2].drop("txn_hour"), trained[0])


def test_model_scores_a_stream_like_a_batch(spark, trained, tmp_path):
    _, trees, test = trained
    test.write.parquet(str(tmp_path / "in"))
    stream = read_stream(spark, str(tmp_path / "in"), test.schema)
    out = append_to_table(score(stream, trees), "model-stream")
    assert out.orderBy("txn_id").collect() == score(test, trees).orderBy("txn_id").collect()
