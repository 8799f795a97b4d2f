"""Training and comparing the two classifiers with MLlib.

The boosted trees follow MLlib: columns are sampled per node instead of per tree.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from paywatch.functions import ratio
from paywatch.plans.decision import RiskDecision, with_decision
from paywatch.plans.evaluation import best_threshold, comparison, threshold_sweep
from paywatch.plans.scoring import require_columns, score
from paywatch.schema import FEATURE_COLUMNS, IMPORTANCES, LABEL
from paywatch.session import materialize, scratch_path

SEED = 42

# The boosted trees' settings.
ROUNDS = 400
DEPTH = 6
LEARNING_RATE = 0.05
ROW_SHARE = 0.8
COLUMN_SHARE = 0.8
PATIENCE = 30

TEST_SHARE = 0.2
VALIDATION_SHARE = 0.1
LOGISTIC = "logistic_regression"
TREES = "boosted_trees"
INTERCEPT = "(intercept)"


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: total, fraud, legit and scale_pos_weight = legit / fraud."""
    fraud = F.sum((F.col(label) == 1).cast("bigint"))
    legit = F.sum((F.col(label) == 0).cast("bigint"))
    return df.agg(
        F.count("*").alias("total"),
        fraud.alias("fraud"),
        legit.alias("legit"),
        ratio(legit, fraud).alias("scale_pos_weight"),
    )


def _hashed_below(row_id: str, share: float, first_digit: int) -> Column:
    """True for about `share` of the ids, always the same ones: eight hex digits of a hash."""
    if not 0 <= share <= 1:
        raise ValueError(f"A share lies between 0 and 1: {share}")
    number = F.conv(F.substring(F.md5(F.col(row_id)), first_digit, 8), 16, 10).cast("bigint")
    return number < F.lit(round(2**32 * share))


def with_split(df: DataFrame, test_share: float = TEST_SHARE, row_id: str = "txn_id") -> DataFrame:
    """Add `is_test`. By hash: needs no sort, and a row keeps its side when rows are added."""
    return df.withColumn("is_test", _hashed_below(row_id, test_share, 1).cast("int"))


#: Hexadecimal digits of the hash that one pass looks at: 65,536 bins a class.
DIGITS = 4


def _cuts(df: DataFrame, share: float, row_id: str, label: str) -> list[tuple[object, str | None]]:
    """(class, cut): the rows of a class whose hash begins with `cut` or less are its share.

    The k-th smallest hash of each class is found digit by digit, without a sort: a histogram
    of the next digits tells the bin that holds it, and the next pass looks into that bin only.
    A pass hands on 65,536 bins a class at most; the bins shrink 65,536-fold each time, so three
    passes do for 10^14 rows.
    """
    hashed = df.select(F.col(label).alias("c"), F.md5(F.coalesce(F.col(row_id), F.lit("")).cast("string")).alias("h"))
    found: dict[object, str | None] = {}
    todo: dict[object, tuple[str, int]] | None = None
    for digits in range(DIGITS, 33, DIGITS):
        rows = hashed
        if todo is not None:
            inside = [F.col("c").eqNullSafe(F.lit(c)) & F.startswith("h", F.lit(prefix)) for c, (prefix, _) in todo.items()]
            rows = hashed.where(functools.reduce(Column.__or__, inside))
        bins = rows.groupBy("c", F.substring("h", 1, digits).alias("bin")).agg(F.count("*").alias("n"))
        in_class = Window.partitionBy("c")
        bins = bins.select(
            "c", "bin", "n", F.sum("n").over(in_class.orderBy("bin")).alias("upto"), F.sum("n").over(in_class).alias("total")
        )
        if todo is None:
            wanted = F.floor(F.col("total") * F.lit(share) + F.lit(0.5))
        else:
            wanted = F.lit(None).cast("bigint")
            for c, (_, rest) in todo.items():
                wanted = F.when(F.col("c").eqNullSafe(F.lit(c)), F.lit(rest)).otherwise(wanted)
        reached = bins.withColumn("wanted", wanted.cast("bigint")).groupBy("c").agg(
            F.min(F.when(F.col("upto") >= F.col("wanted"), F.struct("bin", "upto", "n"))).alias("at"),
            F.max("wanted").alias("wanted"),
        )
        todo = {}
        for row in reached.collect():
            if row.wanted == 0:
                found[row.c] = None
            elif row["at"].upto == row.wanted or digits == 32:
                # Equal hashes are repeated ids, which stay on one side.
                found[row.c] = row["at"].bin
            else:
                todo[row.c] = (row["at"].bin, row.wanted - (row["at"].upto - row["at"].n))
        if not todo:
            break
    return list(found.items())


def with_stratified_split(
    df: DataFrame, test_share: float = TEST_SHARE, row_id: str = "txn_id", label: str = LABEL
) -> DataFrame:
    """Add `is_test`: of every class of `label`, missing included, exactly its share of the
    rows (to the nearest row), those with the smallest hashes of their ids.

    Rows that share an id stay on one side. Reads `df` two to four times, so hand in a
    written table. Shares hold for the table given: a row may change sides when rows are added.
    """
    if not 0 <= test_share <= 1:
        raise ValueError(f"A share lies between 0 and 1: {test_share}")
    digest = F.md5(F.coalesce(F.col(row_id), F.lit("")).cast("string"))
    chosen = F.lit(0)
    for c, cut in _cuts(df, test_share, row_id, label):
        if cut is not None:
            is_test = F.substring(digest, 1, len(cut)) <= F.lit(cut)
            chosen = F.when(F.col(label).eqNullSafe(F.lit(c)), is_test.cast("int")).otherwise(chosen)
    return df.withColumn("is_test", chosen)


def split(
    df: DataFrame, test_share: float = TEST_SHARE, row_id: str = "txn_id", label: str = LABEL
) -> tuple[DataFrame, DataFrame]:
    """(train, test), with the same share of every class."""
    marked = with_stratified_split(df, test_share, row_id, label)
    return (
        marked.where(F.col("is_test") == 0).drop("is_test"),
        marked.where(F.col("is_test") == 1).drop("is_test"),
    )


def split_validation(train: DataFrame, row_id: str = "txn_id") -> tuple[DataFrame, DataFrame]:
    """(fit, validation): rows to choose rounds and threshold on, apart from the test."""
    marked = train.withColumn("_held", _hashed_below(row_id, VALIDATION_SHARE, 9))
    return marked.where(~F.col("_held")).drop("_held"), marked.where("_held").drop("_held")


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="_features", handleInvalid="keep")


def _complete(rows: DataFrame) -> DataFrame:
    """Rows to learn from: label and all features known. Scoring takes every row."""
    return rows.dropna(subset=[LABEL, *FEATURE_COLUMNS])


def _balanced(counts: Row) -> Column:
    """Row weights that give both classes the same sum, and all rows together their number."""
    return F.when(F.col(LABEL) == 1, counts.total / (2 * counts.fraud)).otherwise(
        counts.total / (2 * counts.legit)
    )


def train_logistic(train: DataFrame, max_iter: int = 1000) -> PipelineModel:
    """Standardized logistic regression with balanced classes and unit L2 strength."""
    require_columns(train)
    train = _complete(train)
    counts = class_weights(train).head()
    stages = [
        _assembler(),
        StandardScaler(inputCol="_features", outputCol="_scaled", withMean=True, withStd=True),
        LogisticRegression(
            featuresCol="_scaled",
            labelCol=LABEL,
            weightCol="_weight",
            standardization=False,
            # The weights sum to the number of rows, so this is a penalty of 1
            # against the summed loss.
            regParam=1.0 / counts.total,
            maxIter=max_iter,
        ),
    ]
    return Pipeline(stages=stages).fit(train.withColumn("_weight", _balanced(counts)))


def logistic_terms(model: PipelineModel) -> list[tuple[str, float, float, float]]:
    """(feature, mean, deviation, coefficient) of a fitted logistic model, the intercept last
    with mean 0 and deviation 1."""
    scaler = next(stage for stage in model.stages if isinstance(stage, StandardScalerModel))
    fitted = next(stage for stage in model.stages if isinstance(stage, LogisticRegressionModel))
    numbers = zip(scaler.mean.toArray(), scaler.std.toArray(), fitted.coefficients.toArray())
    terms = [(name, *map(float, three)) for name, three in zip(FEATURE_COLUMNS, numbers)]
    return [*terms, (INTERCEPT, 0.0, 1.0, float(fitted.intercept))]


def _standardised(name: str, mean: float, deviation: float) -> Column:
    if name == INTERCEPT:
        return F.lit(1.0)
    # A constant feature is standardised to 0.
    return (F.col(name).cast("double") - mean) / deviation if deviation else F.lit(0.0)


def logistic_probability(model: PipelineModel) -> Column:
    """The model written out as an expression over the features, for a look at what it does."""
    parts = [_standardised(*term[:3]) * term[3] for term in logistic_terms(model)]
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-functools.reduce(Column.__add__, parts)))


def logistic_gradient(model: PipelineModel, train: DataFrame) -> list[tuple[str, float]]:
    """(feature, slope) of the penalised loss that `train_logistic` minimises, at the fitted
    coefficients: all near 0 at the optimum. One pass, one row."""
    train = _complete(train)
    counts = class_weights(train).head()
    terms = logistic_terms(model)
    error = _balanced(counts) * (logistic_probability(model) - F.col(LABEL)) / counts.total
    sums = train.agg(*[F.sum(error * _standardised(*term[:3])).alias(term[0]) for term in terms]).head()
    return [
        (name, sums[name] + (0.0 if name == INTERCEPT else coefficient / counts.total))
        for name, _, _, coefficient in terms
    ]


def _trees(rounds: int) -> Pipeline:
    return Pipeline(
        stages=[
            _assembler(),
            GBTClassifier(
                featuresCol="_features",
                labelCol=LABEL,
                weightCol="_weight",
                maxIter=rounds,
                maxDepth=DEPTH,
                stepSize=LEARNING_RATE,
                subsamplingRate=ROW_SHARE,
                featureSubsetStrategy=str(COLUMN_SHARE),
                seed=SEED,
            ),
        ]
    )


def rounds_to_keep(areas: Sequence[float], patience: int = PATIENCE) -> int:
    """Rounds up to the largest area, looking no further than `patience` rounds past it."""
    best = 0
    for i, area in enumerate(areas):
        if area > areas[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def first_trees(model: PipelineModel, kept: int) -> PipelineModel:
    """The fitted model cut to its first trees."""
    *before, trees = model.stages
    gateway, old = SparkContext._gateway, trees._java_obj
    ml = gateway.jvm.org.apache.spark.ml
    cut = gateway.new_array(ml.regression.DecisionTreeRegressionModel, kept)
    weights = gateway.new_array(gateway.jvm.double, kept)
    fitted, steps = old.trees(), old.treeWeights()
    for i in range(kept):
        cut[i], weights[i] = fitted[i], steps[i]
    new = ml.classification.GBTClassificationModel(
        trees.uid, cut, weights, trees.numFeatures, trees.numClasses
    )
    old.copyValues(new, old.extractParamMap())
    return PipelineModel([*before, GBTClassificationModel._from_java(new)])


#: Trees and rows whose ways down are followed side by side, and rows whose margins are counted together.
TREES_AT_ONCE, ROWS_AT_ONCE, ROWS_COUNTED = 25, 4096, 65_536


def tree_nodes(spark: SparkSession, ensemble: GBTClassificationModel) -> tuple[np.ndarray, ...]:
    """(roots, feature, threshold, left, right, step) of all nodes, tree after tree, from the table
    of nodes that MLlib saves: a few hundred small trees. A leaf leads to itself."""
    path = scratch_path(spark, "tree-nodes")
    ensemble.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    # A tree's nodes are numbered from 0 without gaps.
    roots = np.array([place for place, node in enumerate(nodes) if node.id == 0])
    feature, threshold = np.zeros(len(nodes), np.int32), np.full(len(nodes), np.inf)
    left = np.arange(len(nodes))
    right, weights = left.copy(), ensemble.treeWeights
    step = np.array([node.prediction * float(weights[node.treeID]) for node in nodes])
    for place, node in enumerate(nodes):
        if node.leftChild >= 0:
            if node.split.numCategories >= 0:
                raise ValueError("The trees' features are numbers, not categories")
            feature[place], (threshold[place],) = node.split.featureIndex, node.split.leftCategoriesOrThreshold
            left[place], right[place] = roots[node.treeID] + (node.leftChild, node.rightChild)
    return roots, feature, threshold, left, right, step


def _margins_of(spark: SparkSession, ensemble: GBTClassificationModel) -> Callable[[np.ndarray], Iterator[np.ndarray]]:
    """A function of rows of features that gives the margins after each round, some rounds at a time, a line
    a round: running sums over the trees. All it needs goes with it, so workers need no package of ours."""
    roots, feature, threshold, left, right, step = tree_nodes(spark, ensemble)
    depth, wide = max(tree.depth for tree in ensemble.trees), ensemble.numFeatures
    ways = np.stack([right, left], axis=1).ravel()

    def margins(asked: np.ndarray) -> Iterator[np.ndarray]:
        before = np.zeros(len(asked))
        for tree in range(0, len(roots), TREES_AT_ONCE):
            own = roots[tree : tree + TREES_AT_ONCE, None]
            sums = np.empty((len(own), len(asked)))
            for i in range(0, len(asked), ROWS_AT_ONCE):
                values = asked[i : i + ROWS_AT_ONCE].ravel()
                rows = np.arange(0, len(values), wide)
                node = np.repeat(own, len(rows), axis=1)
                for _ in range(depth):
                    # A missing feature goes right.
                    goes_left = values.take(feature.take(node) + rows) <= threshold.take(node)
                    node = ways.take(2 * node + goes_left)
                sums[:, i : i + ROWS_AT_ONCE] = step.take(node)
            sums[0] += before
            sums = np.cumsum(sums, axis=0)
            before = sums[-1]
            yield sums

    return margins


def _asked(df: DataFrame, model: PipelineModel) -> tuple[DataFrame, GBTClassificationModel, Column]:
    """The rows with the model's columns before its trees, the trees, and their features as an array."""
    *before, ensemble = (stage for stage in model.stages if not isinstance(stage, RiskDecision))
    return PipelineModel(before).transform(df), ensemble, vector_to_array(ensemble.getFeaturesCol())


def with_rounds(df: DataFrame, model: PipelineModel, out: str) -> DataFrame:
    """Add the margin after each round of boosting, as an array.

    Every tree is asked once per row, many rows and trees at a time; the probability after a
    round is 1 / (1 + exp(-2 margin)).
    """
    asked, ensemble, features = _asked(df, model)
    margins, rounds, wide = _margins_of(df.sparkSession, ensemble), ensemble.getNumTrees, ensemble.numFeatures

    @F.arrow_udf(ArrayType(DoubleType()))
    def of(features: pa.Array) -> pa.Array:
        asked = features.flatten().to_numpy(zero_copy_only=False).reshape(len(features), wide)
        ends = np.arange(len(features) + 1, dtype=np.int32) * rounds
        sums = np.concatenate(list(margins(asked)))
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(sums.T.ravel()))

    return asked.withColumn(out, of(features)).select(*df.columns, out)


def with_margin(df: DataFrame, model: PipelineModel, out: str) -> DataFrame:
    """Add the margin after the last round: that of `with_rounds` without the rounds before it,
    which would leave the worker as a number a row and tree."""
    asked, ensemble, features = _asked(df, model)
    margins, wide = _margins_of(df.sparkSession, ensemble), ensemble.numFeatures

    @F.arrow_udf(DoubleType())
    def of(features: pa.Array) -> pa.Array:
        asked = features.flatten().to_numpy(zero_copy_only=False).reshape(len(features), wide)
        for sums in margins(asked):
            last = sums[-1]
        return pa.array(last)

    return asked.withColumn(out, of(features)).select(*df.columns, out)


#: Margins closer than this count as equal when rounds are compared.
MARGIN_STEP = 1e-4


def _margin_counts(held: DataFrame, model: PipelineModel) -> DataFrame:
    """(round, step, pos, n): positives and rows per round and margin in steps of `MARGIN_STEP`,
    combined within `ROWS_COUNTED` rows of a part, whatever batches they come in; a step may come once each."""
    asked, ensemble, features = _asked(held, model)
    margins, wide = _margins_of(held.sparkSession, ensemble), ensemble.numFeatures
    width, together = MARGIN_STEP, ROWS_COUNTED

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(waiting: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            positive = rows.column("positive").to_numpy(zero_copy_only=False)
            first = 0
            for part in margins(rows.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, wide)):
                steps = part / width
                # Step and label in one number: sorted, the rows of a step lie side by side.
                keys = np.trunc(steps + np.copysign(0.5, steps)).astype(np.int64) * 2 + positive
                keys.sort(axis=1)
                starts = np.ones(keys.shape, bool)
                starts[:, 1:] = keys[:, 1:] >> 1 != keys[:, :-1] >> 1
                at, keys = np.flatnonzero(starts), keys.ravel()
                found = [first + at // part.shape[1], keys[at] >> 1, np.add.reduceat(keys & 1, at), np.diff(at, append=len(keys))]
                yield pa.RecordBatch.from_arrays([pa.array(each) for each in found], ["round", "step", "pos", "n"])
                first += len(part)

        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if sum(map(len, waiting)) + len(batch) > together and waiting:
                yield from of(waiting)
                waiting = []
            if len(batch):
                waiting.append(batch)
        if waiting:
            yield from of(waiting)

    positive = F.coalesce((F.col(LABEL) == 1).cast("int"), F.lit(0))
    asked = asked.select(positive.alias("positive"), features.alias("features"))
    return asked.mapInArrow(counted, "round long, step long, pos long, n long")


def areas_by_round(held: DataFrame, model: PipelineModel) -> list[float]:
    """Average precision on the held rows after each round, all from one pass over them.

    Margins are taken in steps of `MARGIN_STEP`, so that what leaves a task is bounded by
    their range, not by the rows; rows within a step count as tied.
    """
    each = _margin_counts(held.select(LABEL, *FEATURE_COLUMNS), model)
    counts = each.groupBy("round", "step").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    above = Window.partitionBy("round").orderBy(F.desc("step"))
    reached = counts.select("round", "pos", F.sum("pos").over(above).alias("tp"), F.sum("n").over(above).alias("of"))
    areas = reached.groupBy("round").agg(
        F.coalesce(F.try_divide(F.sum(F.col("pos") * F.col("tp") / F.col("of")), F.sum("pos")), F.lit(0.0)).alias("area")
    )
    return [row.area for row in areas.orderBy("round").collect()]


#: Rows from which on they are dealt out evenly for the rounds, and the most in a part.
EVEN_FROM = ROWS_PER_PART = 1_000_000


def _evenly(rows: DataFrame) -> DataFrame:
    """Many rows in equal parts, as many as there are cores or a multiple: every pass of the
    boosting waits for its largest part. Sorted, so that a part lost is made again the same, and
    kept, as MLlib asks for its rows several times before it holds them itself."""
    count = rows.count()
    if count < EVEN_FROM:
        return rows
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = cores * -(-count // (cores * ROWS_PER_PART))
    return rows.repartition(parts).sortWithinPartitions(*rows.columns).persist()


def train_trees(
    train: DataFrame,
    validation: DataFrame,
    rounds: int = ROUNDS,
    pos_weight: float | None = None,
) -> PipelineModel:
    """Boosted trees; the rounds kept are those with the best average precision on the
    validation rows.

    All rounds are fitted once, and the model is cut to its first trees.
    """
    require_columns(train)
    train, validation = _complete(train), _complete(validation)
    if pos_weight is None:
        pos_weight = class_weights(train).head().scale_pos_weight
    weight = F.when(F.col(LABEL) == 1, F.lit(float(pos_weight))).otherwise(F.lit(1.0))
    weighted = train.select(LABEL, *FEATURE_COLUMNS).withColumn("_weight", weight)
    dealt = _evenly(weighted)
    try:
        model = _trees(rounds).fit(dealt)
    finally:
        if dealt is not weighted:
            dealt.unpersist()
    # No validation row: nothing speaks against any round.
    areas = areas_by_round(validation, model)
    kept = rounds_to_keep(areas) if areas else rounds
    return model if kept == rounds else first_trees(model, kept)


def importances(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature, importance_gain), strongest first; the gains sum to 1."""
    trees = next(stage for stage in model.stages if hasattr(stage, "featureImportances"))
    gains = trees.featureImportances.toArray()
    rows = [(name, float(gain)) for name, gain in zip(FEATURE_COLUMNS, gains)]
    return spark.createDataFrame(rows, IMPORTANCES).orderBy(
        F.desc("importance_gain"), F.asc("feature")
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


@dataclass(frozen=True)
class Training:
    """What a training run leaves behind. The trees carry their threshold."""

    logistic: PipelineModel
    trees: PipelineModel
    threshold: float
    importances: DataFrame
    report: DataFrame


def train_and_compare(features: DataFrame, rounds: int = ROUNDS) -> Training:
    """Both models, the trees' threshold, importances and the comparison report.

    Rounds and threshold are chosen on validation rows; the test rows are used
    for the final measures only. The model inputs are written once, since every
    iteration reads them.
    """
    spark = features.sparkSession
    inputs = materialize(features.select("txn_id", LABEL, *FEATURE_COLUMNS), "model-inputs")
    pos_weight = class_weights(inputs).head().scale_pos_weight
    train, test = split(inputs)
    fit, validation = split_validation(train)

    with ThreadPoolExecutor(1) as beside:
        # A round of boosting is six short passes, between which cores stand idle: the other fit takes those.
        fitting = beside.submit(inheritable_thread_target(spark)(train_logistic), train)
        trees = train_trees(fit, validation, rounds, pos_weight)
        logistic = fitting.result()
    threshold = best_threshold(threshold_sweep(score(validation, trees))).head().threshold
    trees = with_decision(trees, threshold)
    strengths = importances(spark, trees)
    report = comparison(
        {LOGISTIC: score(test, logistic), TREES: score(test, trees)},
        {LOGISTIC: 0.5, TREES: threshold},
        strengths,
    )
    return Training(logistic, trees, threshold, strengths, report)
