"""The last stage of a fraud model: from probability to flag and risk tier.

It is saved and loaded with the model, so the threshold tuned for a model is the one
it is used with."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywatch.functions import present, risk_tier

# Fixed value: probability from which a transaction is flagged.
DEFAULT_THRESHOLD = 0.50


def with_risk(df: DataFrame, probability: Column, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Add probability, flag (inclusive threshold) and tier; NaN counts as no probability."""
    return df.withColumn("fraud_probability", present(probability)).withColumns(
        {
            "fraud_flag": F.when(F.col("fraud_probability") >= threshold, 1).otherwise(0),
            "risk_tier": risk_tier(F.col("fraud_probability")),
        }
    )


class RiskDecision(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds fraud_probability, fraud_flag and risk_tier from a column of class probabilities,
    or of the probability of fraud alone."""

    threshold = Param(Params._dummy(), "threshold", "probability from which a payment is flagged", TypeConverters.toFloat)
    probabilityCol = Param(Params._dummy(), "probabilityCol", "class probabilities", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, threshold: float = DEFAULT_THRESHOLD, probabilityCol: str = "probability"):  # noqa: N803
        super().__init__()
        self._setDefault(threshold=DEFAULT_THRESHOLD, probabilityCol="probability")
        given = self._input_kwargs
        if not 0 <= given.get("threshold", DEFAULT_THRESHOLD) <= 1:
            raise ValueError(f"A threshold lies between 0 and 1: {given['threshold']}")
        self._set(**given)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        name = self.getOrDefault(self.probabilityCol)
        chance = F.col(name)
        if isinstance(dataset.schema[name].dataType, VectorUDT):
            chance = vector_to_array(chance).getItem(1)
        return with_risk(dataset, chance, self.getOrDefault(self.threshold))


def with_decision(model: PipelineModel, threshold: float) -> PipelineModel:
    """The model with this threshold in place of any it had."""
    return PipelineModel([*_without(model), RiskDecision(threshold=float(threshold))])


def threshold_of(model: PipelineModel) -> float:
    """The threshold that came with the model, else the default."""
    found = [s.getOrDefault(s.threshold) for s in model.stages if isinstance(s, RiskDecision)]
    return found[-1] if found else DEFAULT_THRESHOLD


def _without(model: PipelineModel) -> list[Transformer]:
    return [stage for stage in model.stages if not isinstance(stage, RiskDecision)]


def decided(features: DataFrame, model: PipelineModel, threshold: float | None = None) -> DataFrame:
    """All columns of the model and its decision; `threshold` overrides the model's own."""
    chosen = threshold_of(model) if threshold is None else threshold
    return with_decision(model, chosen).transform(features)
