"""The explanation table of the trained model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.text import contributions, driver_text
from ledgerlens.operators.treeshap import attribute, baseline, read_leaves
from ledgerlens.plans.model import FEATURES, score
from ledgerlens.plans.scorecard import THRESHOLD

_c = F.col


def explanations(spark: SparkSession, model: PipelineModel, model_path: str, rows: DataFrame,
                 only_flagged: bool = False, top: int = 3) -> DataFrame:
    """Contribution of each model input to the log-odds of every row, and the strongest as text.

    ``only_flagged`` narrows it to rows the model predicts fraudulent, the ones that must be explained.
    """
    scored = score(model, rows.select("transaction_id", *FEATURES))
    if only_flagged:
        scored = scored.where(_c("fraud_probability") >= THRESHOLD)
    leaves = read_leaves(spark, model, model_path)
    attributed = attribute(spark, scored, FEATURES, leaves, ["transaction_id", "fraud_probability"])
    return attributed.select(
        *FEATURES, "transaction_id", _c("fraud_probability").alias("predicted_fraud_prob"),
        (_c("fraud_probability") >= THRESHOLD).cast("int").alias("predicted_label"),
        driver_text(contributions(FEATURES), top).alias("top_fraud_drivers"))


def additivity(spark: SparkSession, model: PipelineModel, model_path: str, explained: DataFrame,
               tolerance: float = 1e-6) -> DataFrame:
    """Rows of the explanation table, and how many of them do not add up to the log-odds of their probability."""
    total = sum((_c(f) for f in FEATURES), F.lit(baseline(read_leaves(spark, model, model_path))))
    p = _c("predicted_fraud_prob")
    off = F.abs(total - F.log(p / (1 - p))) > tolerance
    return explained.agg(F.count(F.lit(1)).alias("explained"), F.count_if(off | off.isNull()).alias("off"))
