"""Model inputs, train/test split, boosted-tree training and scoring on MLlib."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.measures import ratio, rounded
from ledgerlens.operators.boosting import fit, tasks_at_once
from ledgerlens.operators.prefix import positions
from ledgerlens.operators.scoring import with_probability
from ledgerlens.plans import scorecard

_c = F.col

# ---- fixed values: model inputs, target and training parameters --------------------------------
FEATURES = (
    "amount", "txn_hour", "is_international", "is_high_value", "is_odd_hour", "is_declined",
    "is_round_amount", "txn_count_1h", "txn_count_24h", "txn_count_7d", "amount_sum_1h",
    "amount_sum_24h", "amount_avg_7d", "amount_zscore", "geo_risk_score", "channel_risk",
    "composite_risk_score", "is_high_velocity", "risk_score",
)
TARGET = "label"
SEED = 42
TRAIN_PERCENT = 80
# ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Boosting:
    """Training parameters. Columns are sampled per node here, not per tree."""

    rounds: int = 300
    depth: int = 6
    step: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    bins: int = 64
    seed: int = SEED
    # Training ends when a share of the training rows, held back, gets better by less than this (None: all rounds).
    stop_below: float | None = None
    held_back_percent: int = 10


def matrix(features: DataFrame) -> DataFrame:
    """Id, the model inputs as doubles with 0 for missing, and the label."""
    return features.select(
        "transaction_id", *[F.coalesce(_c(f).cast("double"), F.lit(0.0)).alias(f) for f in FEATURES],
        F.coalesce(_c(TARGET), F.lit(0)).alias(TARGET))


def _digest(seed: int) -> Column:
    return F.md5(F.concat("transaction_id", F.lit(f":{seed}")))


def split(rows: DataFrame, seed: int = SEED, train_percent: int = TRAIN_PERCENT) -> DataFrame:
    """Adds ``split``: each row by a hash of its id, so repeatable, row by row, without a shuffle.

    Every class gets the same share in expectation; at scale the difference vanishes.
    """
    bucket = F.conv(F.substring(_digest(seed), 1, 8), 16, 10).cast("long") % 100
    return rows.withColumn("split", F.when(bucket < train_percent, "train").otherwise("test"))


def split_exact(rows: DataFrame, seed: int = SEED, train_percent: int = TRAIN_PERCENT) -> DataFrame:
    """Adds ``split`` with exactly the train share (rounded down) of every class.

    Rows of a class are ordered by their hash. Positions come from counts per hash prefix, so no task
    sorts a whole class.
    """
    hashed = rows.withColumns({
        "_digest": _digest(seed), "_prefix": F.substring(_digest(seed), 1, 3), "_longer": F.substring(_digest(seed), 1, 6)})
    placed = positions(hashed, [TARGET], ["_prefix", "_longer", "_digest"], "transaction_id", "_place")
    # one row per class
    sizes = rows.groupBy(_c(TARGET).alias("_class")).agg(F.count(F.lit(1)).alias("_n"))
    return (
        placed.join(F.broadcast(sizes), _c(TARGET).eqNullSafe(_c("_class")))
        .withColumn("split", F.when(_c("_place") <= F.floor(_c("_n") * (train_percent / 100)), "train")
                    .otherwise("test"))
        .drop("_digest", "_prefix", "_longer", "_place", "_n", "_class")
    )


def class_balance(rows: DataFrame) -> DataFrame:
    """Class counts per split and the weight that evens the classes out."""
    return rows.groupBy("split").agg(
        F.count_if(_c(TARGET) == 0).alias("negatives"), F.count_if(_c(TARGET) == 1).alias("positives"),
    ).withColumn("positive_weight", rounded(ratio("negatives", "positives"), 6))


def train(rows: DataFrame, params: Boosting = Boosting()) -> PipelineModel:
    """Fit on the train part of ``matrix`` + ``split`` rows; positives weigh as much as negatives.

    The trees are grown from histograms by tasks that run side by side (``operators.boosting``), or by MLlib where
    executors come and go; no rows leave the executors. With ``stop_below`` rows held back by a hash are followed and
    end the training early; ``follow`` gives the loss of each round on any rows.
    """
    balance = class_balance(rows.where("split = 'train'")).first()
    if balance is None:
        raise ValueError("there are no rows to train on")
    weight = 1.0 if balance["positive_weight"] is None else float(balance["positive_weight"])
    weighted = rows.where("split = 'train'").withColumn(
        "weight", F.when(_c(TARGET) == 1, F.lit(weight)).otherwise(F.lit(1.0))).withColumn(TARGET, _c(TARGET).cast("double"))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="inputs")
    trees = GBTClassifier(
        featuresCol="inputs", labelCol=TARGET, weightCol="weight", maxIter=params.rounds, maxDepth=params.depth,
        stepSize=params.step, subsamplingRate=params.row_share, featureSubsetStrategy=str(params.column_share),
        maxBins=params.bins, seed=params.seed, cacheNodeIds=False)
    if params.stop_below is not None:
        aside = F.conv(F.substring(_digest(params.seed + 1), 1, 8), 16, 10).cast("long") % 100 < params.held_back_percent
        weighted = weighted.withColumn("held_back", aside)
        trees.set(trees.validationIndicatorCol, "held_back")
        trees.set(trees.validationTol, params.stop_below)
    if not tasks_at_once(rows.sparkSession):
        return Pipeline(stages=[assembler, trees]).fit(weighted)
    count = balance["negatives"] + balance["positives"]
    return PipelineModel([assembler, fit(weighted, FEATURES, "transaction_id", count, weight, trees)])


def signature() -> dict[str, str]:
    """Names and types of what the model takes and gives."""
    return {**{f: "double" for f in FEATURES}, "fraud_probability": "double"}


def save(model: PipelineModel, path: str) -> None:
    """The model and, beside it, its signature as a table."""
    model.write().overwrite().save(path)
    spark = SparkSession.active()
    spark.createDataFrame(list(signature().items()), "name string, type string").coalesce(1).write.mode(
        "overwrite").parquet(f"{path}-signature")


def check_inputs(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Raise if rows lack an input of the saved model or have it in another type."""
    types = dict(rows.dtypes)
    wanted = {r["name"]: r["type"] for r in spark.read.parquet(f"{path}-signature").collect()}  # a row an input
    wrong = [n for n, t in wanted.items() if n in FEATURES and types.get(n) != t]
    if wrong:
        raise ValueError(f"inputs missing or of another type: {', '.join(sorted(wrong))}")


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """All rows with the probability of fraud."""
    return with_probability(model.stages[-1], rows, FEATURES, "fraud_probability")


def model_predictions(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """The prediction table: id, probability, 0/1 prediction, tier."""
    return scorecard.predictions(score(model, rows.select("transaction_id", *FEATURES)))


def follow(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``round, log_loss``: the mean logistic loss on the rows (label -1 or 1, twice the margin) after each round, in
    one pass over them."""
    *before, trees = model.stages
    inputs = rows.withColumns({TARGET: _c(TARGET).cast("double"), "weight": F.lit(1.0)})
    for stage in before:
        inputs = stage.transform(inputs)
    losses = trees.evaluateEachIteration(inputs)  # a number a round
    return rows.sparkSession.createDataFrame(list(enumerate(losses, 1)), "round int, log_loss double")


def evaluate(model: PipelineModel, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classification report and ROC-AUC on the test part."""
    scored = score(model, rows.where("split = 'test'"))
    return scorecard.classification_report(scored), scorecard.roc_auc(scored)
