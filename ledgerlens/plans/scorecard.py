"""Predictions and explanations of the additive rule score, and evaluation of any probability.

The composite score is a sum of five terms, so its terms are its exact attributions. It serves as a
model that needs no training: same output tables as the learned one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.measures import ratio, rounded
from ledgerlens.functions.risk import model_tier
from ledgerlens.functions.text import contributions, driver_text
from ledgerlens.operators.prefix import running_totals
from ledgerlens.plans.features import SCORE_WEIGHTS, score_terms

_c = F.col
THRESHOLD = 0.5


def predictions(scored: DataFrame, probability: str = "fraud_probability") -> DataFrame:
    """The prediction table of any probability column: id, probability, 0/1 prediction, tier."""
    p = _c(probability)
    return scored.select(
        "transaction_id", p.alias("fraud_probability"),
        (p >= THRESHOLD).cast("int").alias("fraud_prediction"), model_tier(p).alias("risk_tier"))


def rule_probability(features: DataFrame) -> DataFrame:
    return features.withColumn("fraud_probability", _c("composite_risk_score") / 100)


def rule_predictions(features: DataFrame) -> DataFrame:
    return predictions(rule_probability(features))


def rule_explanations(features: DataFrame, top: int = 3) -> DataFrame:
    """Terms of the rule score per transaction and the ``top`` strongest as text."""
    names = list(SCORE_WEIGHTS)
    terms = [t.alias(f"term_{n}") for n, t in zip(names, score_terms(null_safe=True))]
    listed = rule_probability(features).select("transaction_id", "fraud_probability", *terms)
    return listed.select(
        "transaction_id", *[_c(f"term_{n}").alias(n) for n in names],
        _c("fraud_probability").alias("predicted_fraud_prob"),
        (_c("fraud_probability") >= THRESHOLD).cast("int").alias("predicted_label"),
        driver_text(contributions(names, [_c(f"term_{n}") for n in names]), top).alias("top_fraud_drivers"),
    )


def classification_report(scored: DataFrame, probability: str = "fraud_probability",
                          label: str = "label") -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted means.

    The data shrinks to the four cells of the confusion matrix in one pass.
    """
    predicted = (F.coalesce(_c(probability), F.lit(0.0)) >= THRESHOLD).cast("int")
    actual = _c(label)
    cells = scored.agg(*[
        F.count_if((actual == a) & (predicted == b)).cast("double").alias(f"a{a}p{b}")
        for a in (0, 1) for b in (0, 1)])

    def line(name: str, hit: str, missed: str, wrongly: str) -> Column:
        tp, fn, fp = _c(hit), _c(missed), _c(wrongly)
        zero = F.lit(0.0)
        return F.struct(
            F.lit(name).alias("class_name"),
            F.coalesce(F.try_divide(tp, tp + fp), zero).alias("precision"),
            F.coalesce(F.try_divide(tp, tp + fn), zero).alias("recall"),
            F.coalesce(F.try_divide(tp * 2, tp * 2 + fp + fn), zero).alias("f1"),
            (tp + fn).cast("long").alias("support"))

    both = cells.select("*", line("Legit", "a0p0", "a0p1", "a1p0").alias("legit"),
                        line("Fraud", "a1p1", "a1p0", "a0p1").alias("fraud"))
    total = _c("legit.support") + _c("fraud.support")
    accuracy = F.try_divide(_c("a0p0") + _c("a1p1"), total.cast("double"))

    def mean(measure: str, weighted: bool) -> Column:
        a, b = _c(f"legit.{measure}"), _c(f"fraud.{measure}")
        if weighted:
            return F.try_divide(a * _c("legit.support") + b * _c("fraud.support"), total.cast("double"))
        return (a + b) / 2

    def summary(name: str, weighted: bool) -> Column:
        return F.struct(F.lit(name).alias("class_name"), mean("precision", weighted).alias("precision"),
                        mean("recall", weighted).alias("recall"), mean("f1", weighted).alias("f1"),
                        total.alias("support"))

    rows = F.array(
        "legit", "fraud",
        F.struct(F.lit("accuracy").alias("class_name"), accuracy.alias("precision"),
                 accuracy.alias("recall"), accuracy.alias("f1"), total.alias("support")),
        summary("macro avg", False), summary("weighted avg", True))
    return both.select(F.inline(rows)).select(
        "class_name", *[rounded(m, 6).alias(m) for m in ("precision", "recall", "f1")], "support")


def _per_score(scored: DataFrame, probability: str, label: str, descending: bool = False) -> DataFrame:
    """``p`` (negated for descending order), ``pos`` and ``neg`` per distinct probability, with its coarse and fine
    slice: running totals go slice by slice, so no task orders all distinct probabilities."""
    p = F.coalesce(_c(probability), F.lit(0.0))
    return scored.select((-p if descending else p).alias("p"), _c(label).alias("y")).groupBy(
        F.floor(_c("p") * 1000).alias("slice"), F.floor(_c("p") * 10_000_000).alias("part"), "p").agg(
        F.count_if(_c("y") == 1).alias("pos"), F.count_if(_c("y") == 0).alias("neg")).withColumn("all", F.lit(0))


def roc_auc(scored: DataFrame, probability: str = "fraud_probability", label: str = "label") -> DataFrame:
    """Exact area under the ROC curve, ties counted half."""
    # constant key: the order is over all rows, one slice per task
    ordered = running_totals(_per_score(scored, probability, label).withColumn("upto", _c("neg")), ["all"],
                             ["slice", "part", "p"], ["upto"])
    big = "decimal(19,0)"
    # twice the number of correctly ordered pairs, an exact integer
    twice = F.sum((_c("pos").cast(big) * (_c("upto") * 2 - _c("neg")).cast(big)).cast("decimal(38,0)"))
    return ordered.agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), twice.alias("twice"),
    ).select(
        "positives", "negatives",
        rounded(F.try_divide(_c("twice").cast("double"),
                             _c("positives").cast("double") * _c("negatives").cast("double") * 2), 8)
        .alias("roc_auc"))


def pr_auc(scored: DataFrame, probability: str = "fraud_probability", label: str = "label") -> DataFrame:
    """Area under the precision-recall curve, over every distinct probability: ``pr_auc`` by trapezoids, the curve
    going level from recall 0 to its first point, and ``average_precision`` by steps. NULL without positives."""
    totals = running_totals(
        _per_score(scored, probability, label, descending=True).withColumns({"tp": _c("pos"), "fp": _c("neg")}),
        ["all"], ["slice", "part", "p"], ["tp", "fp"])
    here = F.try_divide(_c("tp").cast("double"), (_c("tp") + _c("fp")).cast("double"))
    above = F.try_divide((_c("tp") - _c("pos")).cast("double"), (_c("tp") - _c("pos") + _c("fp") - _c("neg")).cast("double"))
    # sums of decimals, so that they do not depend on the order of the rows
    summed = lambda x: F.sum((x * _c("pos")).cast("decimal(38,12)")).cast("double")
    return totals.agg(
        F.sum("pos").alias("positives"), summed((here + F.coalesce(above, here)) / 2).alias("area"),
        summed(here).alias("steps"),
    ).select("positives", *[rounded(F.try_divide(_c(x), _c("positives").cast("double")), 8).alias(name)
                            for x, name in (("area", "pr_auc"), ("steps", "average_precision"))])


def prediction_invariants(predictions: DataFrame) -> DataFrame:
    """What must hold for every prediction table: rows, distinct ids, and rows that break a rule of the table."""
    p = _c("fraud_probability")
    return predictions.agg(
        F.count(F.lit(1)).alias("scored"), F.countDistinct("transaction_id").alias("ids"),
        F.count_if(p.isNull() | (p < 0) | (p > 1)).alias("outside"),
        F.count_if(_c("fraud_prediction") != (p >= THRESHOLD).cast("int")).alias("wrong_prediction"),
        F.count_if(~_c("risk_tier").eqNullSafe(model_tier(p))).alias("wrong_tier"))
