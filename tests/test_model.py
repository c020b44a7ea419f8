"""Training, persistence and tree attributions."""

from __future__ import annotations

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from ledgerlens.operators.treeshap import Leaf, attribute, baseline, read_leaves
from ledgerlens.plans import explain, model
from ledgerlens.session import shared_folder


@pytest.fixture(scope="module")
def trained(spark, folder):
    rows = model.split(model.matrix(entry_point._warehouse(spark, folder).gold("ml_features"))).cache()
    path = shared_folder(spark, "model")
    model.save(model.train(rows, model.Boosting(rounds=6, depth=4)), path)
    return rows, model.load(path), path


def shapley(leaves, x, n):
    """Straight from the definition, over all subsets of each leaf's features."""
    phi = np.zeros(n)
    for leaf in leaves:
        d = len(leaf.features)
        on = [float(a < x[f] <= u) for f, a, u in zip(leaf.features, leaf.above, leaf.upto)]
        for i in range(d):
            rest = [j for j in range(d) if j != i]
            for size in range(d):
                for chosen in combinations(rest, size):
                    chance = factorial(size) * factorial(d - size - 1) / factorial(d)
                    reach = np.prod([on[j] if j in chosen else leaf.shares[j] for j in rest])
                    phi[leaf.features[i]] += chance * leaf.value * reach * (on[i] - leaf.shares[i])
    return phi


def test_contributions_add_up_to_the_prediction(spark, trained):
    rows, fitted, path = trained
    out = explain.explanations(spark, fitted, path, rows)
    assert len(out.columns) == 23 and out.count() == rows.count()
    total = sum((F.col(f) for f in model.FEATURES), F.lit(baseline(read_leaves(spark, fitted, path))))
    gap = out.select(F.max(F.abs(1 / (1 + F.exp(-total)) - F.col("predicted_fraud_prob")))).first()[0]
    assert gap < 1e-9


def test_contributions_equal_the_definition(spark, trained):
    rows, fitted, path = trained
    leaves = read_leaves(spark, fitted, path)
    out = {r.transaction_id: r for r in explain.explanations(spark, fitted, path, rows).collect()}
    for row in rows.orderBy("transaction_id").take(5):
        expected = shapley(leaves, [row[f] for f in model.FEATURES], len(model.FEATURES))
        assert [out[row.transaction_id][f] for f in model.FEATURES] == pytest.approx(expected, abs=1e-9)


def test_hand_made_tree(spark):
    """x0 <= 1 ? 2 : (x1 <= 5 ? 4 : 8), half of the rows on each side of each split."""
    inf = float("inf")
    leaves = [Leaf(2.0, (0,), (-inf,), (1.0,), (0.5,)),
              Leaf(4.0, (0, 1), (1.0, -inf), (inf, 5.0), (0.5, 0.5)),
              Leaf(8.0, (0, 1), (1.0, 5.0), (inf, inf), (0.5, 0.5))]
    assert baseline(leaves) == 4.0
    rows = spark.createDataFrame([("r", 2.0, 9.0)], "id string, x0 double, x1 double")
    got = attribute(spark, rows, ["x0", "x1"], leaves, ["id"]).first()
    assert (got.x0, got.x1) == pytest.approx((2.5, 1.5))


def test_predictions_table(spark, trained):
    rows, fitted, _ = trained
    out = model.model_predictions(fitted, rows)
    assert out.columns == ["transaction_id", "fraud_probability", "fraud_prediction", "risk_tier"]
    assert out.where("fraud_probability is null or not fraud_probability between 0 and 1").count() == 0
    report, auc = model.evaluate(fitted, rows)
    assert report.count() == 5 and 0 <= auc.first().roc_auc <= 1


def test_only_flagged_rows_can_be_explained(spark, trained):
    rows, fitted, path = trained
    flagged = explain.explanations(spark, fitted, path, rows, only_flagged=True)
    assert flagged.where("predicted_label = 0").count() == 0
    assert flagged.count() == model.model_predictions(fitted, rows).where("fraud_prediction = 1").count()


def test_area_under_precision_recall_equals_mllib(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from ledgerlens.plans import scorecard

    rng = np.random.default_rng(3)
    scores = [(float(s), int(y)) for s, y in zip(rng.integers(0, 40, 500) / 40, rng.random(500) < 0.3)]
    rows = spark.createDataFrame(scores, "fraud_probability double, label int")
    ours = scorecard.pr_auc(rows).first()
    library = BinaryClassificationEvaluator(rawPredictionCol="fraud_probability", labelCol="label",
                                            metricName="areaUnderPR", numBins=0)
    assert ours.pr_auc == pytest.approx(library.evaluate(rows.withColumn("label", F.col("label").cast("double"))), abs=1e-8)
    perfect = rows.withColumn("fraud_probability", F.col("label").cast("double"))
    assert (scorecard.pr_auc(perfect).first().pr_auc, scorecard.pr_auc(perfect).first().average_precision) == (1.0, 1.0)
    assert scorecard.pr_auc(rows.where("label = 0")).first().pr_auc is None


def test_followed_rows_and_early_stop(spark, trained):
    rows, fitted, _ = trained
    losses = model.follow(fitted, rows.where("split = 'test'")).orderBy("round").collect()
    assert [r["round"] for r in losses] == [1, 2, 3, 4, 5, 6] and losses[-1].log_loss < losses[0].log_loss
    p = model.score(fitted, rows.where("split = 'test'")).select("fraud_probability", "label").collect()
    plain = np.mean([-2 * np.log(r.fraud_probability if r.label == 1 else 1 - r.fraud_probability) for r in p])
    assert losses[-1].log_loss == pytest.approx(plain, rel=1e-9)
    stopped = model.train(rows, model.Boosting(rounds=40, depth=3, step=1.0, stop_below=0.05))
    assert stopped.stages[-1].getNumTrees < 40
