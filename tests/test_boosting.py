"""Trees that are grown by tasks side by side."""

from __future__ import annotations

from urllib.parse import urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import boosting
from ledgerlens.plans import model


@pytest.fixture(scope="module")
def few(spark):
    """Rows whose inputs have few values, so that every cut between two of them is a candidate."""
    rng = np.random.default_rng(5)
    inputs = rng.integers(0, 12, (1500, len(model.FEATURES))) / 4
    odds = inputs[:, 0] - inputs[:, 3] * inputs[:, 5] + (inputs[:, 7] > 1.5) * 2 - 1.5
    labels = rng.random(1500) < 1 / (1 + np.exp(-odds))
    rows = [(f"T{k}", *map(float, x), int(y)) for k, (x, y) in enumerate(zip(inputs, labels))]
    names = ", ".join(f"{f} double" for f in model.FEATURES)
    return model.split(spark.createDataFrame(rows, f"transaction_id string, {names}, label int")).cache()


def trees(fitted):
    return fitted.stages[-1].toDebugString.split("\n", 1)[1]


@pytest.mark.parametrize("stop_below", [None, 0.02])
def test_trees_equal_mllib_where_nothing_is_drawn(few, monkeypatch, stop_below):
    params = model.Boosting(rounds=12, depth=2, step=0.3, row_share=1.0, column_share=1.0, stop_below=stop_below)
    ours = model.train(few, params)
    monkeypatch.setattr(model, "tasks_at_once", lambda spark: 0)
    library = model.train(few, params)
    assert ours.stages[-1].getNumTrees == library.stages[-1].getNumTrees
    assert ours.stages[-1].treeWeights == library.stages[-1].treeWeights
    assert ours.stages[-1].totalNumNodes == library.stages[-1].totalNumNodes
    assert list(ours.stages[-1].featureImportances.toArray()) == pytest.approx(
        list(library.stages[-1].featureImportances.toArray()), abs=1e-5)
    a, b = ({r.transaction_id: r.fraud_probability for r in model.score(m, few).collect()} for m in (ours, library))
    assert [a[k] for k in sorted(a)] == pytest.approx([b[k] for k in sorted(b)], abs=1e-6)


def test_scores_equal_mllib(few):
    fitted = model.train(few, model.Boosting(rounds=8, depth=5))
    scored = model.score(fitted, few)
    assert scored.columns == [*few.columns, "fraud_probability"]
    assert "MapInArrow" in scored._jdf.queryExecution().toString()
    library = {r.transaction_id: r.probability[1] for r in fitted.transform(few).collect()}
    ours = {r.transaction_id: r.fraud_probability for r in scored.collect()}
    assert [ours[k] for k in sorted(ours)] == pytest.approx([library[k] for k in sorted(library)], abs=1e-14)
    with pytest.raises(Exception, match="NULL or not a number"):
        model.score(fitted, few.withColumn("amount", F.lit(None).cast("double"))).collect()


def test_a_model_of_a_single_leaf_scores_all_rows(few):
    fitted = model.train(few.where("label = 0"), model.Boosting(rounds=2, depth=3))
    assert [t.numNodes for t in fitted.stages[-1].trees] == [1, 1]
    assert model.score(fitted, few).where("fraud_probability < 0.5").count() == few.count()


def test_jobs_of_a_training_do_not_grow_with_its_rounds(spark, few):
    def jobs(rounds):
        group = f"training-{rounds}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            model.train(few, model.Boosting(rounds=rounds, depth=3))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    jobs(1)
    assert jobs(10) <= jobs(2) + 2


def test_another_partitioning_gives_the_same_trees(few, monkeypatch):
    params = model.Boosting(rounds=5, depth=4)
    alone = trees(model.train(few, params))
    monkeypatch.setattr(boosting, "ROWS_A_TASK", 300)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 70)
    assert trees(model.train(few.repartition(7), params)) == alone
    assert trees(model.train(few, model.Boosting(rounds=5, depth=4, seed=7))) != alone


def test_tasks_without_a_common_folder_use_the_barrier(few, monkeypatch):
    params = model.Boosting(rounds=1, depth=2)
    alone = trees(model.train(few, params))
    monkeypatch.setattr(boosting, "ROWS_A_TASK", 600)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 70)
    monkeypatch.setattr(boosting, "urlparse", lambda path: urlparse(f"s3a://lake{path}"))
    assert trees(model.train(few, params)) == alone


def test_cuts_are_at_equal_steps_of_weight():
    values, weights = np.arange(1000.0), np.ones(1000)
    cuts = boosting.placed_cuts(values, weights, 4)
    assert list(cuts) == [249.5, 499.5, 749.5]
    assert list(boosting.placed_cuts(values[:3], weights[:3], 4)) == [0.5, 1.5]
    thin, heavy = boosting._thinned(np.repeat(values, 3), np.ones(3000), 100)
    assert len(thin) == 100 and heavy.sum() == 3000 and thin[-1] == 999


def test_no_rows_to_train_on(few):
    with pytest.raises(ValueError, match="no rows"):
        model.train(few.where("false"))
