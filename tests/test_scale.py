"""What keeps the work of a query in proportion to what it reads."""

from __future__ import annotations

import os

import __spark_entry__ as entry_point
from ledgerlens.operators.treeshap import Leaf, grouped
from ledgerlens.plans import batch, model
from ledgerlens.session import shared_folder
from ledgerlens.sources.given_tables import GivenTables
from ledgerlens.sources.layout import Layout


def opened(spark, folder):
    root = shared_folder(spark, "opened")
    w = batch.open_batch(spark, GivenTables(spark, folder).all(), Layout(root), as_of=entry_point.AS_OF)
    return w, lambda: {f"{layer}.{t}" for layer in ("bronze", "silver", "gold")
                       for t in (os.listdir(f"{root}/{layer}") if os.path.isdir(f"{root}/{layer}") else ())}


def test_a_table_is_written_when_it_is_first_read(spark, folder):
    w, written = opened(spark, folder)
    assert written() == set()
    w.landed("merchants")
    assert written() == {"bronze.merchants"}
    assert w.gold("alert_rule_performance").count() > 0
    assert written() == {"bronze.merchants", *(f"{layer}{t}" for layer in ("bronze.", "silver.silver_")
                                               for t in ("alerts", "fraud_labels")), "gold.gold_alert_rule_performance"}
    before = w.gold("alert_rule_performance").inputFiles()
    assert len(w.rows) == 19 and len(written()) == 19
    assert w.gold("alert_rule_performance").inputFiles() == before


def test_explanations_of_a_model_wait_for_a_reader(spark, folder):
    w, written = opened(spark, folder)
    batch.open_model(w, shared_folder(spark, "model"), model.Boosting(rounds=2, depth=2))
    assert w.gold("fraud_predictions").count() == w.gold("ml_features").count()
    assert "gold.gold_shap_explanations" not in written()
    assert w.gold("shap_explanations").count() == w.gold("ml_features").count()


def test_cuts_of_one_feature_share_a_block():
    """Between 100 cuts a row has 101 places, not 2^100."""
    inf = float("inf")
    bounds = [-inf, *range(100), inf]
    leaves = [Leaf(float(k), (0,), (low,), (high,), (1 / 101,)) for k, (low, high) in enumerate(zip(bounds, bounds[1:]))]
    assert [members for members, _ in grouped(leaves)] == [list(range(101))]
    assert len(grouped(leaves, 20)) > 1
