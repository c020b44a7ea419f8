"""Tables by name, and the dashboard figures asked in SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from compare import _rows
from ledgerlens.plans import kpi_sql, scorecard

PREFIX = "named_"


@pytest.fixture(scope="module")
def registered(spark, folder):
    w = entry_point._warehouse(spark, folder)
    features = w.gold("ml_features")
    # the rule score's tables stand in for the model's: same columns, no training
    w.save("gold", "gold_fraud_predictions", scorecard.rule_predictions(features))
    w.save("gold", "gold_shap_explanations", scorecard.rule_explanations(features))
    w.register(PREFIX)
    yield w
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS {PREFIX}{layer} CASCADE")
    entry_point._models.clear()
    for table in ("gold_fraud_predictions", "gold_shap_explanations"):
        w.rows.pop(f"gold.{table}")


def test_every_written_table_has_its_rows(spark, registered):
    for name, rows in registered.rows.items():
        assert spark.table(PREFIX + name).count() == rows, name


@pytest.mark.parametrize("name", sorted(kpi_sql.queries()))
def test_sql_equals_the_frames(spark, folder, registered, name):
    asked = spark.sql(kpi_sql.queries(PREFIX)[name])
    built = entry_point.queries()[name](spark, folder)
    assert asked.columns == built.columns
    plain = lambda df: _rows(df.columns, [tuple(r) for r in df.collect()])
    assert plain(asked) == plain(built)


def test_registering_again_is_harmless(spark, registered):
    registered.register(PREFIX)
    assert spark.table(f"{PREFIX}gold.gold_ml_features").count() == registered.rows["gold.gold_ml_features"]
