"""Every query with check SQL, Spark against DuckDB over the same files."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from compare import connect, difference

ADDED = set(entry_point._llm_queries())  # an add-on with tests of its own
QUERIES = {name: q for name, q in entry_point.queries().items() if name not in ADDED}
SQL = {name: text for name, text in entry_point.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, folder, con, name):
    assert difference(QUERIES[name](spark, folder), con, SQL[name]) is None


def test_comparison_notices_a_changed_value(spark, folder, con):
    changed = QUERIES["kpi08_hourly"](spark, folder).selectExpr(
        "txn_hour", "total_txns + if(txn_hour = 7, 1, 0) as total_txns", "fraud_count", "fraud_rate_pct")
    assert "1 of" in difference(changed, con, SQL["kpi08_hourly"])


def test_only_model_outputs_have_no_sql():
    assert set(QUERIES) - set(SQL) == {
        "model_scores", "model_evaluation", "model_auc", "shap_explanations", "kpi02_monthly_trend_model",
        "kpi06_top_drivers_model", "explainability_coverage_model"}


def test_entry_runs(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["risk_tier", "alert_type", "severity", "alerts", "transactions"]
    assert result.count() > 0
