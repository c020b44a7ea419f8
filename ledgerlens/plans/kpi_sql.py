"""The ten dashboard figures as SQL over catalog tables (see ``Warehouse.register``)."""

from __future__ import annotations

_RATE = "ROUND(CAST(100D * SUM(CAST({flag} AS BIGINT)) / COUNT({flag}) AS DECIMAL(38,8)), {digits})"
_SUM = "CAST(SUM(CAST({column} AS DECIMAL(28,4))) AS DOUBLE)"
_MEAN = "CAST(SUM(CAST({column} AS DECIMAL(28,10))) AS DOUBLE) / COUNT({column})"


def _round(value: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def _rate(flag: str, digits: int) -> str:
    return f"CAST({_RATE.format(flag=flag, digits=digits)} AS DOUBLE)"


def _sum(column: str, digits: int) -> str:
    return _round(_SUM.format(column=column), digits)


def _mean(column: str, digits: int, factor: int = 1) -> str:
    return _round(f"{factor} * ({_MEAN.format(column=column)})", digits)


_FRAUD = "COUNT(*) AS total_txns, SUM(CAST(is_fraud AS BIGINT)) AS fraud_count"


def queries(prefix: str = "", start: str = "2024-01-01", end: str = "2024-12-31") -> dict[str, str]:
    """SQL by query name. ``prefix`` is that of the layer databases."""
    gold, silver = f"{prefix}gold", f"{prefix}silver"
    enriched = f"{gold}.gold_transactions_enriched"
    return {
        "kpi01_overall": f"""
            SELECT COUNT(*) AS total_transactions, SUM(CAST(is_fraud AS BIGINT)) AS total_fraud_txns,
              {_rate('is_fraud', 3)} AS fraud_rate_pct, {_sum('loss_amount', 2)} AS total_fraud_loss,
              {_mean('loss_amount', 2)} AS avg_fraud_loss,
              COUNT(DISTINCT IF(is_fraud = 1, account_id, NULL)) AS affected_accounts
            FROM {enriched} WHERE txn_date BETWEEN DATE'{start}' AND DATE'{end}'""",
        "kpi02_monthly_trend": f"""
            SELECT DATE_FORMAT(txn_date, 'yyyy-MM') AS month, {_FRAUD}, {_rate('is_fraud', 3)} AS fraud_rate_pct,
              {_sum('loss_amount', 2)} AS fraud_loss, {_mean('fraud_probability', 4)} AS avg_fraud_prob
            FROM {enriched} LEFT JOIN {gold}.gold_fraud_predictions USING (transaction_id) GROUP BY 1 ORDER BY 1""",
        "kpi03_rule_leaderboard": f"""
            SELECT rule_id, alert_type, severity, total_alerts, true_positives, false_positives,
              {_round('fp_rate * 100', 1)} AS false_positive_rate_pct, avg_score,
              {_round('avg_resolution_hours', 1)} AS avg_resolution_hrs
            FROM {gold}.gold_alert_rule_performance
            ORDER BY fp_rate DESC NULLS LAST, total_alerts DESC, rule_id, alert_type, severity LIMIT 20""",
        "kpi04_top_risk_customers": f"""
            SELECT c.customer_id, c.segment, c.country, c.risk_score, c.risk_band, c.kyc_status, c.is_pep,
              c.is_sanctioned, v.lifetime_txns, v.lifetime_spend, v.total_declines, v.high_value_txns
            FROM {silver}.silver_customers c JOIN {gold}.gold_customer_360 v ON c.customer_id = v.customer_id
            WHERE c.is_high_risk ORDER BY c.risk_score DESC NULLS LAST, c.customer_id LIMIT 10""",
        "kpi05_channel_type": f"""
            SELECT channel, transaction_type, {_FRAUD}, {_rate('is_fraud', 2)} AS fraud_rate_pct,
              {_sum('loss_amount', 0)} AS total_loss
            FROM {enriched} GROUP BY channel, transaction_type
            ORDER BY fraud_rate_pct DESC, channel, transaction_type""",
        "kpi06_top_drivers": f"""
            SELECT top_fraud_drivers, COUNT(*) AS flagged_transactions,
              {_mean('predicted_fraud_prob', 4)} AS avg_fraud_probability
            FROM {gold}.gold_shap_explanations WHERE predicted_label = 1 GROUP BY top_fraud_drivers
            ORDER BY flagged_transactions DESC, top_fraud_drivers LIMIT 15""",
        "kpi07_merchant_heatmap": f"""
            SELECT m.mcc_description, m.risk_level, COUNT(transaction_id) AS total_txns,
              SUM(CAST(is_fraud AS BIGINT)) AS fraud_count,
              {_round('100D * SUM(CAST(is_fraud AS BIGINT)) / COUNT(transaction_id)', 2)} AS fraud_rate_pct,
              {_sum('loss_amount', 2)} AS total_loss
            FROM {enriched} e JOIN {silver}.silver_merchants m ON e.merchant_id = m.merchant_id
            GROUP BY m.mcc_description, m.risk_level ORDER BY fraud_rate_pct DESC, mcc_description, risk_level""",
        "kpi08_hourly": f"""
            SELECT txn_hour, {_FRAUD}, {_rate('is_fraud', 3)} AS fraud_rate_pct
            FROM {enriched} GROUP BY txn_hour ORDER BY txn_hour""",
        "kpi09_loss_recovery": f"""
            SELECT fraud_type, COUNT(*) AS cases, {_sum('loss_amount', 2)} AS total_loss,
              {_sum('recovered_amount', 2)} AS total_recovered, {_mean('recovery_rate', 1, 100)} AS avg_recovery_pct,
              {_mean('hours_to_confirm', 1)} AS avg_hours_to_confirm
            FROM {silver}.silver_fraud_labels GROUP BY fraud_type ORDER BY total_loss DESC NULLS LAST, fraud_type""",
        "kpi10_compliance": f"""
            SELECT action, actor_type, COUNT(*) AS log_count, SUM(CAST(compliance_flag AS BIGINT)) AS compliance_flags,
              SUM(CAST(is_failure AS BIGINT)) AS failures, {_rate('compliance_flag', 1)} AS flag_rate_pct
            FROM {silver}.silver_audit_logs GROUP BY action, actor_type
            ORDER BY compliance_flags DESC NULLS LAST, action, actor_type""",
    }
