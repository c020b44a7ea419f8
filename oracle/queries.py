"""The check SQL of every registered query."""

from __future__ import annotations

from ledgerlens import schemas as s
from ledgerlens.operators.quality import MEASURED
from oracle.tables import big, davg, dsum, pct, query, r


def _raw() -> dict[str, str]:
    return {f"bronze_{t}": query(f"SELECT * FROM b_{t}", f"b_{t}") for t in s.TABLES}


def _silver() -> dict[str, str]:
    out = {}
    for t in s.TABLES:
        out[f"silver_{t}"] = query(f"SELECT * FROM s_{t}", f"s_{t}")
        out[f"silver_{t}_declarative"] = query(f"SELECT * FROM p_{t}", f"p_{t}")
    return out


def _gold() -> dict[str, str]:
    out = {}
    for key, name in {"gold_customer_360": "customer_360", "gold_transactions_enriched": "enriched",
                      "gold_daily_fraud_summary": "daily", "gold_alert_rule_performance": "rules",
                      "account_stats": "account_stats", "alerts_per_transaction": "alerts_per_transaction"}.items():
        out[key] = query(f"SELECT * FROM s_{name}", f"s_{name}")
        if key.startswith("gold_"):
            out[f"{key}_declarative"] = query(f"SELECT * FROM p_{name}", f"p_{name}")
    return out


def _quality() -> dict[str, str]:
    parts = [
        f"SELECT '{t}' AS table_name, '{e.name}' AS expectation, '{e.action}' AS action, count(*) AS total_rows, "
        f"count(CASE WHEN NOT coalesce({e.predicate}, false) THEN 1 END) AS violations FROM b_{t}"
        for t in s.TABLES for e in MEASURED[t]]
    broken = {"transaction_id_present": "transaction_id IS NOT NULL", "account_id_present": "account_id IS NOT NULL",
              "amount_positive": "amount > 0",
              "status_known": "status IN ('Completed', 'Pending', 'Declined', 'Reversed')"}
    names = ", ".join(f"CASE WHEN NOT coalesce({p}, false) THEN '{n}' END" for n, p in broken.items())
    refs = [f"""SELECT '{c}' AS child_table, '{fk}' AS child_column, '{par}' AS parent_table,
      count(*) AS referencing_rows, count(CASE WHEN p.k IS NULL THEN 1 END) AS orphan_rows,
      count(DISTINCT CASE WHEN p.k IS NULL THEN c.{fk} END) AS orphan_keys
      FROM b_{c} c LEFT JOIN (SELECT DISTINCT {pk} AS k FROM b_{par}) p ON c.{fk} = p.k WHERE c.{fk} IS NOT NULL"""
            for c, fk, par, pk in s.REFERENCES]
    counts = [f"SELECT '{layer}' AS layer, '{t}' AS table_name, count(*) AS row_count FROM {pre}_{t}"
              for layer, pre in (("bronze", "b"), ("silver", "s")) for t in s.TABLES]
    counts += [f"SELECT 'gold' AS layer, '{t}' AS table_name, count(*) AS row_count FROM {b}" for t, b in {
        "customer_360": "s_customer_360", "transactions_enriched": "s_enriched",
        "daily_fraud_summary": "s_daily", "alert_rule_performance": "s_rules", "ml_features": "features"}.items()]
    every = [f"{p}_{t}" for p in "bs" for t in s.TABLES] + ["s_customer_360", "s_daily", "s_rules", "features"]
    return {
        "expectation_report": query(" UNION ALL ".join(parts), *[f"b_{t}" for t in s.TABLES]),
        "quarantine_transactions": query(
            f"SELECT * REPLACE (array_to_string(violations, ',') AS violations) FROM (SELECT *, "
            f"list_filter([{names}], lambda x: x IS NOT NULL) AS violations FROM u_transactions) WHERE len(violations) > 0",
            "u_transactions"),
        "orphan_check": query(" UNION ALL ".join(refs), *[f"b_{t}" for t in s.TABLES if t != "audit_logs"]),
        "duplicate_keys": query("SELECT alert_id, count(*) AS copies FROM b_alerts GROUP BY 1 HAVING count(*) > 1",
                                "b_alerts"),
        "dedup_alerts_latest": query("SELECT * FROM u_alerts", "u_alerts"),
        "layer_row_counts": query(
            f"SELECT * FROM (WITH c AS ({' UNION ALL '.join(counts)}) SELECT * FROM c UNION ALL "
            "SELECT layer, 'TOTAL', CAST(sum(row_count) AS BIGINT) FROM c GROUP BY layer)", *every),
        "partition_prune_day": query(f"""SELECT channel, count(*) AS transactions, {dsum('amount')} AS volume
            FROM s_enriched WHERE txn_date = DATE '2024-01-15' GROUP BY channel""", "s_enriched"),
    }


_VELOCITY = """transaction_id, account_id, txn_ts_unix, txn_count_1h, txn_count_24h, txn_count_7d, amount_sum_1h,
  amount_sum_24h, {avg} AS amount_avg_7d, {sd} AS amount_stddev_7d""".format(
    avg=r("amount_avg_7d", 4), sd=r("amount_stddev_7d", 4))
_MODEL_INPUTS = ["amount", "txn_hour", "is_international", "is_high_value", "is_odd_hour", "is_declined",
                 "is_round_amount", "txn_count_1h", "txn_count_24h", "txn_count_7d", "amount_sum_1h",
                 "amount_sum_24h", "amount_avg_7d", "amount_zscore", "geo_risk_score", "channel_risk",
                 "composite_risk_score", "is_high_velocity", "risk_score"]


_SUMMARY = ("amount", "amount_zscore", "composite_risk_score", "txn_count_1h", "txn_count_24h", "is_high_velocity",
            "geo_risk_score", "is_round_amount", "label")


def _features() -> dict[str, str]:
    summary = " UNION ALL ".join(
        f"""SELECT '{n}' AS feature, count({n}) AS count, {r(davg(n, 'DECIMAL(28,8)'), 4)} AS mean,
        {r(f'stddev_samp(CAST({n} AS DOUBLE))', 4)} AS stddev, {r(f'min({n})', 4)} AS min, {r(f'max({n})', 4)} AS max
        FROM features""" for n in _SUMMARY)
    rounded = {"amount_avg_7d", "amount_zscore", "amount_stddev_7d"}
    matrix = ", ".join(
        (r(f"coalesce({c}, 0)", 4) if c in rounded else f"CAST(coalesce(CAST({c} AS DOUBLE), 0) AS DOUBLE)") + f" AS {c}"
        for c in _MODEL_INPUTS)
    rows = query(f"""SELECT * EXCLUDE (unique_merchants_24h, amount_max_7d) REPLACE (
        {r('amount_avg_7d', 4)} AS amount_avg_7d, {r('amount_stddev_7d', 4)} AS amount_stddev_7d,
        {r('amount_zscore', 4)} AS amount_zscore) FROM features""", "features")
    return {
        "velocity_features": query(f"SELECT {_VELOCITY} FROM velocity", "velocity"),
        "velocity_features_extended": query(
            "SELECT transaction_id, unique_merchants_24h, amount_max_7d FROM velocity", "velocity"),
        "anomaly_scores": query(f"""SELECT transaction_id, {r('amount_zscore', 4)} AS amount_zscore, geo_risk_score,
            channel_risk, composite_risk_score, is_high_velocity, is_round_amount, label FROM features""", "features"),
        "gold_ml_features": rows,
        "refreshed_features": rows,
        "feature_summary": query(summary, "features"),
        "feature_quartiles": query(" UNION ALL ".join(
            f"SELECT '{c}' AS feature, {r(f'quantile_cont({c}::DOUBLE, 0.25)', 4)} AS q1, "
            f"{r(f'quantile_cont({c}::DOUBLE, 0.5)', 4)} AS median, {r(f'quantile_cont({c}::DOUBLE, 0.75)', 4)} AS q3 "
            "FROM features" for c in _SUMMARY), "features"),
        "contextual_features": query("""SELECT t.transaction_id, t.account_id,
            CASE t.risk_level WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 WHEN 'Very High' THEN 3 END
              AS merchant_risk_encoded, t.risk_score AS customer_risk_score, t.is_pep, a.balance AS account_balance
            FROM s_enriched t LEFT JOIN s_accounts a ON t.account_id = a.account_id""", "s_enriched", "s_accounts"),
        "ml_matrix": query(f"SELECT transaction_id, {matrix}, label FROM features", "features"),
    }


def _rule(rule_id: str, kind: str, severity: str, score: str, where: str) -> str:
    return (f"SELECT '{rule_id}' AS rule_id, '{kind}' AS alert_type, '{severity}' AS severity, "
            f"CAST({score} AS DECIMAL(6,4)) AS score, transaction_id, account_id, txn_datetime FROM hist WHERE {where}")


def _fired(hist: str, rules: str) -> str:
    return f"""SELECT * FROM (WITH {hist} SELECT rule_id || '-' || transaction_id AS alert_id, transaction_id,
        account_id, rule_id, alert_type, severity, CAST(score AS DOUBLE) AS score, txn_datetime AS created_datetime,
        rule_id || ' (' || alert_type || ') fired with ' || CAST(score AS VARCHAR) || ' points'
          AS explanation FROM ({rules}))"""


_BLACKLISTED = "merchant_id IN (SELECT merchant_id FROM b_merchants WHERE is_blacklisted)"


def _rules() -> dict[str, str]:
    rule = _rule
    rules = " UNION ALL ".join([
        rule("R100", "Velocity Check", "High", "0.80", "is_high_velocity = 1"),
        rule("R101", "Amount Threshold", "Medium", "least(0.99, 0.65 + amount / 1000000)", "amount > 10000"),
        rule("R102", "Geo Anomaly", "Medium", "0.70", "is_international AND is_odd_hour"),
        rule("R103", "Device Anomaly", "Low", "0.55", "device_seen = 1 AND account_seen > 1"),
        rule("R104", "Blacklist Match", "Critical", "0.95", _BLACKLISTED),
        rule("R105", "Dormant Account Activity", "High", "0.75", "account_status = 'Dormant' OR gap > 30 * 86400"),
        rule("R106", "Round Amount", "Low", "0.50", "is_round_amount = 1"),
        rule("R107", "Night Transaction", "Low", "0.52", "is_odd_hour"),
        rule("R108", "Multiple Declines", "Medium", "least(0.99, 0.60 + declines / 100.0)",
             "is_declined AND declines >= 3"),
        rule("R109", "Cross-Border High Value", "High", "0.85", "is_international AND amount > 5000"),
    ])
    hist = """hist AS (SELECT *,
        row_number() OVER (PARTITION BY account_id, device_id ORDER BY txn_ts_unix, transaction_id) AS device_seen,
        row_number() OVER (PARTITION BY account_id ORDER BY txn_ts_unix, transaction_id) AS account_seen,
        txn_ts_unix - lag(txn_ts_unix) OVER (PARTITION BY account_id ORDER BY txn_ts_unix, transaction_id) AS gap,
        count(CASE WHEN is_declined THEN 1 END) OVER (PARTITION BY account_id ORDER BY txn_ts_unix
          RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS declines FROM features)"""
    alerts = _fired(hist, rules)

    def structuring(deposit: str, withdrawal: str, n: int) -> str:
        return f"""(SELECT transaction_id, account_id, txn_datetime, amount, deposits, deposit_total, channels
        FROM (SELECT *, count(CASE WHEN dep THEN 1 END) OVER w AS deposits,
                coalesce(CAST(sum(CASE WHEN dep THEN CAST(amount AS DECIMAL(18,2)) END) OVER w AS DOUBLE), 0)
                  AS deposit_total,
                count(DISTINCT channel) OVER w AS channels
              FROM (SELECT *, {deposit} AS dep, CAST(epoch(txn_datetime) AS BIGINT) AS sec FROM s_transactions
                    WHERE ({deposit}) OR ({withdrawal}))
              WINDOW w AS (PARTITION BY account_id ORDER BY sec RANGE BETWEEN 14400 PRECEDING AND CURRENT ROW))
        WHERE NOT dep AND deposits >= {n} AND channels >= {n})"""
    pattern = structuring("transaction_type IN ('Cash Deposit', 'ACH', 'Refund') AND amount < 10000",
                          "transaction_type IN ('ATM Withdrawal', 'Wire Transfer') AND amount >= 3000", 2)
    reasons = f"""SELECT transaction_id, composite_risk_score, CAST(len(parts) AS INT) AS signals,
        array_to_string(parts, '; ') AS explanation
      FROM (SELECT transaction_id, composite_risk_score, list_filter([
        CASE WHEN transaction_id IN (SELECT transaction_id FROM {pattern}) THEN
          'A large withdrawal follows several small deposits' END,
        CASE WHEN amount_zscore >= 2 THEN 'Amount ' || CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR)
          || ', z-score ' || CAST(CAST(amount_zscore AS DECIMAL(18,1)) AS VARCHAR) || ' within the account' END,
        CASE WHEN is_high_velocity = 1 THEN 'Burst of payments: ' || txn_count_1h || ' within an hour, '
          || txn_count_24h || ' within a day' END,
        CASE WHEN is_international THEN 'International transaction' END,
        CASE WHEN is_odd_hour THEN 'Transaction at ' || strftime(txn_datetime, '%H:%M') END,
        CASE WHEN is_high_risk_merchant THEN 'Risky trade of the merchant: ' || mcc_description || ', code '
          || mcc_code END,
        CASE WHEN channel_risk >= 2 THEN 'Exposed channel (' || channel || ')' END
      ], lambda x: x IS NOT NULL) AS parts FROM features) WHERE len(parts) > 0"""
    tier = """CASE WHEN fraud_probability >= 0.8 THEN '{0}' WHEN fraud_probability >= 0.6 THEN '{1}'
        WHEN fraud_probability >= 0.4 THEN '{2}' ELSE '{3}' END"""
    tiers = tier.format("Critical", "High", "Medium", "Low")
    action = tier.format("Auto-block transaction + immediate investigation", "Priority queue for analyst review",
                         "Standard review within 24h", "Log and monitor")
    edge = """SELECT account_id, counterparty_id, count(*) AS n, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amt
        FROM s_enriched WHERE counterparty_id IS NOT NULL GROUP BY 1, 2"""
    step = """SELECT n.id, n.seed, n.seed + coalesce(sum(0.5::DOUBLE * w.w * p.e), 0) AS e FROM nodes n
        LEFT JOIN weights w ON w.a = n.id LEFT JOIN hop_{0} p ON p.id = w.c GROUP BY n.id, n.seed"""
    hops = f"""SELECT * FROM (WITH relations AS (SELECT account_id AS a, counterparty_id AS c, count(*) AS t FROM s_enriched
          WHERE counterparty_id IS NOT NULL GROUP BY 1, 2),
        weights AS (SELECT a, c, t / CAST(sum(t) OVER (PARTITION BY a) AS DOUBLE) AS w FROM relations),
        labelled AS (SELECT DISTINCT account_id AS id FROM s_enriched WHERE is_fraud = 1 AND account_id IS NOT NULL),
        nodes AS (SELECT id, CAST(id IN (SELECT id FROM labelled) AS INT) AS seed FROM (
          SELECT a AS id FROM relations UNION SELECT c FROM relations UNION SELECT id FROM labelled)),
        hop_0 AS (SELECT id, seed, CAST(seed AS DOUBLE) AS e FROM nodes),
        {', '.join(f'hop_{k} AS ({step.format(k - 1)})' for k in (1, 2, 3))}
        SELECT id AS account_id, seed AS is_labelled, {r('e', 4)} AS exposure FROM hop_3)"""
    network = f"""SELECT coalesce(o.account_id, i.account_id) AS account_id, coalesce(out_degree, 0) AS out_degree,
        coalesce(out_transfers, 0) AS out_transfers, coalesce(out_amount, 0) AS out_amount,
        coalesce(labelled_counterparties, 0) AS labelled_counterparties, coalesce(in_degree, 0) AS in_degree,
        coalesce(in_transfers, 0) AS in_transfers,
        CAST(coalesce(labelled_counterparties, 0) AS DOUBLE) / nullif(coalesce(out_degree, 0), 0) AS labelled_share
      FROM (SELECT account_id, count(*) AS out_degree, {big('sum(n)')} AS out_transfers, {dsum('amt')} AS out_amount,
              count(CASE WHEN counterparty_id IN (SELECT account_id FROM s_enriched WHERE is_fraud = 1) THEN 1 END)
                AS labelled_counterparties FROM ({edge}) GROUP BY account_id) o
      FULL JOIN (SELECT counterparty_id AS account_id, count(*) AS in_degree, {big('sum(n)')} AS in_transfers
                 FROM ({edge}) GROUP BY counterparty_id) i ON o.account_id = i.account_id"""
    return {
        "rule_alerts": query(alerts, "features", "b_merchants"),
        "structuring_patterns": query(f"SELECT * FROM {pattern}", "s_transactions"),
        "alert_explanations": query(reasons, "features", "s_transactions"),
        "case_queue": query(f"""SELECT transaction_id, account_id, fraud_probability, risk_tier, queue,
            row_number() OVER (PARTITION BY risk_tier ORDER BY fraud_probability DESC, minute, transaction_id)
              AS queue_position
            FROM (SELECT s.transaction_id, f.account_id, fraud_probability, {tiers} AS risk_tier, {action} AS queue,
                    CAST(epoch(f.txn_datetime) AS BIGINT) // 60 AS minute
                  FROM scored s JOIN features f ON s.transaction_id = f.transaction_id)""", "scored", "features"),
        "counterparty_risk": query(network, "s_enriched"),
        "network_risk": query(hops, "s_enriched"),
        "risk_tier": query("SELECT * FROM predictions", "predictions"),
        "risk_tier_policy": query(f"SELECT transaction_id, fraud_probability, {tiers} AS risk_tier, {action} AS action "
                                  "FROM scored", "scored"),
        "top_drivers": query("SELECT transaction_id, predicted_fraud_prob, predicted_label, top_fraud_drivers "
                             "FROM explanations", "explanations"),
    }


def _model() -> dict[str, str]:
    part = ("CASE WHEN CAST(('0x' || substr(md5(transaction_id || ':42'), 1, 8)) AS BIGINT) % 100 < 80 "
            "THEN 'train' ELSE 'test' END")
    cells = """SELECT CAST(count(CASE WHEN label = 0 AND p = 0 THEN 1 END) AS DOUBLE) AS tn,
        CAST(count(CASE WHEN label = 0 AND p = 1 THEN 1 END) AS DOUBLE) AS fp,
        CAST(count(CASE WHEN label = 1 AND p = 0 THEN 1 END) AS DOUBLE) AS fn,
        CAST(count(CASE WHEN label = 1 AND p = 1 THEN 1 END) AS DOUBLE) AS tp
        FROM (SELECT label, CAST(fraud_probability >= 0.5 AS INT) AS p FROM scored)"""
    report = f"""SELECT * FROM (WITH c AS ({cells}), m AS (
          SELECT 'Legit' AS class_name, tn / (tn + fn) AS precision, tn / (tn + fp) AS recall,
            2 * tn / (2 * tn + fn + fp) AS f1, tn + fp AS support FROM c
          UNION ALL SELECT 'Fraud', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM c)
        SELECT class_name, {r('precision', 6)} AS precision, {r('recall', 6)} AS recall, {r('f1', 6)} AS f1,
          {big('support')} AS support FROM (
          SELECT * FROM m
          UNION ALL SELECT 'accuracy', (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn),
            (tp + tn) / (tp + tn + fp + fn), tp + tn + fp + fn FROM c
          UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM m
          UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
            sum(f1 * support) / sum(support), sum(support) FROM m))"""
    auc = f"""SELECT {big('sum(label)')} AS positives, {big('sum(1 - label)')} AS negatives,
        {r('''(sum(CASE WHEN label = 1 THEN rk END) - CAST(sum(label) AS DOUBLE) * (sum(label) + 1) / 2)
              / (CAST(sum(label) AS DOUBLE) * sum(1 - label))''', 8)} AS roc_auc
      FROM (SELECT label, rank() OVER (ORDER BY fraud_probability)
              + (count(*) OVER (PARTITION BY fraud_probability) - 1) / 2.0::DOUBLE AS rk FROM scored)"""
    areas = f"""SELECT {big('max(total)')} AS positives,
        {r('sum(pos * (here + coalesce(above, here)) / 2) / max(total)', 8)} AS pr_auc,
        {r('sum(pos * here) / max(total)', 8)} AS average_precision
      FROM (SELECT *, tp / n AS here, lag(tp / n) OVER (ORDER BY p DESC) AS above
            FROM (SELECT p, pos, CAST(sum(pos) OVER w AS DOUBLE) AS tp, sum(rows_) OVER w AS n,
                    CAST(sum(pos) OVER () AS DOUBLE) AS total
                  FROM (SELECT fraud_probability AS p, sum(label) AS pos, count(*) AS rows_ FROM scored GROUP BY 1)
                  WINDOW w AS (ORDER BY p DESC)))"""
    test_part = f"SELECT label FROM (SELECT label, {part} AS split FROM features) WHERE split = 'test'"
    exact = """SELECT transaction_id, label, CASE WHEN rn <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split
        FROM (SELECT transaction_id, label, count(*) OVER (PARTITION BY label) AS n,
                row_number() OVER (PARTITION BY label ORDER BY md5(transaction_id || ':42'), transaction_id) AS rn
              FROM features)"""
    return {
        "stratified_split": query(f"SELECT transaction_id, label, {part} AS split FROM features", "features"),
        "stratified_split_exact": query(exact, "features"),
        "model_score_invariants": query("""SELECT count(*) AS scored, count(DISTINCT transaction_id) AS ids,
            0::BIGINT AS outside, 0::BIGINT AS wrong_prediction, 0::BIGINT AS wrong_tier FROM features""", "features"),
        "shap_additivity": query("SELECT count(*) AS explained, 0::BIGINT AS off FROM features", "features"),
        "model_reload_equal": "SELECT 0::BIGINT AS different",
        "class_balance": query(f"""SELECT split, count(CASE WHEN label = 0 THEN 1 END) AS negatives,
            count(CASE WHEN label = 1 THEN 1 END) AS positives,
            {r('CAST(count(CASE WHEN label = 0 THEN 1 END) AS DOUBLE) / count(CASE WHEN label = 1 THEN 1 END)', 6)}
              AS positive_weight
            FROM (SELECT label, {part} AS split FROM features) GROUP BY split""", "features"),
        "classification_metrics": query(report, "scored"),
        "roc_auc": query(auc, "scored"),
        "pr_auc": query(areas, "scored"),
        "model_pr_auc_invariants": query(f"""SELECT {big('sum(label)')} AS positives, true AS is_share,
            true AS areas_agree FROM ({test_part})""", "features"),
        "model_evaluation_support": query(f"""SELECT CASE label WHEN 1 THEN 'Fraud' ELSE 'Legit' END AS class_name,
            count(*) AS support, true AS are_shares FROM ({test_part}) GROUP BY label""", "features"),
        "model_auc_support": query(f"""SELECT {big('sum(label)')} AS positives, {big('sum(1 - label)')} AS negatives,
            true AS is_share FROM ({test_part})""", "features"),
        "model_rounds": "SELECT 300::BIGINT AS rounds, 0::BIGINT AS not_positive, true AS learned",
        "kpi02_model_invariants": "SELECT * EXCLUDE (avg_fraud_prob), true AS mean_agrees FROM ("
                                  + _kpis()["kpi02_monthly_trend"] + ")",
        "kpi06_model_invariants": "SELECT 0::BIGINT AS flagged_off, 0::BIGINT AS drivers_off, 0::BIGINT AS unexplained, "
                                  "0::BIGINT AS differing_drivers",
    }


def _kpis() -> dict[str, str]:
    fraud = lambda d: (f"count(*) AS total_txns, {big('sum(is_fraud)')} AS fraud_count, "  # noqa: E731
                       f"{pct('is_fraud', d)} AS fraud_rate_pct")
    loss = lambda d: r(dsum("loss_amount"), d)
    m = "DECIMAL(28,8)"
    return {
        "kpi01_overall": query(f"""SELECT count(*) AS total_transactions, {big('sum(is_fraud)')} AS total_fraud_txns,
            {pct('is_fraud', 3)} AS fraud_rate_pct, {loss(2)} AS total_fraud_loss,
            {r(davg('loss_amount'), 2)} AS avg_fraud_loss,
            count(DISTINCT CASE WHEN is_fraud = 1 THEN account_id END) AS affected_accounts
            FROM s_enriched WHERE txn_date BETWEEN DATE '2024-01-01' AND DATE '2024-12-31'""", "s_enriched"),
        "kpi02_monthly_trend": query(f"""SELECT strftime(txn_date, '%Y-%m') AS month, {fraud(3)},
            {loss(2)} AS fraud_loss, {r(davg('fraud_probability', m), 4)} AS avg_fraud_prob
            FROM s_enriched t LEFT JOIN predictions p USING (transaction_id) GROUP BY 1""", "s_enriched", "predictions"),
        "kpi03_rule_leaderboard": query(f"""SELECT rule_id, alert_type, severity, total_alerts, true_positives,
            false_positives, {r('fp_rate * 100', 1)} AS false_positive_rate_pct, avg_score,
            {r('avg_resolution_hours', 1)} AS avg_resolution_hrs
            FROM s_rules ORDER BY fp_rate DESC NULLS LAST, total_alerts DESC, rule_id, alert_type, severity LIMIT 20""",
                                       "s_rules"),
        "kpi04_top_risk_customers": query("""SELECT c.customer_id, c.segment, c.country, c.risk_score, c.risk_band,
            c.kyc_status, c.is_pep, c.is_sanctioned, v.lifetime_txns, v.lifetime_spend, v.total_declines,
            v.high_value_txns FROM s_customers c JOIN s_customer_360 v ON c.customer_id = v.customer_id
            WHERE c.is_high_risk ORDER BY c.risk_score DESC NULLS LAST, c.customer_id LIMIT 10""",
                                          "s_customers", "s_customer_360"),
        "kpi05_channel_type": query(f"""SELECT channel, transaction_type, {fraud(2)}, {loss(0)} AS total_loss
            FROM s_enriched GROUP BY channel, transaction_type""", "s_enriched"),
        "kpi06_top_drivers": query(f"""SELECT top_fraud_drivers, count(*) AS flagged_transactions,
            {r(davg('predicted_fraud_prob', m), 4)} AS avg_fraud_probability FROM explanations
            WHERE predicted_label = 1 GROUP BY top_fraud_drivers
            ORDER BY flagged_transactions DESC, top_fraud_drivers LIMIT 15""", "explanations"),
        "kpi07_merchant_heatmap": query(f"""SELECT m.mcc_description, m.risk_level, count(*) AS total_txns,
            {big('sum(is_fraud)')} AS fraud_count, {pct('is_fraud', 2)} AS fraud_rate_pct, {loss(2)} AS total_loss
            FROM s_enriched t JOIN s_merchants m ON t.merchant_id = m.merchant_id
            GROUP BY m.mcc_description, m.risk_level""", "s_enriched", "s_merchants"),
        "kpi08_hourly": query(f"SELECT txn_hour, {fraud(3)} FROM s_enriched GROUP BY txn_hour", "s_enriched"),
        "kpi09_loss_recovery": query(f"""SELECT fraud_type, count(*) AS cases, {loss(2)} AS total_loss,
            {r(dsum('recovered_amount'), 2)} AS total_recovered,
            {r(davg('recovery_rate', m) + ' * 100', 1)} AS avg_recovery_pct,
            {r(davg('hours_to_confirm', m), 1)} AS avg_hours_to_confirm
            FROM s_fraud_labels GROUP BY fraud_type""", "s_fraud_labels"),
        "kpi10_compliance": query(f"""SELECT action, actor_type, count(*) AS log_count,
            {big('sum(CAST(compliance_flag AS INT))')} AS compliance_flags,
            {big('sum(CAST(is_failure AS INT))')} AS failures, {pct('compliance_flag', 1)} AS flag_rate_pct
            FROM s_audit_logs GROUP BY action, actor_type""", "s_audit_logs"),
    }


def _insights() -> dict[str, str]:
    m = "DECIMAL(28,8)"
    hours = "(epoch(l.detected_datetime) - epoch(t.txn_datetime)) / 3600"
    loss_rows = lambda key, group: (
        f"SELECT {key} AS fraud_type, count(*) AS cases, {dsum('loss_amount')} AS total_loss, "
        f"{dsum('recovered_amount')} AS total_recovered, "
        f"{r(dsum('recovered_amount') + ' / nullif(' + dsum('loss_amount') + ', 0)', 4)} AS recovery_rate "
        f"FROM s_fraud_labels {group}")
    return {
        "suspicion_rate_daily": query(f"""SELECT txn_date, channel, total_txns, suspicious_txns,
            {r('CAST(suspicious_txns AS DOUBLE) / total_txns', 4)} AS suspicion_rate, {r('usual', 4)} AS trailing_mean,
            coalesce(suspicious_txns > usual * 2, false) AS is_spike
            FROM (SELECT *, avg(suspicious_txns) OVER (PARTITION BY channel ORDER BY txn_date
                    ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS usual
                  FROM (SELECT txn_date, channel, count(*) AS total_txns, {big('sum(is_fraud)')} AS suspicious_txns
                        FROM s_enriched GROUP BY txn_date, channel))""", "s_enriched"),
        "high_risk_share": query(f"""SELECT count(*) AS customers,
            count(CASE WHEN is_high_risk THEN 1 END) AS high_risk_customers,
            {pct('coalesce(is_high_risk, false)', 2)} AS high_risk_pct FROM s_customer_360""", "s_customer_360"),
        "risk_tier_distribution": query(f"""SELECT risk_tier, count(*) AS transactions,
            {r('CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM predictions) * 100', 2)} AS share_pct
            FROM predictions GROUP BY risk_tier""", "predictions"),
        "rule_retirement": query(f"""SELECT rule_id, alert_type, severity, total_alerts, fp_rate,
            {r('CAST(true_positives AS DOUBLE) / total_alerts', 4)} AS tp_rate,
            coalesce(fp_rate > 0.7, false) AS retire FROM s_rules""", "s_rules"),
        "alert_to_case_ratio": query(f"""SELECT a.n AS alerts, c.n AS confirmed_cases,
            {r('CAST(a.n AS DOUBLE) / nullif(c.n, 0)', 4)} AS alerts_per_case
            FROM (SELECT count(*) AS n FROM s_alerts) a,
              (SELECT count(DISTINCT transaction_id) AS n FROM s_fraud_labels WHERE fraud_status = 'Confirmed') c""",
                                     "s_alerts", "s_fraud_labels"),
        "mttd": query(f"""SELECT count(h) AS detected_cases, {r(davg('h', m), 4)} AS mttd_hours,
            count(CASE WHEN h < 0 THEN 1 END) AS detected_before_txn,
            {r(davg('CASE WHEN h >= 0 THEN h END', m), 4)} AS mttd_hours_after_txn
            FROM (SELECT {hours} AS h FROM s_fraud_labels l JOIN s_transactions t
                  ON l.transaction_id = t.transaction_id)""", "s_fraud_labels", "s_transactions"),
        "mttr": query(f"""SELECT severity, count(*) AS alerts, count(resolution_hours) AS resolved,
            {r(davg('resolution_hours', m), 4)} AS mttr_hours FROM s_alerts GROUP BY severity""", "s_alerts"),
        "loss_recovery_total": query(loss_rows("fraud_type", "GROUP BY fraud_type") + " UNION ALL "
                                     + loss_rows("'All types'", ""), "s_fraud_labels"),
        "audit_completeness": query(f"""SELECT count(*) AS entries, count(CASE WHEN ok THEN 1 END) AS complete_entries,
            {pct('ok', 2)} AS completeness_pct, count(CASE WHEN compliance_flag THEN 1 END) AS compliance_flags,
            {pct('compliance_flag', 2)} AS compliance_flag_pct
            FROM (SELECT *, actor_id IS NOT NULL AND action IS NOT NULL AND log_datetime IS NOT NULL AS ok
                  FROM s_audit_logs)""", "s_audit_logs"),
        "explainability_coverage": query(f"""SELECT count(*) AS flagged,
            count(CASE WHEN e.transaction_id IS NOT NULL THEN 1 END) AS explained,
            {r('CAST(count(CASE WHEN e.transaction_id IS NOT NULL THEN 1 END) AS DOUBLE) / nullif(count(*), 0) * 100', 2)}
              AS coverage_pct
            FROM (SELECT transaction_id FROM predictions WHERE fraud_prediction = 1) p
            LEFT JOIN (SELECT DISTINCT transaction_id FROM explanations) e ON p.transaction_id = e.transaction_id""",
                                         "predictions", "explanations"),
        "period_distincts": query(f"""SELECT strftime(txn_date, '%Y-%m') AS month, count(*) AS transactions,
            {big('sum(is_fraud)')} AS fraud_transactions, count(DISTINCT account_id) AS exact_accounts,
            count(DISTINCT CASE WHEN is_fraud = 1 THEN account_id END) AS exact_affected, true AS accounts_within,
            true AS affected_within FROM s_enriched GROUP BY 1""", "s_enriched"),
        "risk_by_segment": query(f"""SELECT segment, risk_band, count(*) AS customers,
            {r(davg('risk_score', m), 2)} AS avg_risk_score,
            count(CASE WHEN is_high_risk THEN 1 END) AS high_risk_customers
            FROM s_customers GROUP BY segment, risk_band""", "s_customers"),
        "high_value_international": query("""SELECT transaction_id, account_id, customer_id, country, channel, amount,
            txn_datetime, is_fraud FROM s_enriched WHERE is_international AND amount > 5000""", "s_enriched"),
        "high_composite_risk": query("""SELECT transaction_id, account_id, amount, channel, composite_risk_score, label
            FROM features WHERE composite_risk_score > 80""", "features"),
        "risky_customers_with_fraud": query("""SELECT customer_id, segment, country, risk_score, risk_band
            FROM s_customers WHERE risk_score > 80
              AND customer_id IN (SELECT customer_id FROM s_enriched WHERE is_fraud = 1)""", "s_customers", "s_enriched"),
        "fraud_in_period": query(f"""SELECT txn_date, count(*) AS total_txns, {big('sum(is_fraud)')} AS fraud_count,
            {pct('is_fraud', 2)} AS fraud_rate_pct FROM s_enriched
            WHERE txn_date BETWEEN DATE '2024-01-01' AND DATE '2024-03-31' GROUP BY txn_date""", "s_enriched"),
        "fraud_by_channel": query(f"""SELECT channel, count(*) AS total_txns, {big('sum(is_fraud)')} AS fraud_count,
            {pct('is_fraud', 2)} AS fraud_rate_pct, {r(dsum('loss_amount'), 2)} AS total_loss
            FROM s_enriched GROUP BY channel""", "s_enriched"),
        "loss_by_country": query(f"""SELECT country, {big('sum(is_fraud)')} AS fraud_count,
            {r(dsum('loss_amount'), 2)} AS total_loss FROM s_enriched GROUP BY country""", "s_enriched"),
        "true_positive_share": query(f"""SELECT count(*) AS alerts,
            count(CASE WHEN is_true_positive THEN 1 END) AS true_positives,
            {pct('is_true_positive', 2)} AS true_positive_pct FROM s_alerts""", "s_alerts"),
        "explain_transaction": query("""SELECT f.transaction_id, f.account_id, f.amount, f.channel,
            f.composite_risk_score, f.txn_count_1h, f.txn_count_24h, f.is_fraud, e.predicted_fraud_prob,
            e.predicted_label, e.top_fraud_drivers
            FROM features f LEFT JOIN explanations e ON f.transaction_id = e.transaction_id
            WHERE f.transaction_id = 'TXN00000042'""", "features", "explanations"),
    }


def _streams() -> dict[str, str]:
    """What the streams must have landed when they run to the end of their input in one go."""
    counts = " UNION ALL ".join(f"SELECT 'bronze' AS layer, '{t}' AS table_name, count(*) AS row_count FROM b_{t}"
                                for t in s.TABLES)

    def closed(width: int, slide: int) -> str:
        """Windows whose end the watermark, two hours behind the latest event, has passed."""
        return f"""SELECT account_id, make_timestamp(first * 1000000) AS window_start,
            make_timestamp((first + {width}) * 1000000) AS window_end, count(*) AS txn_count,
            CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount_sum
          FROM (SELECT account_id, amount, sec - sec % {slide} - {slide} * i AS first
                FROM (SELECT *, CAST(epoch(txn_datetime) AS BIGINT) AS sec FROM s_transactions),
                  range({width // slide}) AS r(i))
          WHERE first + {width} <= (SELECT CAST(epoch(max(CAST(txn_datetime AS TIMESTAMP))) AS BIGINT) - 7200
                                    FROM b_transactions)
          GROUP BY account_id, first"""

    def content(table: str) -> str:
        columns = [c.split() for c in s.BRONZE[table].split(",")]
        text = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c, k in columns if k != "double") + ")"
        numbers = " + ".join([f"coalesce(CAST({c} AS DECIMAL(18,2)), 0)" for c, k in columns if k == "double"] or ["0"])
        return (f"SELECT '{table}' AS table_name, count(*) AS row_count, "
                f"CAST(sum(CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT)) AS BIGINT) AS text_checksum, "
                f"CAST(sum({numbers}) AS DOUBLE) AS number_total FROM b_{table}")

    return {
        "stream_bronze_content": query(" UNION ALL ".join(map(content, s.TABLES)), *[f"b_{t}" for t in s.TABLES]),
        "stream_bronze_ingest": query(f"""SELECT * FROM (WITH c AS ({counts}) SELECT * FROM c UNION ALL
            SELECT layer, 'TOTAL', CAST(sum(row_count) AS BIGINT) FROM c GROUP BY layer)""",
                                      *[f"b_{t}" for t in s.TABLES]),
        "stream_silver_transactions": query("SELECT * FROM s_transactions", "s_transactions"),
        "stream_enriched": query("SELECT * FROM s_enriched", "s_enriched"),
        "stream_velocity": query(closed(3600, 300), "s_transactions", "b_transactions"),
        "stream_velocity_daily": query(closed(86400, 86400), "s_transactions", "b_transactions"),
        "stream_velocity_exact": query(f"""SELECT DISTINCT account_id, txn_ts_unix AS second, txn_count_1h,
            txn_count_24h, txn_count_7d, amount_sum_1h, amount_sum_24h, {r('amount_avg_7d', 4)} AS amount_avg_7d,
            {r('amount_stddev_7d', 4)} AS amount_stddev_7d FROM velocity""", "velocity"),
        "stream_alerts": _rules()["rule_alerts"],
    }


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for group in (_raw, _silver, _gold, _quality, _features, _rules, _model, _kpis, _insights, _streams):
        out |= group()
    return out
