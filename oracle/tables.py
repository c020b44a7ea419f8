"""Named building blocks of the check SQL (DuckDB dialect), from the given tables upwards.

Written on its own terms: plain windows, plain joins, no reuse of the Spark code beyond value lists.
"""

from __future__ import annotations

from ledgerlens import schemas as s


def listed(values: list[str], index: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][1 + ({index})]"


def r(x: str, digits: int) -> str:
    """Half-up rounding through a decimal."""
    return f"CAST(round(CAST({x} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def dsum(x: str, kind: str = "DECIMAL(18,2)") -> str:
    return f"CAST(sum(CAST({x} AS {kind})) AS DOUBLE)"


def davg(x: str, kind: str = "DECIMAL(18,2)") -> str:
    return f"(CAST(sum(CAST({x} AS {kind})) AS DOUBLE) / CAST(nullif(count({x}), 0) AS DOUBLE))"


def pct(flag: str, digits: int) -> str:
    return r(f"CAST(sum(CAST({flag} AS INT)) AS DOUBLE) / CAST(nullif(count({flag}), 0) AS DOUBLE) * 100", digits)


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


def _latest(table: str, prefer: str) -> str:
    key = s.PRIMARY_KEY[table]
    columns = [c.split()[0] for c in s.BRONZE[table].split(",")]
    order = [prefer] + [c for c in columns if c not in (key, prefer)]
    by = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {by}) AS rn "
            f"FROM b_{table}) WHERE rn = 1")


BLOCKS: dict[str, tuple[str, tuple[str, ...]]] = {}


def block(name: str, sql: str, *needs: str) -> None:
    BLOCKS[name] = (sql, needs)


def query(final: str, *needs: str) -> str:
    """The final SELECT with the blocks it needs, in order of dependence."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for n in BLOCKS[name][1]:
                visit(n)
            order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({BLOCKS[n][0]})" for n in order) + "\n" + final


# ---------------------------------------------------------------- raw tables
block("b_customers", f"""
SELECT printf('CUST%05d', c_custkey) AS customer_id, c_name AS full_name,
  'customer_' || c_custkey || '@example.com' AS email,
  '+1-' || (200 + c_custkey % 800) || '-' || (1000000 + c_custkey) AS phone,
  n_name AS country, c_mktsegment AS segment,
  CASE WHEN c_custkey % 20 < 14 THEN 'Verified' WHEN c_custkey % 20 < 17 THEN 'Pending'
       WHEN c_custkey % 20 < 18 THEN 'Rejected' ELSE 'Under Review' END AS kyc_status,
  CAST(CAST((CAST(c_acctbal AS DECIMAL(12,2)) + 1000) * 0.009 AS DECIMAL(6,2)) AS DOUBLE) AS risk_score,
  strftime(DATE '2019-01-01' + CAST(c_custkey % 2000 AS INT), '%Y-%m-%d') AS date_joined,
  c_custkey % 33 = 0 AS is_pep, c_custkey % 100 = 0 AS is_sanctioned
FROM customer JOIN nation ON c_nationkey = n_nationkey""")

block("b_accounts", f"""
SELECT printf('ACCT%07d', c_custkey) AS account_id,
  CASE WHEN c_custkey % 401 = 400 THEN NULL ELSE printf('CUST%05d', c_custkey // 2) END AS customer_id,
  {listed(s.ACCOUNT_TYPES, 'c_custkey % 6')} AS account_type, {listed(s.CURRENCIES, 'c_custkey % 8')} AS currency,
  CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 50 AS DOUBLE) AS balance,
  CASE WHEN c_custkey % 6 = 2 THEN CAST(1000 + c_custkey % 100 * 990 AS DOUBLE) END AS credit_limit,
  CASE WHEN c_custkey % 30 < 24 THEN 'Active' WHEN c_custkey % 30 < 27 THEN 'Dormant'
       WHEN c_custkey % 30 < 29 THEN 'Suspended' ELSE 'Closed' END AS status,
  strftime(DATE '2021-01-01' + CAST(c_custkey % 1000 AS INT), '%Y-%m-%d') AS open_date,
  'BR' || (100 + c_custkey % 900) AS branch_code, c_custkey % 20 < 3 AS is_joint
FROM customer""")

block("b_merchants", f"""
SELECT printf('MERCH%05d', s_suppkey) AS merchant_id, s_name AS merchant_name,
  {listed(s.MCC_CODES, 's_suppkey % 10')} AS mcc_code, {listed(s.MCC_LABELS, 's_suppkey % 10')} AS mcc_description,
  n_name AS country,
  CASE WHEN s_suppkey % 20 < 10 THEN 'Low' WHEN s_suppkey % 20 < 16 THEN 'Medium'
       WHEN s_suppkey % 20 < 19 THEN 'High' ELSE 'Very High' END AS risk_level,
  s_suppkey % 50 = 0 AS is_blacklisted, CAST(abs(CAST(s_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS avg_txn_amount,
  strftime(DATE '2018-01-01' + CAST(s_suppkey % 1500 AS INT), '%Y-%m-%d') AS registered_date
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")

block("ev", """
SELECT event_id, date_trunc('second', ts) AS ts, user_id, event_type, value,
  CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events""")

block("b_transactions", f"""
SELECT printf('TXN%08d', event_id) AS transaction_id,
  CASE WHEN event_id % 211 = 210 THEN NULL
       ELSE printf('ACCT%07d', CASE WHEN event_id % 11 = 0 THEN 0 ELSE user_id END) END AS account_id,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE printf('MERCH%05d', k) END AS merchant_id,
  {listed(s.TRANSACTION_TYPES, 'event_id % 10')} AS transaction_type,
  CASE event_type WHEN 'view' THEN 'Mobile' WHEN 'click' THEN 'Web' WHEN 'signup' THEN 'API'
    WHEN 'purchase' THEN 'POS' ELSE CASE WHEN user_id % 2 = 0 THEN 'ATM' ELSE 'Branch' END END AS channel,
  CAST(CASE WHEN event_id % 101 = 100 THEN CAST(0 AS DECIMAL(18,2))
            WHEN event_id % 7 = 0 THEN CAST(floor(value) AS DECIMAL(12,0)) * 100
            ELSE CAST(value AS DECIMAL(12,2)) * 97 END AS DOUBLE) AS amount,
  {listed(s.CURRENCIES, 'user_id % 8')} AS currency,
  {TS.format('ts')} AS txn_datetime, strftime(ts, '%Y-%m-%d') AS txn_date, CAST(hour(ts) AS INT) AS txn_hour,
  event_id % 20 < 3 AS is_international,
  CASE WHEN event_id % 2 = 1 THEN NULL ELSE printf('ACCT%07d', k % 15) END AS counterparty_id,
  '10.' || (user_id % 256) || '.' || k || '.1' AS ip_address,
  'DEV' || (10000 + user_id * 31 + event_id % 4) AS device_id,
  CASE WHEN event_id % 97 = 96 THEN 'Unknown' WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'Declined'
       WHEN event_id % 50 = 1 THEN 'Pending' WHEN event_id % 50 = 2 THEN 'Reversed' ELSE 'Completed' END AS status,
  {listed(s.RESPONSE_CODES, 'event_id % 5')} AS response_code
FROM (SELECT * FROM ev UNION ALL SELECT * FROM ev WHERE event_id % 53 = 0)""", "ev")

block("b_fraud_labels", f"""
SELECT printf('FRD%06d', o_orderkey) AS fraud_id, printf('TXN%08d', o_orderkey) AS transaction_id,
  {listed(s.FRAUD_TYPES, 'o_custkey % 9')} AS fraud_type,
  CASE WHEN o_orderkey % 10 < 4 THEN 'Confirmed' WHEN o_orderkey % 10 < 7 THEN 'Under Investigation'
       WHEN o_orderkey % 10 < 9 THEN 'False Positive' ELSE 'Resolved' END AS fraud_status,
  {listed(s.REPORTERS, 'o_custkey % 6')} AS reported_by,
  {TS.format("moment + to_hours(CAST(o_orderkey % 72 + 1 AS INT))")} AS detected_datetime,
  {TS.format("moment + to_hours(CAST(o_orderkey % 72 + 1 + o_custkey % 72 + 1 AS INT))")} AS confirmed_datetime,
  CASE WHEN o_orderkey % 199 = 0 THEN 0.0::DOUBLE
       ELSE CAST(CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 0.1 AS DECIMAL(12,2)) AS DOUBLE) END AS loss_amount,
  CAST(CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 0.001 * CAST(o_orderkey % 40 AS DECIMAL(4,0)) AS DECIMAL(12,2))
       AS DOUBLE) AS recovered_amount,
  'INV' || (100 + o_custkey % 100) AS investigator_id, 'rule R' || (100 + o_orderkey % 900) AS notes
FROM (SELECT orders.*, coalesce(ts, TIMESTAMP '2024-01-15 00:00:00') AS moment
      FROM orders LEFT JOIN ev ON o_orderkey = event_id WHERE o_orderstatus = 'F')""", "ev")

block("b_alerts", f"""
SELECT printf('ALT%07d', l_orderkey * 10 + l_linenumber) AS alert_id, printf('TXN%08d', l_orderkey) AS transaction_id,
  'R' || (100 + l_suppkey % 60) AS rule_id, kind AS alert_type,
  CASE WHEN l_quantity % 10 < 3 THEN 'Low' WHEN l_quantity % 10 < 7 THEN 'Medium'
       WHEN l_quantity % 10 < 9 THEN 'High' ELSE 'Critical' END AS severity,
  CASE WHEN l_partkey % 20 < 4 THEN 'Open' WHEN l_partkey % 20 < 9 THEN 'Reviewed'
       WHEN l_partkey % 20 < 11 THEN 'Escalated' WHEN l_partkey % 20 < 16 THEN 'Closed - True Positive'
       ELSE 'Closed - False Positive' END AS alert_status,
  CAST(points AS DOUBLE) AS score, {TS.format('created')} AS created_datetime,
  CASE WHEN l_partkey % 5 = 0 THEN NULL
       ELSE {TS.format('created + to_hours(CAST(l_suppkey % 96 + 1 AS INT))')} END AS resolved_datetime,
  'ANL' || (200 + l_suppkey % 100) AS analyst_id, l_partkey % 20 < 7 AS false_positive,
  kind || ': ' || CAST(points AS VARCHAR) || ' points' AS explanation
FROM (SELECT lineitem.*, {listed(s.ALERT_TYPES, 'l_partkey % 10')} AS kind,
        CAST(0.5 + CAST(l_discount AS DECIMAL(12,2)) * 5 AS DECIMAL(6,4)) AS points,
        coalesce(ts, TIMESTAMP '2024-01-15 00:00:00') + to_hours(l_linenumber) AS created
      FROM lineitem LEFT JOIN ev ON l_orderkey = event_id
      WHERE l_returnflag = 'R' AND l_linestatus = 'F')""", "ev")

block("b_audit_logs", f"""
SELECT printf('LOG%08d', event_id) AS log_id, {listed(s.ENTITY_TYPES, 'event_id % 4')} AS entity_type,
  printf('ACCT%07d', user_id) AS entity_id, {listed(s.AUDIT_ACTIONS, '(event_id // 5) % 12')} AS action,
  {listed(s.AUDIT_ACTORS, 'user_id % 6')} AS actor_type, 'USR' || (1000 + user_id) AS actor_id,
  {TS.format('ts')} AS log_datetime, '10.' || (user_id % 256) || '.' || k || '.1' AS ip_address,
  md5(CAST(event_id AS VARCHAR)) AS session_id,
  CASE WHEN k % 20 < 17 THEN 'Success' WHEN k % 20 < 19 THEN 'Failure' ELSE 'Warning' END AS status,
  'Field updated by ' || {listed(s.AUDIT_ACTORS, 'user_id % 6')} || ' on ' || strftime(ts, '%Y-%m-%d')
    AS change_summary, k % 100 < 8 AS compliance_flag
FROM ev""", "ev")

# ---------------------------------------------------------------- silver, both profiles
for _table, _prefer in {
    "customers": "date_joined", "accounts": "open_date", "merchants": "registered_date",
    "transactions": "txn_datetime", "fraud_labels": "detected_datetime", "alerts": "created_datetime",
    "audit_logs": "log_datetime",
}.items():
    block(f"u_{_table}", _latest(_table, _prefer), f"b_{_table}")


def _bands(edges: tuple[int, int, int], op: str) -> str:
    low, mid, high = edges
    return (f"CASE WHEN risk_score {op} {low} THEN 'Low' WHEN risk_score {op} {mid} THEN 'Medium' "
            f"WHEN risk_score {op} {high} THEN 'High' ELSE 'Critical' END")


HOURS = "(epoch({0}) - epoch({1})) / 3600"

block("s_customers", f"""SELECT * REPLACE (CAST(date_joined AS DATE) AS date_joined),
  {_bands((25, 50, 75), '<')} AS risk_band, is_pep OR is_sanctioned OR risk_score > 75 AS is_high_risk
FROM u_customers WHERE customer_id IS NOT NULL""", "u_customers")
block("p_customers", f"""SELECT * REPLACE (CAST(date_joined AS DATE) AS date_joined),
  {_bands((30, 60, 80), '<=')} AS risk_band, risk_score > 70 OR is_pep OR is_sanctioned AS is_high_risk
FROM b_customers""", "b_customers")
block("s_accounts", """SELECT * REPLACE (CAST(open_date AS DATE) AS open_date), balance < 0 AS is_overdrawn,
  CAST(DATE '2024-02-01' - CAST(open_date AS DATE) AS INT) AS account_age_days
FROM u_accounts WHERE account_id IS NOT NULL AND customer_id IS NOT NULL""", "u_accounts")
block("p_accounts", """SELECT * REPLACE (CAST(open_date AS DATE) AS open_date), balance < 0 AS is_overdrawn
FROM b_accounts""", "b_accounts")
_RISKY = "risk_level IN ('High', 'Very High') OR is_blacklisted AS is_high_risk_merchant"
block("s_merchants", f"""SELECT * REPLACE (CAST(registered_date AS DATE) AS registered_date), {_RISKY}
FROM u_merchants WHERE NOT is_blacklisted""", "u_merchants")
block("p_merchants", f"SELECT *, {_RISKY} FROM b_merchants", "b_merchants")
_TXN = """* REPLACE (CAST(txn_datetime AS TIMESTAMP) AS txn_datetime, CAST(txn_date AS DATE) AS txn_date),
  amount > 10000 AS is_high_value, {odd} AS is_odd_hour, status = 'Declined' AS is_declined"""
block("s_transactions", f"""SELECT {_TXN.format(odd='txn_hour BETWEEN 0 AND 5')},
  CAST(week(CAST(txn_date AS DATE)) AS INT) AS week_of_year, CAST(month(CAST(txn_date AS DATE)) AS INT) AS month
FROM u_transactions WHERE transaction_id IS NOT NULL AND account_id IS NOT NULL AND amount > 0
  AND status IN ('Completed', 'Pending', 'Declined', 'Reversed')""", "u_transactions")
block("p_transactions", f"SELECT {_TXN.format(odd='(txn_hour < 6 OR txn_hour > 22)')} FROM b_transactions",
      "b_transactions")
_LABEL = """* REPLACE (CAST(detected_datetime AS TIMESTAMP) AS detected_datetime,
                     CAST(confirmed_datetime AS TIMESTAMP) AS confirmed_datetime),
  {rate} AS recovery_rate, %s AS hours_to_confirm,
  fraud_status IN ('Confirmed', 'Resolved') AS is_resolved""" % HOURS.format(
    "CAST(confirmed_datetime AS TIMESTAMP)", "CAST(detected_datetime AS TIMESTAMP)")
block("s_fraud_labels", f"""SELECT {_LABEL.format(rate=r('recovered_amount / nullif(loss_amount, 0)', 4))}
FROM u_fraud_labels WHERE transaction_id IS NOT NULL""", "u_fraud_labels")
block("p_fraud_labels", f"""SELECT {_LABEL.format(
    rate='CASE WHEN loss_amount > 0 THEN recovered_amount / loss_amount END')} FROM b_fraud_labels""",
      "b_fraud_labels")
_ALERT = """* REPLACE (CAST(created_datetime AS TIMESTAMP) AS created_datetime,
                     CAST(resolved_datetime AS TIMESTAMP) AS resolved_datetime),
  %s AS resolution_hours, alert_status LIKE '%%True Positive%%' AS is_true_positive""" % HOURS.format(
    "CAST(resolved_datetime AS TIMESTAMP)", "CAST(created_datetime AS TIMESTAMP)")
block("s_alerts", f"SELECT {_ALERT} FROM u_alerts WHERE transaction_id IS NOT NULL", "u_alerts")
block("p_alerts", f"SELECT {_ALERT} FROM b_alerts", "b_alerts")
_LOG = "* REPLACE (CAST(log_datetime AS TIMESTAMP) AS log_datetime), status = 'Failure' AS is_failure"
block("s_audit_logs", f"SELECT {_LOG}, CAST(log_datetime AS DATE) AS log_date FROM u_audit_logs "
      "WHERE log_id IS NOT NULL", "u_audit_logs")
block("p_audit_logs", f"SELECT {_LOG} FROM b_audit_logs", "b_audit_logs")

# ---------------------------------------------------------------- gold, both profiles
for _p in ("s", "p"):
    _int = _p == "s"
    _cnt = (lambda f: f"CAST(sum(CAST({f} AS INT)) AS BIGINT)") if _int else (
        lambda f: f"CAST(coalesce(sum(CAST({f} AS INT)), 0) AS BIGINT)")
    block(f"{_p}_account_stats", f"""SELECT account_id, count(transaction_id) AS total_txns,
      {dsum('amount')} AS total_amount, {davg('amount')} AS avg_txn_amount, max(amount) AS max_txn_amount,
      {_cnt('is_high_value')} AS high_value_txn_count, {_cnt('is_international')} AS intl_txn_count,
      {_cnt('is_declined')} AS decline_count, {_cnt('is_odd_hour')} AS odd_hour_txn_count
    FROM {_p}_transactions GROUP BY account_id""", f"{_p}_transactions")
    block(f"{_p}_customer_360", f"""SELECT c.*, a.* EXCLUDE (customer_id), t.* EXCLUDE (customer_id)
    FROM {_p}_customers c
    LEFT JOIN (SELECT customer_id, count(*) AS num_accounts, {dsum('balance')} AS total_balance,
                 {_cnt('is_overdrawn')} AS overdrawn_accounts FROM {_p}_accounts GROUP BY customer_id) a
      ON c.customer_id = a.customer_id
    LEFT JOIN (SELECT customer_id, CAST(sum(n) AS BIGINT) AS lifetime_txns, {dsum('spend')} AS lifetime_spend,
                 CAST(sum(hv) AS BIGINT) AS high_value_txns, CAST(sum(dec) AS BIGINT) AS total_declines,
                 CAST(sum(intl) AS BIGINT) AS intl_txns
               FROM (SELECT a.customer_id, 1 AS n, amount AS spend, CAST(is_high_value AS INT) AS hv,
                       CAST(is_declined AS INT) AS dec, CAST(is_international AS INT) AS intl
                     FROM {_p}_transactions t JOIN {_p}_accounts a ON t.account_id = a.account_id)
               GROUP BY customer_id) t
      ON c.customer_id = t.customer_id""", f"{_p}_customers", f"{_p}_accounts", f"{_p}_transactions")
    _hit = "CAST(bool_or(is_true_positive) AS INT)" if _int else "bool_or(is_true_positive)"
    block(f"{_p}_alerts_per_transaction", f"""SELECT transaction_id, count(*) AS alert_count,
      max(score) AS max_alert_score, {_hit} AS has_true_positive_alert
    FROM {_p}_alerts GROUP BY transaction_id""", f"{_p}_alerts")
    _alerts = "coalesce(n.alert_count, 0)" if _int else "n.alert_count"
    _fraud = "CAST(l.fraud_type IS NOT NULL AS INT)" if _int else "l.fraud_type IS NOT NULL"
    block(f"{_p}_enriched", f"""SELECT t.*, a.customer_id, a.account_type, a.currency AS account_currency,
      a.status AS account_status, c.segment, c.country, c.risk_score, c.risk_band, c.kyc_status, c.is_pep,
      c.is_sanctioned, c.is_high_risk, m.mcc_code, m.mcc_description, m.risk_level, m.is_high_risk_merchant,
      l.fraud_type, l.fraud_status AS fraud_label_status, l.loss_amount, l.is_resolved,
      {_alerts} AS alert_count, n.max_alert_score, n.has_true_positive_alert, {_fraud} AS is_fraud
    FROM {_p}_transactions t
    LEFT JOIN {_p}_accounts a ON t.account_id = a.account_id
    LEFT JOIN {_p}_customers c ON a.customer_id = c.customer_id
    LEFT JOIN {_p}_merchants m ON t.merchant_id = m.merchant_id
    LEFT JOIN {_p}_fraud_labels l ON t.transaction_id = l.transaction_id
    LEFT JOIN {_p}_alerts_per_transaction n ON t.transaction_id = n.transaction_id""",
          f"{_p}_transactions", f"{_p}_accounts", f"{_p}_customers", f"{_p}_merchants", f"{_p}_fraud_labels",
          f"{_p}_alerts_per_transaction")
    _rate = "CAST(sum(CAST(is_fraud AS INT)) AS DOUBLE) / count(*)"
    _loss = "loss_amount" if _int else "CASE WHEN is_fraud THEN loss_amount ELSE 0 END"
    block(f"{_p}_daily", f"""SELECT txn_date, account_type, channel, count(*) AS total_txns,
      {dsum('amount')} AS total_volume, {big('sum(CAST(is_fraud AS INT))')} AS fraud_count,
      {dsum(_loss)} AS total_loss, {davg('max_alert_score', 'DECIMAL(18,4)')} AS avg_alert_score,
      {big('sum(coalesce(alert_count, 0))')} AS total_alerts, {_cnt('is_declined')} AS total_declines,
      {r(_rate, 4) if _int else _rate} AS fraud_rate
    FROM {_p}_enriched GROUP BY txn_date, account_type, channel""", f"{_p}_enriched")
    _fp = "CAST(sum(CAST(false_positive AS INT)) AS DOUBLE) / count(*)"
    block(f"{_p}_rules", f"""SELECT rule_id, alert_type, severity, count(*) AS total_alerts,
      {_cnt('is_true_positive')} AS true_positives, {_cnt('false_positive')} AS false_positives,
      {big('count(CASE WHEN fraud_id IS NOT NULL THEN 1 END)')} AS confirmed_frauds,
      {davg('score', 'DECIMAL(18,4)')} AS avg_score,
      {davg('resolution_hours', 'DECIMAL(28,10)')} AS avg_resolution_hours,
      {r(_fp, 4) if _int else _fp} AS fp_rate
    FROM {_p}_alerts a LEFT JOIN (SELECT transaction_id, fraud_id FROM {_p}_fraud_labels) l
      ON a.transaction_id = l.transaction_id
    GROUP BY rule_id, alert_type, severity""", f"{_p}_alerts", f"{_p}_fraud_labels")

# ---------------------------------------------------------------- features
_FRAME = "(PARTITION BY account_id ORDER BY txn_ts_unix RANGE BETWEEN {0} PRECEDING AND CURRENT ROW)"
block("velocity", f"""SELECT *, count(transaction_id) OVER h1 AS txn_count_1h,
  count(transaction_id) OVER h24 AS txn_count_24h, count(transaction_id) OVER d7 AS txn_count_7d,
  CAST(sum(CAST(amount AS DECIMAL(18,2))) OVER h1 AS DOUBLE) AS amount_sum_1h,
  CAST(sum(CAST(amount AS DECIMAL(18,2))) OVER h24 AS DOUBLE) AS amount_sum_24h,
  CAST(sum(CAST(amount AS DECIMAL(18,2))) OVER d7 AS DOUBLE) / count(amount) OVER d7 AS amount_avg_7d,
  stddev_samp(amount) OVER d7 AS amount_stddev_7d,
  count(DISTINCT merchant_id) OVER h24 AS unique_merchants_24h, max(amount) OVER d7 AS amount_max_7d
FROM (SELECT *, CAST(epoch(txn_datetime) AS BIGINT) AS txn_ts_unix FROM s_enriched)
WINDOW h1 AS {_FRAME.format(3600)}, h24 AS {_FRAME.format(86400)}, d7 AS {_FRAME.format(604800)}""", "s_enriched")
block("terms", """SELECT *,
  CASE WHEN amount_stddev_7d > 0 THEN (amount - amount_avg_7d) / amount_stddev_7d ELSE 0.0 END AS amount_zscore,
  CAST(CAST(is_international AS INT) * 2 + CAST(is_odd_hour AS INT) * 1.5 + CAST(is_high_risk_merchant AS INT) * 2
       AS DOUBLE) AS geo_risk_score,
  CASE channel WHEN 'API' THEN 3 WHEN 'Web' THEN 2 WHEN 'Mobile' THEN 1 ELSE 0 END AS channel_risk
FROM velocity""", "velocity")
block("features", f"""SELECT *, {r('least(100.0, risk_score * 0.3::DOUBLE + abs(amount_zscore) * 10 + geo_risk_score * 5 '
  '+ channel_risk * 3 + txn_count_1h * 2)', 2)} AS composite_risk_score,
  CAST(txn_count_1h > 5 OR txn_count_24h > 20 AS INT) AS is_high_velocity,
  CAST(amount % 100 = 0 AND amount > 500 AS INT) AS is_round_amount, is_fraud AS label
FROM terms""", "terms")
block("scored", """SELECT transaction_id, composite_risk_score / 100 AS fraud_probability, label FROM features""",
      "features")
block("predictions", """SELECT transaction_id, fraud_probability,
  CAST(fraud_probability >= 0.5 AS INT) AS fraud_prediction,
  CASE WHEN fraud_probability <= 0 OR fraud_probability > 1 THEN NULL
       WHEN fraud_probability <= 0.3 THEN 'Low' WHEN fraud_probability <= 0.6 THEN 'Medium'
       WHEN fraud_probability <= 0.85 THEN 'High' ELSE 'Critical' END AS risk_tier
FROM scored""", "scored")
block("contributions", """
  SELECT transaction_id, 0 AS pos, 'risk_score' AS feature, coalesce(risk_score * 0.3::DOUBLE, 0) AS value FROM features
  UNION ALL SELECT transaction_id, 1, 'amount_zscore', coalesce(abs(amount_zscore) * 10, 0) FROM features
  UNION ALL SELECT transaction_id, 2, 'geo_risk_score', coalesce(geo_risk_score * 5, 0) FROM features
  UNION ALL SELECT transaction_id, 3, 'channel_risk', coalesce(channel_risk * 3, 0) FROM features
  UNION ALL SELECT transaction_id, 4, 'txn_count_1h', coalesce(txn_count_1h * 2, 0) FROM features""", "features")
block("explanations", """SELECT p.transaction_id, p.fraud_probability AS predicted_fraud_prob,
  p.fraud_prediction AS predicted_label, d.top_fraud_drivers
FROM predictions p JOIN (
  SELECT transaction_id, string_agg(printf('%s(%+.3f)', feature, value), ', ' ORDER BY rn) AS top_fraud_drivers
  FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY abs(value) DESC, pos) AS rn
        FROM contributions) WHERE rn <= 3 GROUP BY transaction_id) d ON p.transaction_id = d.transaction_id""",
      "predictions", "contributions")
