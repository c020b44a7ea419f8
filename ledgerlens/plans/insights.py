"""Operational, financial and compliance metrics, and the analysts' standing questions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.measures import exact_avg, exact_sum, hours_between, percent_true, ratio, rounded
from ledgerlens.plans.kpis import in_period

_c = F.col
MEASURE = "decimal(28,8)"

# ---- fixed values: thresholds of the metrics ---------------------------------------------------
RETIRE_ABOVE_FP_RATE = 0.70
SPIKE_FACTOR = 2.0
TRAILING_DAYS = 7
HIGH_VALUE_INTERNATIONAL = 5_000
HIGH_COMPOSITE = 80
RISKY_CUSTOMER = 80
# ------------------------------------------------------------------------------------------------


def suspicion_rate_daily(enriched: DataFrame) -> DataFrame:
    """Suspicious volume per day and channel; a spike is twice the mean of the 7 days listed before."""
    daily = enriched.groupBy("txn_date", "channel").agg(
        F.count(F.lit(1)).alias("total_txns"),
        F.sum(_c("is_fraud").cast("long")).alias("suspicious_txns"))
    earlier = Window.partitionBy("channel").orderBy("txn_date").rowsBetween(-TRAILING_DAYS, -1)
    usual = ratio(F.sum("suspicious_txns").over(earlier), F.count("suspicious_txns").over(earlier))
    return daily.withColumn("usual", usual).select(
        "txn_date", "channel", "total_txns", "suspicious_txns",
        rounded(ratio("suspicious_txns", "total_txns"), 4).alias("suspicion_rate"),
        rounded("usual", 4).alias("trailing_mean"),
        F.coalesce(_c("suspicious_txns") > _c("usual") * SPIKE_FACTOR, F.lit(False)).alias("is_spike"),
    )


def high_risk_share(customer_view: DataFrame) -> DataFrame:
    return customer_view.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if("is_high_risk").alias("high_risk_customers"),
        percent_true(F.coalesce("is_high_risk", F.lit(False)), 2).alias("high_risk_pct"),
    )


def risk_tier_distribution(predictions: DataFrame) -> DataFrame:
    """Transactions per tier and their share; the share is taken over the handful of tiers."""
    tiers = predictions.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("transactions"))
    total = predictions.agg(F.count(F.lit(1)).alias("n"))
    return tiers.withColumn("share_pct", rounded(ratio("transactions", total.scalar()) * 100, 2))


def rule_retirement(rule_performance: DataFrame) -> DataFrame:
    """True- and false-positive rate per rule and whether the rule is due for retirement."""
    return rule_performance.select(
        "rule_id", "alert_type", "severity", "total_alerts", "fp_rate",
        rounded(ratio("true_positives", "total_alerts"), 4).alias("tp_rate"),
        F.coalesce(_c("fp_rate") > RETIRE_ABOVE_FP_RATE, F.lit(False)).alias("retire"),
    )


def alert_to_case_ratio(alerts: DataFrame, labels: DataFrame) -> DataFrame:
    """Alerts raised per distinct transaction with a confirmed case."""
    raised = alerts.agg(F.count(F.lit(1)).alias("alerts"))
    cases = labels.where("fraud_status = 'Confirmed'").agg(
        F.countDistinct("transaction_id").alias("confirmed_cases"))
    return cases.select(
        raised.scalar().alias("alerts"), "confirmed_cases",
    ).withColumn("alerts_per_case", rounded(ratio("alerts", "confirmed_cases"), 4))


def mean_time_to_detect(labels: DataFrame, transactions: DataFrame) -> DataFrame:
    """Hours from transaction to detection; detections dated before the transaction are told apart."""
    paired = labels.select("transaction_id", "detected_datetime").join(
        transactions.select("transaction_id", "txn_datetime"), "transaction_id")
    hours = paired.select(hours_between("detected_datetime", "txn_datetime").alias("hours"))
    return hours.agg(
        F.count("hours").alias("detected_cases"),
        rounded(exact_avg("hours", MEASURE), 4).alias("mttd_hours"),
        F.count_if(_c("hours") < 0).alias("detected_before_txn"),
        rounded(exact_avg(F.when(_c("hours") >= 0, _c("hours")), MEASURE), 4).alias("mttd_hours_after_txn"),
    )


def mean_time_to_resolve(alerts: DataFrame) -> DataFrame:
    """Hours from alert to resolution per severity."""
    return alerts.groupBy("severity").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.count("resolution_hours").alias("resolved"),
        rounded(exact_avg("resolution_hours", MEASURE), 4).alias("mttr_hours"),
    )


def loss_recovery_total(labels: DataFrame) -> DataFrame:
    """Loss and recovery per fraud type and in all: recovered over lost, not a mean of ratios."""
    return labels.rollup("fraud_type").agg(
        F.grouping("fraud_type").alias("is_total"),
        F.count(F.lit(1)).alias("cases"),
        exact_sum("loss_amount").alias("total_loss"),
        exact_sum("recovered_amount").alias("total_recovered"),
    ).select(
        F.when(_c("is_total") == 1, F.lit("All types")).otherwise(_c("fraud_type")).alias("fraud_type"),
        "cases", "total_loss", "total_recovered",
        rounded(ratio("total_recovered", "total_loss"), 4).alias("recovery_rate"),
    )


def audit_completeness(audit_logs: DataFrame) -> DataFrame:
    """Share of audit entries that name actor, action and time, and share flagged for compliance."""
    complete = (_c("actor_id").isNotNull() & _c("action").isNotNull() & _c("log_datetime").isNotNull())
    return audit_logs.agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_if(complete).alias("complete_entries"),
        percent_true(complete, 2).alias("completeness_pct"),
        F.count_if("compliance_flag").alias("compliance_flags"),
        percent_true("compliance_flag", 2).alias("compliance_flag_pct"),
    )


def explainability_coverage(predictions: DataFrame, explanations: DataFrame) -> DataFrame:
    """How many of the flagged transactions have an explanation."""
    explained = explanations.where("top_fraud_drivers <> ''").select("transaction_id").distinct().withColumn(
        "explained", F.lit(True))
    return (
        predictions.where("fraud_prediction = 1").select("transaction_id")
        .join(explained, "transaction_id", "left")
        .agg(F.count(F.lit(1)).alias("flagged"), F.count_if("explained").alias("explained"))
        .withColumn("coverage_pct", rounded(ratio("explained", "flagged") * 100, 2))
    )


def risk_by_segment(customers: DataFrame) -> DataFrame:
    return customers.groupBy("segment", "risk_band").agg(
        F.count(F.lit(1)).alias("customers"),
        rounded(exact_avg("risk_score", MEASURE), 2).alias("avg_risk_score"),
        F.count_if("is_high_risk").alias("high_risk_customers"),
    )


def high_value_international(enriched: DataFrame, above: float = HIGH_VALUE_INTERNATIONAL) -> DataFrame:
    return enriched.where(_c("is_international") & (_c("amount") > above)).select(
        "transaction_id", "account_id", "customer_id", "country", "channel", "amount", "txn_datetime", "is_fraud")


def high_composite_risk(features: DataFrame, above: float = HIGH_COMPOSITE) -> DataFrame:
    return features.where(_c("composite_risk_score") > above).select(
        "transaction_id", "account_id", "amount", "channel", "composite_risk_score", "label")


def risky_customers_with_fraud(customers: DataFrame, enriched: DataFrame, above: float = RISKY_CUSTOMER) -> DataFrame:
    """Customers with a high score who had at least one labelled transaction."""
    hit = enriched.where("is_fraud = 1").select("customer_id")
    return customers.where(_c("risk_score") > above).join(hit, "customer_id", "left_semi").select(
        "customer_id", "segment", "country", "risk_score", "risk_band")


def fraud_in_period(enriched: DataFrame, start: str, end: str) -> DataFrame:
    """Daily fraud figures of a period."""
    return in_period(enriched, start, end).groupBy("txn_date").agg(
        F.count(F.lit(1)).alias("total_txns"),
        F.sum(_c("is_fraud").cast("long")).alias("fraud_count"),
        percent_true("is_fraud", 2).alias("fraud_rate_pct"),
    )


def fraud_by_channel(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("channel").agg(
        F.count(F.lit(1)).alias("total_txns"),
        F.sum(_c("is_fraud").cast("long")).alias("fraud_count"),
        percent_true("is_fraud", 2).alias("fraud_rate_pct"),
        rounded(exact_sum("loss_amount"), 2).alias("total_loss"),
    )


def loss_by_country(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("country").agg(
        F.sum(_c("is_fraud").cast("long")).alias("fraud_count"),
        rounded(exact_sum("loss_amount"), 2).alias("total_loss"),
    )


def true_positive_share(alerts: DataFrame) -> DataFrame:
    return alerts.agg(
        F.count(F.lit(1)).alias("alerts"),
        F.count_if("is_true_positive").alias("true_positives"),
        percent_true("is_true_positive", 2).alias("true_positive_pct"),
    )


def explain_transaction(transaction_id: str, features: DataFrame, explanations: DataFrame) -> DataFrame:
    """Why one transaction was flagged; the key filter reaches both scans."""
    facts = features.where(_c("transaction_id") == transaction_id).select(
        "transaction_id", "account_id", "amount", "channel", "composite_risk_score", "txn_count_1h",
        "txn_count_24h", "is_fraud")
    why = explanations.where(_c("transaction_id") == transaction_id).select(
        "transaction_id", "predicted_fraud_prob", "predicted_label", "top_fraud_drivers")
    return facts.join(why, "transaction_id", "left")


def row_counts(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Rows per table and layer, and the total of each layer."""
    counted = None
    for layer, tables in layers.items():
        for name, df in tables.items():
            one = df.agg(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"),
                         F.count(F.lit(1)).alias("row_count"))
            counted = one if counted is None else counted.unionByName(one)
    totals = counted.groupBy("layer").agg(F.sum("row_count").alias("row_count")).select(
        "layer", F.lit("TOTAL").alias("table_name"), "row_count")
    return counted.unionByName(totals)


def day_of_partition(enriched: DataFrame, day: str) -> DataFrame:
    """One day of a date-partitioned table: only that day's files are read."""
    return in_period(enriched, day, day).groupBy("channel").agg(
        F.count(F.lit(1)).alias("transactions"), exact_sum("amount").alias("volume"))
