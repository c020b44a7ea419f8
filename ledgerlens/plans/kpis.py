"""The ten dashboard queries. Ordered outputs carry a unique tie-break, so that a top-n is repeatable."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.measures import MONEY, exact_avg, exact_sum, percent_true, rounded

_c = F.col
MEASURE = "decimal(28,8)"


def _fraud_figures(digits: int):
    return [
        F.count(F.lit(1)).alias("total_txns"),
        F.sum(_c("is_fraud").cast("long")).alias("fraud_count"),
        percent_true("is_fraud", digits).alias("fraud_rate_pct"),
    ]


def _loss(digits: int):
    return rounded(exact_sum("loss_amount"), digits)


def in_period(df: DataFrame, start: date | str | None = None, end: date | str | None = None) -> DataFrame:
    """Rows whose transaction date lies in the closed period; prunes date partitions."""
    if start is not None:
        df = df.where(_c("txn_date") >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.where(_c("txn_date") <= F.lit(str(end)).cast("date"))
    return df


def overall(enriched: DataFrame, start: date | str | None = None, end: date | str | None = None) -> DataFrame:
    """Totals, fraud rate, losses and affected accounts of a period."""
    return in_period(enriched, start, end).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(_c("is_fraud").cast("long")).alias("total_fraud_txns"),
        percent_true("is_fraud", 3).alias("fraud_rate_pct"),
        _loss(2).alias("total_fraud_loss"),
        rounded(exact_avg("loss_amount"), 2).alias("avg_fraud_loss"),
        F.countDistinct(F.when(_c("is_fraud") == 1, _c("account_id"))).alias("affected_accounts"),
    )


def monthly_trend(enriched: DataFrame, predictions: DataFrame) -> DataFrame:
    """Fraud figures and mean model probability per month."""
    scored = enriched.select("transaction_id", "txn_date", "is_fraud", "loss_amount").join(
        predictions.select("transaction_id", "fraud_probability"), "transaction_id", "left")
    return scored.groupBy(F.date_format("txn_date", "yyyy-MM").alias("month")).agg(
        *_fraud_figures(3),
        _loss(2).alias("fraud_loss"),
        rounded(exact_avg("fraud_probability", MEASURE), 4).alias("avg_fraud_prob"),
    ).orderBy("month")


def rule_leaderboard(rule_performance: DataFrame, n: int = 20) -> DataFrame:
    """Rules with the highest false-positive rate."""
    return rule_performance.orderBy(
        F.desc_nulls_last("fp_rate"), F.desc("total_alerts"), "rule_id", "alert_type", "severity"
    ).limit(n).select(
        "rule_id", "alert_type", "severity", "total_alerts", "true_positives", "false_positives",
        rounded(_c("fp_rate") * 100, 1).alias("false_positive_rate_pct"),
        "avg_score",
        rounded("avg_resolution_hours", 1).alias("avg_resolution_hrs"),
    )


def top_risk_customers(customers: DataFrame, customer_view: DataFrame, n: int = 10) -> DataFrame:
    """High-risk customers by score, with their lifetime figures."""
    lifetime = customer_view.select(
        "customer_id", "lifetime_txns", "lifetime_spend", "total_declines", "high_value_txns")
    return (
        customers.where("is_high_risk")
        .select("customer_id", "segment", "country", "risk_score", "risk_band", "kyc_status",
                "is_pep", "is_sanctioned")
        .join(lifetime, "customer_id")
        .orderBy(F.desc_nulls_last("risk_score"), "customer_id").limit(n)
    )


def by_channel_and_type(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("channel", "transaction_type").agg(
        *_fraud_figures(2), _loss(0).alias("total_loss"),
    ).orderBy(F.desc("fraud_rate_pct"), "channel", "transaction_type")


def common_drivers(explanations: DataFrame, n: int = 15) -> DataFrame:
    """Commonest driver texts of transactions predicted fraudulent."""
    return (
        explanations.where("predicted_label = 1").groupBy("top_fraud_drivers")
        .agg(F.count(F.lit(1)).alias("flagged_transactions"),
             rounded(exact_avg("predicted_fraud_prob", MEASURE), 4).alias("avg_fraud_probability"))
        .orderBy(F.desc("flagged_transactions"), "top_fraud_drivers").limit(n)
    )


def merchant_heatmap(enriched: DataFrame, merchants: DataFrame) -> DataFrame:
    """Fraud by merchant category and risk level; payments without a listed merchant are left out.

    Payments are totalled per merchant before the join, so no hot merchant crosses it as rows.
    """
    per_merchant = enriched.where("merchant_id is not null").groupBy("merchant_id").agg(
        F.count("transaction_id").alias("n"),
        F.sum(_c("is_fraud").cast("long")).alias("fraud"),
        F.sum(_c("loss_amount").cast(MONEY)).alias("loss"),
    )
    return (
        per_merchant.join(merchants.select("merchant_id", "mcc_description", "risk_level"), "merchant_id")
        .groupBy("mcc_description", "risk_level")
        .agg(F.sum("n").alias("total_txns"), F.sum("fraud").alias("fraud_count"),
             rounded(F.try_divide(F.sum("fraud").cast("double"), F.sum("n").cast("double")) * 100, 2)
             .alias("fraud_rate_pct"),
             rounded(F.sum("loss").cast("double"), 2).alias("total_loss"))
        .orderBy(F.desc("fraud_rate_pct"), "mcc_description", "risk_level")
    )


def hourly(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("txn_hour").agg(*_fraud_figures(3)).orderBy("txn_hour")


def loss_recovery(labels: DataFrame) -> DataFrame:
    """Cases, losses, recoveries and time to confirmation per fraud type."""
    return labels.groupBy("fraud_type").agg(
        F.count(F.lit(1)).alias("cases"),
        _loss(2).alias("total_loss"),
        rounded(exact_sum("recovered_amount"), 2).alias("total_recovered"),
        rounded(exact_avg("recovery_rate", MEASURE) * 100, 1).alias("avg_recovery_pct"),
        rounded(exact_avg("hours_to_confirm", MEASURE), 1).alias("avg_hours_to_confirm"),
    ).orderBy(F.desc_nulls_last("total_loss"), "fraud_type")


def compliance(audit_logs: DataFrame) -> DataFrame:
    """Flagged and failed audit actions per action and actor."""
    return audit_logs.groupBy("action", "actor_type").agg(
        F.count(F.lit(1)).alias("log_count"),
        F.sum(_c("compliance_flag").cast("long")).alias("compliance_flags"),
        F.sum(_c("is_failure").cast("long")).alias("failures"),
        percent_true("compliance_flag", 1).alias("flag_rate_pct"),
    ).orderBy(F.desc_nulls_last("compliance_flags"), "action", "actor_type")
