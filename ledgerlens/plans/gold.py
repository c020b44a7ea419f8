"""Gold layer: customer view, enriched transactions, daily summary, alert-rule scorecard."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.measures import exact_avg, exact_sum, flag_count, flag_sum, ratio, rounded
from ledgerlens.operators.dedup import keep_one
from ledgerlens.operators.joins import lookup_join
from ledgerlens.profiles import BATCH, Profile

_c = F.col
SCORE = "decimal(18,4)"
HOURS = "decimal(28,10)"


def account_stats(transactions: DataFrame, profile: Profile = BATCH) -> DataFrame:
    """Activity per account. The profile that keeps rows without an id counts rows, the other one ids."""
    flags = flag_count if profile.zero_when_absent else flag_sum
    counted = F.lit(1) if profile.zero_when_absent else _c("transaction_id")
    return transactions.groupBy("account_id").agg(
        F.count(counted).alias("total_txns"),
        exact_sum("amount").alias("total_amount"),
        exact_avg("amount").alias("avg_txn_amount"),
        F.max("amount").alias("max_txn_amount"),
        flags("is_high_value").alias("high_value_txn_count"),
        flags("is_international").alias("intl_txn_count"),
        flags("is_declined").alias("decline_count"),
        flags("is_odd_hour").alias("odd_hour_txn_count"),
    )


# customer_360 column <- account_stats column
_LIFETIME = {
    "lifetime_txns": "total_txns",
    "lifetime_spend": "total_amount",
    "high_value_txns": "high_value_txn_count",
    "total_declines": "decline_count",
    "intl_txns": "intl_txn_count",
}


def customer_360(silver: Mapping[str, DataFrame], profile: Profile = BATCH) -> DataFrame:
    """Customers with their account and lifetime figures.

    Transactions shrink to one row per account before anything is joined, and accounts then fold to
    customers in a single aggregation. A customer without transactions keeps NULL lifetime figures.
    """
    stats = account_stats(silver["transactions"], profile)
    per_account = silver["accounts"].select("account_id", "customer_id", "balance", "is_overdrawn").join(
        stats, "account_id", "left")
    overdrawn = flag_count("is_overdrawn") if profile.zero_when_absent else flag_sum("is_overdrawn")
    lifetime = [
        (exact_sum(src) if src == "total_amount" else F.sum(src)).alias(out) for out, src in _LIFETIME.items()
    ]
    per_customer = per_account.where("customer_id is not null").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("num_accounts"),
        exact_sum("balance").alias("total_balance"),
        overdrawn.alias("overdrawn_accounts"),
        *lifetime,
    )
    return silver["customers"].join(per_customer, "customer_id", "left")


def alerts_per_transaction(alerts: DataFrame, profile: Profile = BATCH) -> DataFrame:
    hit = F.bool_or("is_true_positive")
    return alerts.groupBy("transaction_id").agg(
        F.count(F.lit(1)).alias("alert_count"),
        F.max("score").alias("max_alert_score"),
        (hit.cast("int") if profile.flags_as_int else hit).alias("has_true_positive_alert"),
    )


def account_holders(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Accounts with the risk attributes of their customer, one row per account."""
    accounts = silver["accounts"].select(
        "account_id", "customer_id", "account_type",
        _c("currency").alias("account_currency"), _c("status").alias("account_status"))
    customers = silver["customers"].select(
        "customer_id", "segment", "country", "risk_score", "risk_band", "kyc_status",
        "is_pep", "is_sanctioned", "is_high_risk")
    return lookup_join(accounts, customers, "customer_id", spread_by="account_id")


def merchant_attributes(merchants: DataFrame) -> DataFrame:
    return merchants.select("merchant_id", "mcc_code", "mcc_description", "risk_level", "is_high_risk_merchant")


def one_label(labels: DataFrame) -> DataFrame:
    """The latest label of each transaction."""
    return keep_one(labels, "transaction_id", ("detected_datetime",))


def label_attributes(labels: DataFrame) -> DataFrame:
    return labels.select("transaction_id", "fraud_type", _c("fraud_status").alias("fraud_label_status"),
                         "loss_amount", "is_resolved")


def transactions_enriched(silver: Mapping[str, DataFrame], profile: Profile = BATCH,
                          confirmed_only: bool = False, unique_labels: bool = False,
                          hot_keys: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Every transaction with account, customer, merchant, label and alert attributes.

    Labels and alerts come first: they share the transaction key, by which deduplication has left the rows.
    Customers are folded into accounts, so the transactions move once for both. ``is_fraud`` is set for
    every labelled transaction whatever became of the case; ``confirmed_only`` narrows it. Two labels of one
    transaction make two rows, as in a plain join; ``unique_labels`` takes the latest. ``hot_keys`` lists accounts
    and merchants whose rows are spread by plan, for streams, where nothing splits them at run time.
    """
    hot = hot_keys or {}
    txn = silver["transactions"]
    labels = one_label(silver["fraud_labels"]) if unique_labels else silver["fraud_labels"]
    cases, counts = label_attributes(labels), alerts_per_transaction(silver["alerts"], profile)
    holders, merchants = account_holders(silver), merchant_attributes(silver["merchants"])
    enriched = (
        txn.join(cases, "transaction_id", "left").join(counts, "transaction_id", "left")
        .transform(lookup_join, holders, "account_id", spread_by="transaction_id", hot_keys=hot.get("account_id"))
        .transform(lookup_join, merchants, "merchant_id", spread_by="transaction_id", hot_keys=hot.get("merchant_id"))
    ).select("transaction_id", *[c for df, key in (
        (txn, "transaction_id"), (holders, "account_id"), (merchants, "merchant_id"), (cases, "transaction_id"),
        (counts, "transaction_id")) for c in df.columns if c != key or (df is txn and c != "transaction_id")])
    labelled = _c("fraud_type").isNotNull()
    if confirmed_only:
        labelled = labelled & _c("is_resolved")
    added: dict[str, Column] = {"is_fraud": labelled.cast("int") if profile.flags_as_int else labelled}
    if profile.flags_as_int:
        added["alert_count"] = F.coalesce("alert_count", F.lit(0).cast("long"))
    return enriched.withColumns(added)


def daily_fraud_summary(enriched: DataFrame, profile: Profile = BATCH) -> DataFrame:
    """Volume, fraud and alert figures per day, account type and channel."""
    fraud = _c("is_fraud").cast("boolean")
    rate = ratio("fraud_count", "total_txns")
    if profile.zero_when_absent:
        loss = exact_sum(F.when(fraud, _c("loss_amount")).otherwise(F.lit(0.0)))
    else:
        loss = exact_sum("loss_amount")
    declines = flag_count("is_declined") if profile.zero_when_absent else flag_sum("is_declined")
    return (
        enriched.groupBy("txn_date", "account_type", "channel")
        .agg(
            F.count(F.lit(1)).alias("total_txns"),
            exact_sum("amount").alias("total_volume"),
            F.count_if(fraud).alias("fraud_count"),
            loss.alias("total_loss"),
            exact_avg("max_alert_score", SCORE).alias("avg_alert_score"),
            F.sum(F.coalesce("alert_count", F.lit(0))).alias("total_alerts"),
            declines.alias("total_declines"),
        )
        .withColumn("fraud_rate", rate if profile.rate_digits is None else rounded(rate, profile.rate_digits))
    )


def alert_rule_performance(silver: Mapping[str, DataFrame], profile: Profile = BATCH,
                           unique_labels: bool = False) -> DataFrame:
    """How each alert rule fares against the labels; ``unique_labels`` as in ``transactions_enriched``."""
    labels = one_label(silver["fraud_labels"]) if unique_labels else silver["fraud_labels"]
    labels = labels.select("transaction_id", "fraud_id", "fraud_type")
    confirmed = _c("fraud_type" if profile.flags_as_int else "fraud_id").isNotNull()
    flags = flag_sum if profile.flags_as_int else flag_count
    rate = ratio("false_positives", "total_alerts")
    return (
        silver["alerts"].join(labels, "transaction_id", "left")
        .groupBy("rule_id", "alert_type", "severity")
        .agg(
            F.count(F.lit(1)).alias("total_alerts"),
            flags("is_true_positive").alias("true_positives"),
            flags("false_positive").alias("false_positives"),
            F.count_if(confirmed).alias("confirmed_frauds"),
            exact_avg("score", SCORE).alias("avg_score"),
            exact_avg("resolution_hours", HOURS).alias("avg_resolution_hours"),
        )
        .withColumn("fp_rate", rate if profile.rate_digits is None else rounded(rate, profile.rate_digits))
    )
