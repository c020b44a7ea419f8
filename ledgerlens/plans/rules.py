"""Rule alerts, structuring patterns, readable reasons and the case queue."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import amounts
from ledgerlens.functions.risk import policy_action, policy_tier
from ledgerlens.functions.text import sentence
from ledgerlens.operators.joins import lookup_join, null_safe_left_join
from ledgerlens.operators.prefix import positions
from ledgerlens.operators.sweep import Trailing, TrailingDistinct, trailing_frames
from ledgerlens.plans.features import DAY, SECOND, with_second

_c = F.col


@dataclass(frozen=True)
class Rule:
    """One alert rule: SQL predicate and SQL score over the rows of ``rule_inputs``."""

    rule_id: str
    alert_type: str
    severity: str
    predicate: str
    score: str


# The default rule book. A deployment passes its own list; nothing else changes.
RULES = (
    Rule("R100", "Velocity Check", "High", "is_high_velocity = 1", "0.80"),
    Rule("R101", "Amount Threshold", "Medium", "amount > 10000", "least(0.99, 0.65 + amount / 1000000)"),
    Rule("R102", "Geo Anomaly", "Medium", "is_international AND is_odd_hour", "0.70"),
    Rule("R103", "Device Anomaly", "Low", "is_new_device", "0.55"),
    Rule("R104", "Blacklist Match", "Critical", "is_blacklisted_merchant", "0.95"),
    Rule("R105", "Dormant Account Activity", "High", "account_status = 'Dormant' OR is_after_long_gap", "0.75"),
    Rule("R106", "Round Amount", "Low", "is_round_amount = 1", "0.50"),
    Rule("R107", "Night Transaction", "Low", "is_odd_hour", "0.52"),
    Rule("R108", "Multiple Declines", "Medium", "declines_24h >= 3", "least(0.99, 0.60 + declines_24h / 100.0)"),
    Rule("R109", "Cross-Border High Value", "High", "is_international AND amount > 5000", "0.85"),
)

LONG_GAP_DAYS = 30


def new_devices(features: DataFrame) -> DataFrame:
    """Transactions that show a device for the first time, the account's very first one aside."""
    first = features.groupBy("account_id", "device_id").agg(
        F.min(F.struct(SECOND, "transaction_id")).alias("first"))
    opening = first.groupBy("account_id").agg(F.min("first").alias("first"))
    return first.select("first.transaction_id").join(
        opening.select("first.transaction_id"), "transaction_id", "left_anti").distinct()


def after_long_gap(features: DataFrame, days: int = LONG_GAP_DAYS) -> DataFrame:
    """Transactions that follow more than ``days`` days of silence of their account.

    Only the first transaction of a day can, so accounts are compared day by day: at most one row per
    account and active day is ordered, not every transaction.
    """
    daily = features.groupBy("account_id", "txn_date").agg(
        F.min(F.struct(SECOND, "transaction_id")).alias("first"), F.max(SECOND).alias("last"))
    before = F.lag("last").over(Window.partitionBy("account_id").orderBy("txn_date"))
    return daily.withColumn("before", before).where(
        _c(f"first.{SECOND}") - _c("before") > days * DAY).select("first.transaction_id").distinct()


def declines_24h(features: DataFrame) -> DataFrame:
    """Declined transactions with the number of declines of their account in the last 24 hours."""
    declined = features.where("is_declined").select("transaction_id", "account_id", SECOND)
    frames = trailing_frames(declined, "account_id", SECOND, {
        "declines_24h": Trailing(F.lit(1).cast("long"), DAY)})
    return null_safe_left_join(declined, frames, ["account_id", SECOND]).select("transaction_id", "declines_24h")


def rule_inputs(features: DataFrame, merchants_raw: DataFrame) -> DataFrame:
    """Feature rows plus what the rules need beyond them.

    The history-based facts are all keyed by transaction, so they are folded into one table and the
    feature rows move once for all of them.
    """
    facts = (
        new_devices(features).withColumn("is_new_device", F.lit(True))
        .unionByName(after_long_gap(features).withColumn("is_after_long_gap", F.lit(True)), allowMissingColumns=True)
        .unionByName(declines_24h(features), allowMissingColumns=True)
        .groupBy("transaction_id").agg(
            F.bool_or("is_new_device").alias("is_new_device"),
            F.bool_or("is_after_long_gap").alias("is_after_long_gap"),
            F.max("declines_24h").alias("declines_24h"))
    )
    blacklist = merchants_raw.where("is_blacklisted").select("merchant_id").distinct().withColumn(
        "is_blacklisted_merchant", F.lit(True))
    joined = lookup_join(features, blacklist, "merchant_id", spread_by="transaction_id")
    return joined.join(facts, "transaction_id", "left")


def rule_alerts(inputs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One alert per transaction and rule that fires; all rules are evaluated in one pass."""
    evaluated = F.array(*[F.struct(
        F.lit(r.rule_id).alias("rule_id"), F.lit(r.alert_type).alias("alert_type"),
        F.lit(r.severity).alias("severity"), F.expr(r.score).cast("decimal(6,4)").alias("score"),
        F.coalesce(F.expr(r.predicate), F.lit(False)).alias("fired")) for r in rules])
    fired = inputs.select("transaction_id", "account_id", "txn_datetime",
                          F.inline(F.filter(evaluated, lambda r: r["fired"])))
    return fired.select(
        F.concat_ws("-", "rule_id", "transaction_id").alias("alert_id"),
        "transaction_id", "account_id", "rule_id", "alert_type", "severity",
        _c("score").cast("double").alias("score"), _c("txn_datetime").alias("created_datetime"),
        F.concat("rule_id", F.lit(" ("), "alert_type", F.lit(") fired with "), _c("score").cast("string"),
                 F.lit(" points")).alias("explanation"),
    )


@dataclass(frozen=True)
class Structuring:
    """Several deposits below the reporting threshold, then a large withdrawal, over several channels."""

    deposit_types: tuple[str, ...] = ("Cash Deposit",)
    withdrawal_types: tuple[str, ...] = ("ATM Withdrawal",)
    deposit_below: float = 1_000
    withdrawal_from: float = 3_000
    seconds: int = 4 * 3_600
    deposits: int = 3
    channels: int = 3


def structuring_patterns(transactions: DataFrame, pattern: Structuring = Structuring()) -> DataFrame:
    """Withdrawals that complete the pattern, with what preceded them.

    Only the deposits and withdrawals in question enter the trailing frame, a small part of all rows.
    """
    is_deposit = _c("transaction_type").isin(*pattern.deposit_types) & (_c("amount") < pattern.deposit_below)
    is_withdrawal = _c("transaction_type").isin(*pattern.withdrawal_types) & (
        _c("amount") >= pattern.withdrawal_from)
    rows = with_second(transactions).where(is_deposit | is_withdrawal).select(
        "transaction_id", "account_id", "txn_datetime", SECOND, "amount", "channel", is_deposit.alias("is_deposit"))
    high, low = (F.when(_c("is_deposit"), x) for x in amounts.limbs(_c("amount")))
    frames = trailing_frames(rows, "account_id", SECOND, {
        "deposits": Trailing(_c("is_deposit").cast("long"), pattern.seconds),
        "deposit_high": Trailing(F.coalesce(high, F.lit(0)), pattern.seconds),
        "deposit_low": Trailing(F.coalesce(low, F.lit(0)), pattern.seconds),
        "channels": TrailingDistinct(_c("channel"), pattern.seconds),
    })
    return (
        rows.where("not is_deposit").join(frames, ["account_id", SECOND])
        .where((_c("deposits") >= pattern.deposits) & (_c("channels") >= pattern.channels))
        .select("transaction_id", "account_id", "txn_datetime", "amount", "deposits",
                amounts.total(_c("deposit_high"), _c("deposit_low")).alias("deposit_total"), "channels")
    )


def alert_reasons(features: DataFrame, structuring: DataFrame) -> DataFrame:
    """Readable reasons per transaction, in a fixed order; transactions without any are left out."""
    marked = features.join(
        structuring.select("transaction_id").distinct().withColumn("completes_structuring", F.lit(True)),
        "transaction_id", "left")

    def text(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    def number(name: str, digits: int) -> Column:
        return _c(name).cast(f"decimal(18,{digits})").cast("string")

    reasons = {
        "structuring": F.when(_c("completes_structuring"), text(
            "A large withdrawal follows several small deposits")),
        "amount": F.when(_c("amount_zscore") >= 2, text(
            "Amount ", number("amount", 2), ", z-score ", number("amount_zscore", 1), " within the account")),
        "velocity": F.when(_c("is_high_velocity") == 1, text(
            "Burst of payments: ", _c("txn_count_1h").cast("string"), " within an hour, ",
            _c("txn_count_24h").cast("string"), " within a day")),
        "geography": F.when(_c("is_international"), text("International transaction")),
        "time": F.when(_c("is_odd_hour"), text("Transaction at ", F.date_format("txn_datetime", "HH:mm"))),
        "merchant": F.when(_c("is_high_risk_merchant"), text(
            "Risky trade of the merchant: ", _c("mcc_description"), ", code ", _c("mcc_code"))),
        "channel": F.when(_c("channel_risk") >= 2, text("Exposed channel (", _c("channel"), ")")),
    }
    signals = sum((r.isNotNull().cast("int") for r in reasons.values()), F.lit(0))
    return marked.select(
        "transaction_id", "composite_risk_score", signals.alias("signals"),
        sentence(list(reasons.values())).alias("explanation")).where("signals > 0")


def case_queue(predictions: DataFrame) -> DataFrame:
    """Analyst queues by policy tier: most probable first, then oldest minute, then transaction.

    A tier may hold most of all transactions, so positions are counted per probability and minute
    and carried along instead of sorting a tier in one task.
    """
    routed = predictions.withColumns({
        "risk_tier": policy_tier(_c("fraud_probability")),
        "queue": policy_action(_c("fraud_probability")),
        "_slice": F.floor(_c("fraud_probability") * -1000),
        "_probability": -_c("fraud_probability"),
        "_minute": F.floor(F.unix_timestamp("txn_datetime") / 60),
    })
    ranked = positions(routed, ["risk_tier"], ["_slice", "_probability", "_minute"], "transaction_id",
                       "queue_position")
    return ranked.select("transaction_id", "account_id", "fraud_probability", "risk_tier", "queue",
                         "queue_position")
