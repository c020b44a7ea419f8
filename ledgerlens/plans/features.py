"""Behavioural features: trailing velocity, deviation from habit, rule score, context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import amounts
from ledgerlens.functions.measures import exact_avg, rounded
from ledgerlens.functions.risk import CHANNEL_RISK, MERCHANT_RISK_RANK, lookup
from ledgerlens.operators.joins import lookup_join, null_safe_left_join
from ledgerlens.operators.quantiles import exact_quantiles
from ledgerlens.operators.sweep import Trailing, TrailingDistinct, trailing_frames, trailing_max

_c = F.col
HOUR, DAY, WEEK = 3_600, 86_400, 604_800
SECOND = "txn_ts_unix"

# ---- fixed values: weights, caps and thresholds of the scores ----------------------------------
GEO_WEIGHTS = {"is_international": 2.0, "is_odd_hour": 1.5, "is_high_risk_merchant": 2.0}
SCORE_WEIGHTS = {"risk_score": 0.3, "amount_zscore": 10, "geo_risk_score": 5, "channel_risk": 3,
                 "txn_count_1h": 2}
SCORE_CAP = 100.0
BURST_1H, BURST_24H = 5, 20
ROUND_UNIT, ROUND_ABOVE = 100, 500
SUMMARY_FEATURES = ("amount", "amount_zscore", "composite_risk_score", "txn_count_1h", "txn_count_24h",
                    "is_high_velocity", "geo_risk_score", "is_round_amount", "label")
# ------------------------------------------------------------------------------------------------

VELOCITY_COLUMNS = ("txn_count_1h", "txn_count_24h", "txn_count_7d", "amount_sum_1h", "amount_sum_24h",
                    "amount_avg_7d", "amount_stddev_7d")


def with_second(df: DataFrame) -> DataFrame:
    """Event time as whole epoch seconds, the unit of all trailing frames."""
    return df.withColumn(SECOND, F.unix_timestamp("txn_datetime"))


def velocity(enriched: DataFrame, digits: int = amounts.DIGITS) -> DataFrame:
    """Counts, sums, mean and deviation of an account's payments over the last hour, day and week.

    Amounts are summed as whole units of their ``digits``-th decimal in two limbs (``functions.amounts``), so the frames
    are exact whatever the amounts' size. Only account, second and amount take part in the frames; the wide rows move
    once, to meet them.
    """
    high, low = amounts.limbs(_c("amount"), digits)
    one = _c("transaction_id").isNotNull().cast("long")
    base = with_second(enriched)
    frames = trailing_frames(base.select("account_id", SECOND, "transaction_id", "amount"), "account_id", SECOND, {
        "txn_count_1h": Trailing(one, HOUR),
        "txn_count_24h": Trailing(one, DAY),
        "txn_count_7d": Trailing(one, WEEK),
        **{f"{limb}_{name}": Trailing(value, seconds) for name, seconds in (("1h", HOUR), ("24h", DAY), ("7d", WEEK))
           for limb, value in (("high", high), ("low", low))},
        **{f"squares_{k}": Trailing(value, WEEK) for k, value in enumerate(amounts.square_limbs(high, low))},
        "amounts_7d": Trailing(high.isNotNull().cast("long"), WEEK),
    })
    n = _c("amounts_7d")
    total = lambda name: amounts.total(_c(f"high_{name}"), _c(f"low_{name}"), digits)
    measured = frames.select(
        "account_id", SECOND, "txn_count_1h", "txn_count_24h", "txn_count_7d",
        total("1h").alias("amount_sum_1h"), total("24h").alias("amount_sum_24h"),
        F.try_divide(total("7d"), n.cast("double")).alias("amount_avg_7d"),
        amounts.sample_stddev(n, (_c("high_7d"), _c("low_7d")), tuple(_c(f"squares_{k}") for k in range(3)),
                              digits).alias("amount_stddev_7d"),
    )
    return null_safe_left_join(base, measured, ["account_id", SECOND])


def velocity_extended(enriched: DataFrame) -> DataFrame:
    """Distinct merchants of the last day and largest amount of the last week, per transaction."""
    base = with_second(enriched)
    keys = ["account_id", SECOND]
    merchants = trailing_frames(base.select(*keys, "merchant_id"), *keys, {
        "unique_merchants_24h": TrailingDistinct(_c("merchant_id"), DAY)})
    largest = trailing_max(base.select(*keys, "amount"), *keys, "amount", 7, "amount_max_7d")
    return null_safe_left_join(base, null_safe_left_join(merchants, largest, keys), keys)


def scores(velocity_rows: DataFrame, null_safe: bool = False) -> DataFrame:
    """Deviation, geography, channel and composite scores, the two flags and the label.

    A missing term (an unmatched merchant, say) makes the composite 100, because the cap skips NULL;
    ``null_safe`` counts missing terms as 0 instead.
    """
    deviation = _c("amount_stddev_7d")
    zscore = F.when(deviation > 0, (_c("amount") - _c("amount_avg_7d")) / deviation).otherwise(F.lit(0.0))
    with_terms = velocity_rows.withColumns({
        "amount_zscore": zscore,
        "geo_risk_score": sum((_c(flag).cast("int") * w for flag, w in GEO_WEIGHTS.items()), F.lit(0.0)),
        "channel_risk": lookup(_c("channel"), CHANNEL_RISK, 0),
    })
    return with_terms.withColumns({
        "composite_risk_score": rounded(F.least(F.lit(SCORE_CAP), sum(score_terms(null_safe), F.lit(0.0))), 2),
        "is_high_velocity": ((_c("txn_count_1h") > BURST_1H) | (_c("txn_count_24h") > BURST_24H)).cast("int"),
        "is_round_amount": ((_c("amount") % ROUND_UNIT == 0) & (_c("amount") > ROUND_ABOVE)).cast("int"),
        "label": _c("is_fraud").cast("int"),
    })


def score_terms(null_safe: bool = False) -> list[Column]:
    """The additive terms of the composite score, in the order of ``SCORE_WEIGHTS``."""
    terms = [(F.abs(_c(n)) if n == "amount_zscore" else _c(n)) * w for n, w in SCORE_WEIGHTS.items()]
    return [F.coalesce(t, F.lit(0.0)) for t in terms] if null_safe else terms


def ml_features(enriched: DataFrame, null_safe: bool = False) -> DataFrame:
    """Enriched transactions with epoch second, velocity, scores, flags and label."""
    return scores(velocity(enriched), null_safe)


def feature_summary(features: DataFrame, columns: Sequence[str] = SUMMARY_FEATURES) -> DataFrame:
    """Count, mean, deviation and range per feature, one row each, in one pass."""
    aggregates = []
    for name in columns:
        value = _c(name).cast("double")
        aggregates += [F.count(value).alias(f"{name}_count"),
                       exact_avg(value, "decimal(28,8)").alias(f"{name}_mean"),
                       F.stddev(value).alias(f"{name}_stddev"), F.min(value).alias(f"{name}_min"),
                       F.max(value).alias(f"{name}_max")]
    rows = F.array(*[F.struct(F.lit(n).alias("feature"), *[
        _c(f"{n}_{s}").alias(s) for s in ("count", "mean", "stddev", "min", "max")]) for n in columns])
    return features.agg(*aggregates).select(F.inline(rows))


def feature_quartiles(features: DataFrame, columns: Sequence[str] = SUMMARY_FEATURES) -> DataFrame:
    """Exact quartiles per feature, one row each."""
    return exact_quantiles(features, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75})


def contextual(enriched: DataFrame, accounts: DataFrame) -> DataFrame:
    """Merchant risk as a rank, account balance, customer risk and exposure flag per transaction."""
    balances = accounts.select("account_id", _c("balance").alias("account_balance"))
    rows = enriched.select(
        "transaction_id", "account_id", lookup(_c("risk_level"), MERCHANT_RISK_RANK, None).alias("merchant_risk_encoded"),
        _c("risk_score").alias("customer_risk_score"), "is_pep")
    return lookup_join(rows, balances, "account_id", spread_by="transaction_id")
