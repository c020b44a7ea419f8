"""Left lookup joins that stay balanced when keys are missing or hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Over how many reducers the rows without a key are spread.
SPREAD = 4096
# A key is hot when it holds more than this share of the fact rows: at most 1/HOT_SHARE keys can be.
HOT_SHARE = 0.002


def lookup_join(fact: DataFrame, lookup: DataFrame, key: str, spread_by: str, hot_keys: DataFrame | None = None,
                salts: int = 64) -> DataFrame:
    """``fact`` left join ``lookup`` on the string ``key``; every fact row is kept.

    Rows without a key match nothing, yet all of them would hash to one reducer. They join on a
    made-up key instead, spread over many values, and the condition that the real key is present
    keeps them unmatched. Should the lookup side be small, Spark broadcasts it by its measured size
    and none of this costs a shuffle. Hot keys of a sort-merge join are split by AQE's skew join; with
    ``hot_keys`` (see ``find_hot_keys``) they are split by plan: their fact rows spread over ``salts``
    reducers and only their lookup rows are repeated.
    """
    spread = F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)).cast("int")
    made_up = F.coalesce(F.col(key), F.concat(F.lit("\u0000"), spread.cast("string")))
    left = fact.withColumn("_key", made_up)
    right = lookup.withColumnRenamed(key, "_lookup_key")
    matched = (F.col("_key") == F.col("_lookup_key")) & F.col(key).isNotNull()
    if hot_keys is not None:
        # at most 1/HOT_SHARE rows by construction, so this broadcast cannot grow with the data
        hot = F.broadcast(hot_keys.select(F.col(key).alias("_hot_key")))
        salted = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
        left = left.join(hot, F.col(key) == F.col("_hot_key"), "left").withColumn(
            "_salt", F.when(F.col("_hot_key").isNotNull(), salted).otherwise(0)).drop("_hot_key")
        copies = F.when(F.col("_hot_key").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
            F.array(F.lit(0)))
        right = right.join(hot, F.col("_lookup_key") == F.col("_hot_key"), "left").withColumn(
            "_copy", F.explode(copies)).drop("_hot_key")
        matched = matched & (F.col("_salt") == F.col("_copy"))
    return left.join(right, matched, "left").drop("_key", "_lookup_key", "_salt", "_copy")


def find_hot_keys(fact: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold more than ``share`` of all rows: fewer than ``1/share`` of them can exist.

    Reads one column, counts below the shuffle, and compares with the total in the same plan.
    """
    counts = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = fact.agg(F.count(F.lit(1)).alias("_total"))
    return counts.where(F.col("_n") > total.scalar() * share).select(key)


def null_safe_left_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which a missing key matches a missing key; ``right`` is unique on ``keys``."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    matched = F.lit(True)
    for k in keys:
        matched = matched & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, matched, "left").drop(*[f"_r_{k}" for k in keys])
