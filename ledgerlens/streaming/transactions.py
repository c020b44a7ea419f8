"""Transactions as a stream: cleaned, deduplicated within a bound on lateness, enriched."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.joins import find_hot_keys
from ledgerlens.plans import gold
from ledgerlens.plans.silver import LOAD_STAMP, refine
from ledgerlens.profiles import BATCH, Profile
from ledgerlens.streaming import ingest
from ledgerlens.streaming.history import CLOCK

LATENESS = "2 hours"


def clean(raw: DataFrame, lateness: str = LATENESS, profile: Profile = BATCH) -> DataFrame:
    """The silver transactions of a raw stream.

    A copy is dropped if it arrives within ``lateness`` of the first; older keys leave the state, so it
    is bounded by the traffic of that time. Rows without a readable time cannot be placed on the time
    line; ``land_clean`` lands them in a table of their own (``without_time``).
    """
    timed = raw.withColumn("event_time", F.try_to_timestamp("txn_datetime")).where("event_time is not null")
    unique = timed.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(["transaction_id"])
    return refine("transactions", unique, profile, deduplicate=False).drop(LOAD_STAMP)


def stamped(cleaned: DataFrame) -> DataFrame:
    """With the time when a micro-batch landed its rows: the clock that idle accounts leave the state by."""
    return cleaned.withColumn(CLOCK, F.current_timestamp())


def without_time(raw: DataFrame) -> DataFrame:
    """Rows the timed stream cannot take."""
    return raw.where(F.try_to_timestamp("txn_datetime").isNull())


def land_clean(raw: DataFrame, root: str, profile: Profile = BATCH) -> tuple[str, str]:
    """Land the cleaned stream and, beside it, the rows without a readable time; returns both paths."""
    paths = f"{root}/silver", f"{root}/without_time"
    ingest.finish([ingest.land(df, path, f"{path}-checkpoint")
                   for df, path in zip((clean(raw, profile=profile), without_time(raw)), paths)])
    return paths


def enrich(cleaned: DataFrame, silver: Mapping[str, DataFrame], profile: Profile = BATCH,
           hot_keys: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The enrichment of the batch, with the stream on its transaction side and static lookups.

    Skewed joins of a stateful stream are not split at run time; ``hot_keys`` (see ``hot_keys_of``) splits them by plan.
    """
    return gold.transactions_enriched({**silver, "transactions": cleaned}, profile, hot_keys=hot_keys)


def hot_keys_of(known: DataFrame) -> dict[str, DataFrame]:
    """The accounts and merchants that hold a large share of the transactions so far, fixed when a stream starts.

    Fewer than ``1 / HOT_SHARE`` of each can exist, so the lists may be collected and shipped."""
    spark = known.sparkSession
    found = {}
    for key in ("account_id", "merchant_id"):
        rows = find_hot_keys(known, key).collect()
        found[key] = spark.createDataFrame([(r[key],) for r in rows], f"{key} string")
    return found
