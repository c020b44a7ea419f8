"""Distinct counts of any period from sketches stored per day.

A distinct count cannot be summed over days, and counting it anew reads all payments of the period. A sketch per day
(HyperLogLog, a few KB) can be merged with others: a period reads as many rows as it has days.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_c = F.col
# 2 ** LG_SIZE registers: a relative standard error of about 1.04 / sqrt(2 ** LG_SIZE), 0.8 %.
LG_SIZE = 14

COUNTED = {"accounts": "account_id", "merchants": "merchant_id", "devices": "device_id"}


def standard_error(lg_size: int = LG_SIZE) -> float:
    return 1.04 / 2 ** (lg_size / 2)


def daily_sketches(enriched: DataFrame, counted: Mapping[str, str] = COUNTED, lg_size: int = LG_SIZE) -> DataFrame:
    """``txn_date``, rows and fraud rows, and a sketch of each counted column and of accounts with fraud. Sketches are
    merged below the shuffle, so a hot day moves as a sketch a task."""
    sketch = lambda value: F.hll_sketch_agg(value, F.lit(lg_size))
    return enriched.groupBy("txn_date").agg(
        F.count(F.lit(1)).alias("transactions"), F.count_if(_c("is_fraud") == 1).alias("fraud_transactions"),
        *[sketch(_c(column)).alias(name) for name, column in counted.items()],
        sketch(F.when(_c("is_fraud") == 1, _c("account_id"))).alias("affected_accounts"))


def period_counts(sketches: DataFrame, *period: Column | str, start: str | None = None,
                  end: str | None = None) -> DataFrame:
    """Rows and estimated distinct counts per ``period`` (columns over ``txn_date``; none: one row) from ``start`` to
    ``end``, both included. Days without a sketch count nothing; a period without days has no row."""
    days = sketches
    if start is not None:
        days = days.where(_c("txn_date") >= F.lit(start).cast("date"))
    if end is not None:
        days = days.where(_c("txn_date") <= F.lit(end).cast("date"))
    names = [c for c, kind in sketches.dtypes if kind == "binary"]
    return days.groupBy(*period).agg(
        F.sum("transactions").alias("transactions"), F.sum("fraud_transactions").alias("fraud_transactions"),
        *[F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in names])
