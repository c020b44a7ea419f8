"""One row per key, the same row on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, key: str | Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """Keep the row with the largest ``prefer`` columns (then all other columns) of each key.

    The order is total, so exact copies aside there is nothing left to chance (NULL counts as the
    smallest value). The input is read once and moves once. Only the first of a rank is asked for, so Spark keeps one
    row a key below the shuffle (a window group limit): a key that holds a large share of all rows arrives as a row a
    task and does not pile up in one reducer.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ranked = list(prefer) + [c for c in df.columns if c not in keys and c not in prefer]
    order = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in ranked])
    return df.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")
