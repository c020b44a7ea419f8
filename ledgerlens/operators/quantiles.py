"""Exact quantiles of several columns at once, without a global sort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.prefix import running_totals

# Slices of the order per factor e of magnitude.
SLICES = 200


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Mapping[str, float], name: str = "feature") -> DataFrame:
    """``name`` and one column for each of ``shares`` (quartiles, say), a row a column of ``df``; NULLs do not count.

    Between two neighbouring values a quantile is interpolated. All values are counted, below the shuffle, over slices of
    equal relative width; only the values of the slices that hold a wanted place are then moved and ranked one by one, so
    no task holds more than a slice's distinct values.
    """
    cells = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias("value")) for c in columns])
    size = F.signum("value") * F.log1p(F.abs("value"))
    valued = df.select(F.inline(cells)).where("value is not null").withColumn("slice", F.floor(size * SLICES))
    # at most two slices a share and column
    counts = valued.join(F.broadcast(held_slices(valued, shares, name)), [name, "slice"]).groupBy(
        name, "slice", "value").agg(F.count(F.lit(1)).alias("n"), F.max("before").alias("before"),
                                    F.max("total").alias("total")).withColumn("upto", F.col("n"))
    placed = running_totals(counts, [name, "slice"], ["value"], ["upto"]).withColumn("upto", F.col("upto") + F.col("before"))

    def at(place):
        """The value at a place, counted from 0."""
        return F.max(F.when(_holds(place), F.col("value")))

    picked, results = [], []
    for k, (label, share) in enumerate(shares.items()):
        place = (F.col("total") - 1) * share
        picked += [at(F.floor(place)).alias(f"low_{k}"), at(F.ceil(place)).alias(f"high_{k}"),
                   F.max(place - F.floor(place)).alias(f"part_{k}")]
        results.append((F.col(f"low_{k}") + (F.col(f"high_{k}") - F.col(f"low_{k}")) * F.col(f"part_{k}")).alias(label))
    return placed.groupBy(name).agg(*picked).select(name, *results)


def _holds(place: Column) -> Column:
    """Whether a place, counted from 0, is among the ``n`` that end with ``upto``."""
    return (F.col("upto") - F.col("n") <= place) & (place < F.col("upto"))


def held_slices(valued: DataFrame, shares: Mapping[str, float], name: str) -> DataFrame:
    """The slices of each ``name`` that hold a place of one of ``shares``, with the number of values before them and the
    ``total`` of the name."""
    slices = valued.groupBy(name, "slice").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.col("n"))
    slices = running_totals(slices, [name], ["slice"], ["upto"])
    # a row a column
    totals = slices.groupBy(F.col(name).alias("_of")).agg(F.sum("n").alias("total"))
    slices = slices.join(F.broadcast(totals), F.col(name) == F.col("_of"))
    places = [edge((F.col("total") - 1) * share) for share in shares.values() for edge in (F.floor, F.ceil)]
    return slices.where(reduce(or_, map(_holds, places))).select(
        name, "slice", (F.col("upto") - F.col("n")).alias("before"), "total")
