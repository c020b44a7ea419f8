"""Incremental refresh of the tables that are laid out by date.

A day is changed if its rows differ in number or content. Changed days of the enriched transactions are replaced; of
the features also the days whose trailing frames reach a changed one. All other dates keep their files.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.plans import features
from ledgerlens.sources.layout import Layout

_c = F.col
DAY_COLUMN = "txn_date"
# The longest frame covers a week back to the second, so it reaches into the seventh day after.
REACH = features.WEEK // features.DAY


@dataclass(frozen=True)
class Refreshed:
    """What a refresh replaced: days of the enriched table, and of the feature table."""

    changed: tuple[date | None, ...]
    recomputed: tuple[date | None, ...]


def day_marks(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Number and checksum of the rows of each day, whatever their order."""
    return rows.groupBy(DAY_COLUMN).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("mark"))


def changed_days(before: DataFrame, after: DataFrame) -> dict[date | None, bool]:
    """Days whose marks differ, and whether they still have rows. A day is a row, so they come to the driver."""
    columns = sorted(c for c in after.columns if c != DAY_COLUMN)
    old, new = (day_marks(df.select(DAY_COLUMN, *columns), columns) for df in (before, after))
    old = old.select(*[_c(c).alias(f"old_{c}") for c in old.columns])
    both = old.join(new, _c(f"old_{DAY_COLUMN}").eqNullSafe(_c(DAY_COLUMN)), "full").where(
        ~(_c("n").eqNullSafe(_c("old_n")) & _c("mark").eqNullSafe(_c("old_mark"))))
    return {r["day"]: r["stays"] for r in both.select(
        F.when(_c("n").isNotNull(), _c(DAY_COLUMN)).otherwise(_c(f"old_{DAY_COLUMN}")).alias("day"),
        _c("n").isNotNull().alias("stays")).collect()}


def in_days(days: set[date | None]) -> Column:
    """Rows of these days, as a filter that prunes partitions."""
    named = sorted(d for d in days if d is not None)
    found = _c(DAY_COLUMN).isin(named) if named else F.lit(False)
    return found | _c(DAY_COLUMN).isNull() if None in days else found


def drop_days(spark: SparkSession, path: str, days: set[date | None]) -> None:
    """Remove the folders of days without rows; writing the other days leaves them."""
    for day in days:
        name = "__HIVE_DEFAULT_PARTITION__" if day is None else day.isoformat()
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{DAY_COLUMN}={name}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def refresh(spark: SparkSession, layout: Layout, enriched: DataFrame, enriched_table: str = "gold_transactions_enriched",
            feature_table: str = "gold_ml_features") -> Refreshed:
    """Bring the stored enriched and feature tables to ``enriched``, which must not read them.

    New, late, altered and deleted rows are all told from the days' marks. Frames of the recomputed days read the week
    before them and no more. Rows without a time are peers of each other over all days, so days that hold such rows
    are recomputed with any change.
    """
    stored = layout.read(spark, "gold", enriched_table)
    changed = changed_days(stored, enriched.select(stored.columns))
    if not changed:
        return Refreshed((), ())
    replaced = {d for d, stays in changed.items() if stays}
    gone = changed.keys() - replaced
    if replaced:
        layout.refresh_dates(enriched.select(stored.columns).where(in_days(replaced)), "gold", enriched_table)
    drop_days(spark, layout.path("gold", enriched_table), gone)

    current = layout.read(spark, "gold", enriched_table)
    untimed = {r[DAY_COLUMN] for r in current.where("txn_datetime is null").select(DAY_COLUMN).distinct().collect()}
    reached = {d + timedelta(days=k) for d in changed if d is not None for k in range(REACH + 1)}
    wanted = (reached | (changed.keys() & {None}) | untimed)
    present = {r[DAY_COLUMN] for r in current.select(DAY_COLUMN).distinct().collect()}
    recomputed = wanted & present
    if recomputed:
        needed = recomputed | {d - timedelta(days=k) for d in recomputed if d is not None for k in range(REACH + 1)}
        source = current.where(in_days(needed) | _c("txn_datetime").isNull())
        columns = layout.read(spark, "gold", feature_table).columns
        made = features.ml_features(source).where(in_days(recomputed)).select(columns)
        layout.refresh_dates(made, "gold", feature_table)
    drop_days(spark, layout.path("gold", feature_table), gone)
    order = lambda days: tuple(sorted(days, key=lambda d: (d is None, d or date.min)))
    return Refreshed(order(changed), order(recomputed))
