"""Running totals and ranks over groups of any size.

A plain ``sum().over(partition by key order by x)`` puts a whole key into one task. Here the order is
given as nested levels (say day, then second): totals run inside each inner group, and the totals of
the groups before it are carried in from a coarser, much smaller table. Each task sees one inner group
or one list of inner groups; their sizes follow from the levels chosen, not from the number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


_GROUP = "_group"  # the columns of a group as one struct: never NULL itself, NULL fields are equal


def running_totals(df: DataFrame, keys: Sequence[str], levels: Sequence[str],
                   measures: Sequence[str] | Mapping[str, Column], inclusive: bool = True,
                   formed: Mapping[str, Column] | None = None) -> DataFrame:
    """Replace each measure by its running total along ``levels`` within ``keys``.

    Inclusive totals take in all peers, the rows equal in all levels. Exclusive ones stop before the
    row and need rows without peers. Measures must be exact (integers, decimals), so that totals do
    not depend on the order in which they are formed.

    The window and the join with the carried-in totals share one partitioning by group. A mapping gives measures as
    expressions of the other columns, which must not be NULL; they are formed where the rows have moved to, as are the
    columns ``formed``, so that the rows move without them, and the columns that start with ``_`` end there. The totals
    of the groups then come from the moved rows, too; the last level must not be NULL.
    """
    *outer, last = levels
    group = [*keys, *outer]
    kept = [c for c in df.columns if c not in measures]
    grouped = df.withColumn(_GROUP, F.struct(*group)).drop(*group)
    if isinstance(measures, Mapping):
        kept = [c for c in kept if not c.startswith("_")]
        moved = grouped.repartition(_GROUP)
        # asks for all that the window asks for, so that one exchange serves both
        per_group = moved.groupBy(_GROUP).agg(
            *[F.sum(c).alias(m) for m, c in measures.items()], F.max(last).alias("_last")).where("_last is not null")
        added = {**(formed or {}), **measures}
        grouped = moved.select(_GROUP, *[c for c in kept if c not in group], *[c.alias(n) for n, c in added.items()])
        kept += list(formed or {})
    else:
        per_group = grouped.groupBy(_GROUP).agg(*[F.sum(m).alias(m) for m in measures])
    order = Window.partitionBy(_GROUP).orderBy(last)
    if inclusive:
        frame = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    else:
        frame = order.rowsBetween(Window.unboundedPreceding, -1)
    local = grouped.withColumns({m: F.coalesce(F.sum(m).over(frame), F.lit(0)) for m in measures})
    kept = [f"{_GROUP}.{c}" if c in group else c for c in kept]
    if not outer:
        return local.select(*kept, *measures)
    before = running_totals(per_group.select(f"{_GROUP}.*", *measures), keys, outer, list(measures), inclusive=False)
    before = before.select(F.struct(*group).alias(_GROUP), *[F.col(m).alias(f"_before_{m}") for m in measures])
    return local.join(before, _GROUP, "left").selectExpr(
        *kept, *[f"{m} + coalesce(_before_{m}, 0) as {m}" for m in measures])


def positions(df: DataFrame, keys: Sequence[str], levels: Sequence[str], tie_break: str,
              name: str = "position") -> DataFrame:
    """``row_number()`` of each row within ``keys``, ordered by ``levels`` then ``tie_break``.

    Only rows equal in all levels are sorted together; everything before them is a carried-in count.
    """
    group = [*keys, *levels]
    grouped = df.withColumn(_GROUP, F.struct(*group))
    counts = grouped.groupBy(_GROUP).agg(F.count(F.lit(1)).alias("_ahead")).select(f"{_GROUP}.*", "_ahead")
    ahead = running_totals(counts, keys, levels, ["_ahead"], inclusive=False).select(
        F.struct(*group).alias(_GROUP), "_ahead")
    inside = F.row_number().over(Window.partitionBy(_GROUP).orderBy(tie_break))
    return (
        grouped.withColumn("_inside", inside).join(ahead, _GROUP, "left")
        .withColumn(name, F.col("_ahead") + F.col("_inside")).drop("_inside", "_ahead", _GROUP)
    )
