"""Trailing time frames (``RANGE BETWEEN n PRECEDING AND CURRENT ROW``) in linear time.

A sliding window re-reads its frame for every row and holds a whole key in one task. Instead, rows are
first combined per key and second; each of these then enters every frame at its own second and leaves
a frame of length n at second + n + 1. The running total of the entries and exits *is* the frame value,
ties included. Running totals are split by day (``prefix.running_totals``), so the largest group one
task handles is the distinct seconds of one key in one day, whatever the number of rows.

Additive measures only; they must be exact (integers or decimals), as exits undo entries.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.joins import null_safe_left_join
from ledgerlens.operators.prefix import running_totals

DAY = 86_400


@dataclass(frozen=True)
class Trailing:
    """Sum of ``value`` over the frame of ``seconds`` up to and including the current second."""

    value: Column
    seconds: int


@dataclass(frozen=True)
class TrailingDistinct:
    """Number of distinct ``value`` (NULL not counted) in the frame of ``seconds``."""

    value: Column
    seconds: int


def _additive_moves(df: DataFrame, key: str, second: str,
                    frames: Mapping[str, Trailing]) -> tuple[DataFrame, dict[str, Column]]:
    """An entry and an exit a length of frames for each second, with each value once however many frames it is in, and
    what a move adds to each frame: ``_shift`` tells an entry (0) and the frames that an exit leaves."""
    values = {id(t.value): t.value for t in frames.values()}
    names = {k: f"_value_{n}" for n, k in enumerate(values)}
    per_second = df.groupBy(F.col(key), F.col(second).alias("at")).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(v).alias(names[k]) for k, v in values.items()])

    def step(shift: int, sign: str, active: set[int]) -> str:
        parts = "".join(f", '{n}', {sign if k in active else '0 * '}{n}" for k, n in names.items())
        return f"named_struct('_shift', {shift}L{parts})"

    lengths = sorted({t.seconds for t in frames.values()})
    steps = [step(0, "", set(values))] + [
        step(length + 1, "-", {id(t.value) for t in frames.values() if t.seconds == length}) for length in lengths]
    moves = per_second.selectExpr(key, "at", f"inline(array({', '.join(steps)}))").withColumn(
        "at", F.col("at") + F.col("_shift"))
    return moves, {n: F.coalesce(F.when(F.col("_shift").isin(0, t.seconds + 1), F.col(names[id(t.value)])), F.lit(0))
                   for n, t in frames.items()}


def _distinct_moves(df: DataFrame, key: str, second: str, name: str, frame: TrailingDistinct) -> DataFrame:
    """A value is in the frame from its first second until ``seconds`` after its last: one entry and
    one exit per unbroken presence, however often it recurs in between."""
    seen = df.select(F.col(key), F.col(second).alias("at"), frame.value.alias("value")).where(
        "value is not null").distinct()
    # Neighbours inside a day; a day's first and last second know those of the days next to it from a table with one
    # row a day, so the largest group in a task is one key and value in one day, or its list of days.
    seen = seen.withColumn("day", F.floor(F.col("at") / DAY))
    order = Window.partitionBy(key, "value", "day").orderBy("at")
    days = Window.partitionBy(key, "value").orderBy("day")
    edges = seen.groupBy(key, "value", "day").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    edges = edges.select(key, "value", "day", F.lag("last").over(days).alias("last_before"),
                         F.lead("first").over(days).alias("first_after"))
    seen = null_safe_left_join(seen, edges, [key, "value", "day"])
    before = F.coalesce(F.lag("at").over(order), F.col("last_before"))
    after = F.coalesce(F.lead("at").over(order), F.col("first_after"))
    enters = before.isNull() | (F.col("at") - before > frame.seconds)
    leaves = after.isNull() | (after - F.col("at") > frame.seconds)
    moves = F.array_compact(F.array(
        F.when(F.col("enters"), F.struct(F.col("at").alias("at"), F.lit(1).cast("long").alias(name))),
        F.when(F.col("leaves"), F.struct((F.col("at") + frame.seconds + 1).alias("at"),
                                         F.lit(-1).cast("long").alias(name)))))
    return (
        seen.withColumns({"enters": enters, "leaves": leaves}).select(key, F.explode(moves).alias("m"))
        .select(key, F.col("m.at").alias("at"), F.lit(-1).cast("long").alias("_shift"), F.col(f"m.{name}").alias(f"_{name}"))
    )


def trailing_frames(df: DataFrame, key: str, second: str,
                    frames: Mapping[str, Trailing | TrailingDistinct]) -> DataFrame:
    """One row per (``key``, ``second``) of ``df`` with the value of every frame there. Rows without a second are peers
    of each other: their frame holds them all and nothing else."""
    peers = df.where(F.col(second).isNull()).groupBy(key).agg(*[
        (F.coalesce(F.sum(f.value), F.lit(0)) if isinstance(f, Trailing) else F.countDistinct(f.value)).alias(n)
        for n, f in frames.items()]).withColumn(second, F.lit(None).cast(df.schema[second].dataType))
    df = df.where(F.col(second).isNotNull())
    sums = {n: f for n, f in frames.items() if isinstance(f, Trailing)}
    moves, added = _additive_moves(df, key, second, sums)
    for name, frame in frames.items():
        if isinstance(frame, TrailingDistinct):
            moves = moves.unionByName(_distinct_moves(df, key, second, name, frame), allowMissingColumns=True)
            added[name] = F.coalesce(F.col(f"_{name}"), F.lit(0))
    names = list(frames)
    moves = moves.withColumn("day", F.floor(F.col("at") / DAY))
    totals = running_totals(moves, [key], ["day", "at"], {n: added[n] for n in names},
                            formed={"is_row": F.col("_shift") == 0})
    timed = totals.where("is_row").select(key, F.col("at").alias(second), *names)
    return timed.unionByName(peers.select(key, second, *[F.col(n).cast(timed.schema[n].dataType) for n in names]))


def trailing_max(df: DataFrame, key: str, second: str, value: str, days: int, name: str) -> DataFrame:
    """Largest ``value`` in the trailing frame of ``days`` days, one row per (``key``, ``second``).

    A maximum cannot be undone, so the frame is cut at midnights: the rest of its first day from the
    frame's start on, the whole days between (at most ``days - 1`` rows), and the current day so far. Rows without a
    second are peers of each other.
    """
    peers = df.where(F.col(second).isNull()).groupBy(key).agg(F.max(value).alias(name)).select(
        key, F.lit(None).cast(df.schema[second].dataType).alias(second), name)
    df = df.where(F.col(second).isNotNull())
    per_second = df.groupBy(F.col(key), F.col(second).alias("at")).agg(F.max(value).alias("v")).withColumn(
        "day", F.floor(F.col("at") / DAY))
    so_far = F.max("v").over(Window.partitionBy(key, "day").orderBy("at").rangeBetween(
        Window.unboundedPreceding, Window.currentRow))
    between = per_second.groupBy(key, "day").agg(F.max("v").alias("v")).withColumn(
        "between", F.max("v").over(Window.partitionBy(key).orderBy("day").rangeBetween(1 - days, -1))
    ).select(key, "day", "between")
    starts = per_second.select(
        key, (F.col("at") - days * DAY).alias("at"), F.lit(None).cast("double").alias("v"),
        (F.col("day") - days).alias("day"), F.lit(True).alias("is_start"))
    from_start = F.max("v").over(Window.partitionBy(key, "day").orderBy(F.desc("at")).rangeBetween(
        Window.unboundedPreceding, Window.currentRow))
    first_day = (
        per_second.withColumn("is_start", F.lit(False)).unionByName(starts)
        .withColumn("first", from_start).where("is_start")
        .select(key, (F.col("at") + days * DAY).alias("at"), "first")
    )
    return (
        per_second.withColumn("so_far", so_far)
        .join(between, [key, "day"], "left").join(first_day, [key, "at"], "left")
        .select(key, F.col("at").alias(second), F.greatest("first", "between", "so_far").alias(name))
        .unionByName(peers)
    )
