"""Readable texts built from columns, without Python per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def contributions(names: Sequence[str], values: Sequence[Column] | None = None) -> Column:
    """``array<struct<feature, value>>`` over one row's contribution columns."""
    values = values or [F.col(n) for n in names]
    return F.array(*[
        F.struct(F.lit(n).alias("feature"), F.lit(i).alias("position"), v.cast("double").alias("value"))
        for i, (n, v) in enumerate(zip(names, values))
    ])


def strongest(entries: Column, n: int) -> Column:
    """The ``n`` entries of largest magnitude, ties in the given feature order."""
    keyed = F.transform(entries, lambda e: F.struct(
        (-F.abs(e["value"])).alias("order"), e["position"].alias("position"),
        e["feature"].alias("feature"), e["value"].alias("value")))
    return F.slice(F.array_sort(keyed), 1, n)


def driver_text(entries: Column, n: int = 3, digits: int = 3) -> Column:
    """``feature(+0.123), ...`` for the ``n`` strongest contributions."""
    parts = F.transform(strongest(entries, n), lambda e: F.format_string(
        f"%s(%+.{digits}f)", e["feature"], e["value"]))
    return F.concat_ws(", ", parts)


def sentence(parts: Sequence[Column], separator: str = "; ") -> Column:
    """Join the parts that are present."""
    return F.concat_ws(separator, F.array_compact(F.array(*parts)))
