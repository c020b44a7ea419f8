"""Places of regular-expression matches, with DataFrame functions only.

``split`` gives the gaps between matches and ``regexp_extract_all`` the matches; the running lengths of both give the
places. All places count code points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def found(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def gaps(text: Column, pattern: str) -> Column:
    return F.split(text, pattern, -1)


def starts(gap_texts: Column, match_texts: Column) -> Column:
    """Where each match begins, in code points."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    pairs = F.arrays_zip(F.transform(gap_texts, F.length).alias("gap"), F.transform(match_texts, F.length).alias("len"))
    return F.aggregate(
        F.slice(pairs, 1, F.size(match_texts)), zero,
        lambda acc, p: F.struct((acc["at"] + p["gap"] + p["len"]).alias("at"),
                                F.concat(acc["out"], F.array(acc["at"] + p["gap"])).alias("out")),
        lambda acc: acc["out"])
