"""Money, ratio, rounding and time expressions.

Sums of money go through DECIMAL: the result does not depend on the order in which partitions are merged, and a
retried task cannot change it. Four decimals and 24 digits before the point hold any amount; ``decimal_type`` says
otherwise where a table needs it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,4)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(c: Column | str, decimal_type: str = MONEY) -> Column:
    """Order-independent sum, NULL over no values, as double."""
    return F.sum(_col(c).cast(decimal_type)).cast("double")


def exact_avg(c: Column | str, decimal_type: str = MONEY) -> Column:
    """Order-independent mean, NULL over no values."""
    return F.try_divide(exact_sum(c, decimal_type), F.count(_col(c)).cast("double"))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division that yields NULL, not an error, on a zero denominator."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def rounded(c: Column | str, digits: int) -> Column:
    """Half-up rounding of the decimal value, free of binary tails such as 10.004999..."""
    return F.round(_col(c).cast("decimal(38,8)"), digits).cast("double")


def flag_sum(c: Column | str) -> Column:
    """Number of rows whose flag is true; NULL if no row has a flag."""
    return F.sum(_col(c).cast("long"))


def flag_count(c: Column | str) -> Column:
    """Number of rows whose flag is true, 0 if none."""
    return F.count_if(_col(c))


def percent_true(flag: Column | str, digits: int) -> Column:
    """Share of 0/1 ``flag`` among the rows that have one, in percent."""
    return rounded(ratio(F.sum(_col(flag).cast("long")), F.count(_col(flag))) * 100, digits)


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    return (F.unix_timestamp(_col(later)) - F.unix_timestamp(_col(earlier))) / 3600
