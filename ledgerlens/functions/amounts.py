"""Amounts as exact integers, for sums that are added to and undone: whole units of the last digit kept.

A sum has two limbs, ``high * BASE + low``, a sum of squares three; each limb is summed on its own and nothing is
rounded or lost on the way, whether the amounts are 0.004 or 2e15. The same type serves batch frames and streams.
Amounts from 1e20 on, and what is not a number, count as missing.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 4
BASE = 10 ** 9
WIDE = "decimal(38,0)"


# Below, a product with a power of ten is right to far less than half a unit; above, the decimal text of the double is.
PLAIN_BELOW = 1e11


def limbs(amount: Column, digits: int = DIGITS) -> tuple[Column, Column]:
    """High and low limb of an amount, 64-bit integers of the amount's sign."""
    amount, base = amount.cast("double"), F.lit(BASE).cast("long")
    plain = F.abs(amount) < PLAIN_BELOW
    short = F.round(amount * 10 ** digits).try_cast("long")
    exact = amount.try_cast(f"decimal({20 + digits},{digits})") * F.lit(10 ** digits).cast("decimal(10,0)")
    wide = exact.try_cast("decimal(30,0)")
    div = lambda x: F.call_function("div", x, base)
    high = F.when(plain, div(short)).otherwise(div(wide))
    return high, F.when(plain, short % base).otherwise((wide % base).cast("long"))


def square_limbs(high: Column, low: Column) -> tuple[Column, Column, Column]:
    """``a, b, c`` with ``a * BASE ** 2 + 2 * b * BASE + c`` the square."""
    high, low = high.cast("decimal(19,0)"), low.cast("decimal(19,0)")
    return (high * high).cast(WIDE), (high * low).cast(WIDE), (low * low).cast(WIDE)


def total(high: Column, low: Column, digits: int = DIGITS) -> Column:
    """The amount that two summed limbs stand for."""
    whole = high.cast("decimal(20,0)") * F.lit(BASE).cast("decimal(10,0)") + low.cast("decimal(20,0)")
    return (whole * F.lit(Decimal(1).scaleb(-digits))).cast("double")  # in decimals: rounded once


def sample_stddev(n: Column, sums: tuple[Column, Column], squares: tuple[Column, Column, Column],
                  digits: int = DIGITS) -> Column:
    """Sample deviation from exact moments; NULL below two values, exactly 0 for equal ones.

    ``n * squares - sum ** 2`` is formed limb by limb, so large amounts that differ by cents do not cancel each other
    out. It is exact up to 38 digits; beyond, the leading limbs are."""
    n38, high, low = (x.cast("decimal(19,0)") for x in (n, *sums))
    part = lambda square, x, y: F.try_subtract(F.try_multiply(n38, square), F.try_multiply(x, y))
    a, b, c = (part(s, x, y).cast(WIDE) for s, x, y in zip(squares, (high, high, low), (high, low, low)))
    base, two = F.lit(BASE).cast("decimal(10,0)"), F.lit(2).cast("decimal(1,0)")
    leading = F.try_add(F.try_multiply(a, base), F.try_multiply(b, two)).cast(WIDE)
    whole = F.try_add(F.try_multiply(leading, base), c)
    real = lambda x: x.cast("double")
    near = n.cast("double") * (real(squares[0]) * BASE ** 2 + real(squares[1]) * 2 * BASE + real(squares[2])) - (
        real(high) * BASE + real(low)) * (real(high) * BASE + real(low))
    spread = F.coalesce(real(whole), real(leading) * BASE + real(c), F.greatest(near, F.lit(0.0)))
    return F.when(n > 1, F.sqrt(spread / (n * (n - 1)).cast("double")) / 10 ** digits)
