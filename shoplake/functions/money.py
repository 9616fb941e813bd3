"""Exact money arithmetic.

Money is DOUBLE at the edges (Silver/Gold columns) and DECIMAL(18,2) inside
every sum and average, so results do not depend on the order in which
partial sums are combined across tasks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(4, 2)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Value as DECIMAL(18,2) (cast rounds half-up to cents)."""
    return _c(c).cast(MONEY)


def out(c: Column | str) -> Column:
    """A DECIMAL result leaving the lake as DOUBLE."""
    return _c(c).cast(T.DoubleType())


def money_sum(c: Column | str) -> Column:
    """Exact sum of a money column, as DOUBLE."""
    return out(F.sum(money(c)))


def exact_mean2(total: Column, n: Column) -> Column:
    """Mean rounded half-up to 2 places, from an exact DECIMAL total.

    DECIMAL(28,2) / BIGINT keeps 12 fractional digits before the final
    rounding, which is exact for any group below 10^10 rows (a closer tie
    would need 200*r - m*n = 0 exactly). ``avg`` on a DECIMAL keeps only 6
    digits and can round twice.
    """
    return out(F.round(total / n, 2))


def discounted(price: Column | str, discount: Column | str) -> Column:
    """price x (1 - discount) in DECIMAL, cents kept (scale 4)."""
    return money(price) * (F.lit(1).cast(RATE) - _c(discount).cast(RATE))


def pct(part: Column, whole: Column, places: int = 2) -> Column:
    """round(part * 100 / whole, places) in DOUBLE; NULL when whole is 0."""
    return F.round(F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double")), places) + F.lit(0.0)
