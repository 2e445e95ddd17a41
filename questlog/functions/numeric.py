"""Exact ratios and money arithmetic as Column expressions.

Ratios are divided as decimals, so the digits kept before the final
``round`` (14 or more) make the result independent of float summation
order and of binary rounding ties (``round(1.005, 2)``). The final value
is a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MONEY

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: ColumnOrName) -> Column:
    """Cast to ``decimal(18,2)`` (all money in the data has 2 decimals)."""
    return _col(c).cast(MONEY)


def ratio(num: ColumnOrName, den: ColumnOrName, digits: int, num_scale: int = 0, den_scale: int = 0) -> Column:
    """``round(num / den, digits)`` as double; NULL when ``den`` is 0 or NULL
    (the ``SAFE_DIVIDE`` rule).

    ``num_scale`` / ``den_scale`` are the decimal places of the operands
    (0 for counts, 2 for money). Operands are widened to ``decimal(24, s)``
    which leaves Spark at least 14 fraction digits in the quotient.
    """
    n = _col(num).cast(f"decimal(24,{num_scale})")
    d = _col(den).cast(f"decimal(24,{den_scale})")
    return F.round(F.try_divide(n, d), digits).cast("double")


def exact_mean(c: ColumnOrName, digits: int, scale: int = 0) -> Column:
    """Mean of non-NULL values (like ``AVG``), exact before rounding.

    Aggregate expression: use inside ``agg``.
    """
    x = _col(c).cast(f"decimal(24,{scale})")
    return ratio(F.sum(x), F.count(x), digits, num_scale=scale)


def money_to_double(c: ColumnOrName) -> Column:
    return _col(c).cast("double")


def round_money(c: ColumnOrName, digits: int = 2) -> Column:
    return F.round(_col(c).cast("decimal(38,2)"), digits).cast("double")
