"""Null-preserving arithmetic. "Not applicable" stays NULL; it never becomes zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: str | Column) -> Column:
    return col(c).cast("double")


def rounded(c: str | Column, digits: int) -> Column:
    """Round half away from zero with plain double arithmetic, so that every engine gives the same digits."""
    x, scale = dbl(c), float(10**digits)
    return F.signum(x) * F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double; NULL when the denominator is zero or missing."""
    return dbl(num) / F.nullif(dbl(den), F.lit(0.0))


def pct(num: str | Column, den: str | Column, digits: int = 1) -> Column:
    return rounded(F.lit(100.0) * dbl(num) / F.nullif(dbl(den), F.lit(0.0)), digits)


def total(c: str | Column) -> Column:
    """Sum as double. Decimal and integer inputs are added exactly first, so row order cannot matter."""
    return dbl(F.sum(col(c)))


def mean(c: str | Column) -> Column:
    """Average that ignores NULL: exact sum, then one division."""
    return total(c) / F.nullif(dbl(F.count(col(c))), F.lit(0.0))


def n_rows() -> Column:
    return F.count(F.lit(1))


def count_where(cond: Column) -> Column:
    """Rows for which the condition is true, as bigint (0 for an empty input)."""
    return F.count_if(cond)


def flag(cond: Column) -> Column:
    """0/1 integer; an unknown condition counts as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")
