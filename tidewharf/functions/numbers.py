"""Rounding, means and shares whose result does not depend on how rows are partitioned.

Money and rates are stored as decimals. Their sums are exact in any order; dividing only at the end
keeps every average identical from run to run, which a sum of doubles is not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(value: Column, digits: int) -> Column:
    """Round half away from zero, as SQL numerics do; the result is a double."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def half_even(value: Column, digits: int = 0) -> Column:
    """Round half to even on doubles, as array libraries do."""
    scale = float(10**digits)
    return F.rint(value.cast("double") * scale) / F.lit(scale)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, null where the divisor is zero or null."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def total(value: Column) -> Column:
    """Exact sum given back as a double."""
    return F.sum(value).cast("double")


def mean(value: Column) -> Column:
    """Average over non-null values with an exact sum; null when there is none."""
    return ratio(F.sum(value), F.count(value))


def mean_where(value: Column, condition: Column) -> Column:
    """Average of ``value`` over the rows for which ``condition`` is true."""
    return mean(F.when(condition, value))


def share(condition: Column) -> Column:
    """Share of all rows for which ``condition`` is true; a null condition counts as false."""
    return ratio(F.count_if(condition), F.count(F.lit(1)))


def row_count() -> Column:
    return F.count(F.lit(1))


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start)


def cap(value: Column, low: Column | float | None = None, high: Column | float | None = None) -> Column:
    """Clamp to bounds and leave nulls alone (``greatest``/``least`` would replace them)."""
    out = value
    if low is not None:
        low = low if isinstance(low, Column) else F.lit(low)
        out = F.when(out < low, low).otherwise(out)
    if high is not None:
        high = high if isinstance(high, Column) else F.lit(high)
        out = F.when(out > high, high).otherwise(out)
    return out
