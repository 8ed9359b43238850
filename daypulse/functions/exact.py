"""Means and sums that do not depend on how rows are partitioned, where columns allow it.

Floating-point sums depend on the order in which partitions are merged, so a
report computed on 8 or on 8,000 tasks could differ in the last bit and then
round differently. Columns that are fixed-point (integers, decimals, or doubles
declared to have at most 9 decimals) are therefore summed as DECIMAL(38, 9), which is
exact. Other doubles are summed as doubles: no magnitude is cut, and a NaN among
the values makes the mean NaN.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEC = T.DecimalType(38, 9)
CENTS = T.DecimalType(18, 2)


def dec(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(DEC)


def fixed_columns(df: DataFrame, declared: Iterable[str] = ()) -> set[str]:
    """The columns that are summed exactly: integers, decimals and the declared ones."""
    return set(declared) | {f.name for f in df.schema.fields
                            if isinstance(f.dataType, (T.IntegralType, T.DecimalType))}


def summable(name: str, fixed: set[str]) -> Column:
    """The column as it is summed: DECIMAL(38, 9) if fixed-point, DOUBLE otherwise."""
    return dec(name) if name in fixed else F.col(name).cast("double")


def mean_of(total: Column, count: Column) -> Column:
    """``total / count`` as DOUBLE, NULL without values."""
    return F.try_divide(total, count).cast("double")


def round_half_up(c: Column, scale: int) -> Column:
    """Round half-up to ``scale`` decimals and return DOUBLE.

    The value is first brought to DECIMAL(38, 9), so binary noise below 1e-9
    cannot move a tie: 117.375 computed as 117.37499999999999 still rounds to
    117.38, as the exact value does. NaN and values beyond DECIMAL(38, 9) are
    rounded as doubles.
    """
    exact = F.round(c.try_cast(DEC), scale).cast("double")
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.coalesce(exact, F.round(c.cast("double"), scale)))


def round2(c: Column) -> Column:
    """Round half-up to 2 decimals and return DOUBLE."""
    return round_half_up(c, 2)
