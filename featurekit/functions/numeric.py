"""Column expressions on numbers."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def amount_decimals(amount: str | Column, scale: int = 1000) -> Column:
    """Fraction digits of an amount as an integer, truncated towards zero."""
    x = F.col(amount) if isinstance(amount, str) else amount
    return ((x - x.cast("bigint")) * scale).cast("bigint")


def natural_log(amount: str | Column) -> Column:
    """Natural logarithm; null for zero and negative input."""
    x = F.col(amount) if isinstance(amount, str) else amount
    return F.when(x > 0, F.ln(x))


def null_share(columns: list[str]) -> Column:
    """Share of null cells among the named columns of a row."""
    return reduce(add, [F.col(c).isNull().cast("int") for c in columns]) / F.lit(len(columns))


def zero_share(columns: list[str], numeric: list[str]) -> Column:
    """Zero cells (only numeric columns can hold one) over the non-null cells of a row."""
    zeros = reduce(add, [F.coalesce((F.col(c) == 0).cast("int"), F.lit(0)) for c in numeric])
    filled = reduce(add, [F.col(c).isNotNull().cast("int") for c in columns])
    return F.try_divide(zeros, filled)


def deviation(value: str | Column) -> Column:
    """Sample deviation of a group, exactly 0 where all its values are equal; null below two values.

    Merged means of equal values differ in their last digit, which :func:`stddev_samp` takes for a deviation.
    """
    low, high = F.min(value), F.max(value)
    return F.when((F.count(value) > 1) & (low == high), (high - low).cast("double")).otherwise(F.stddev_samp(value))


def nan_to_null(column: str) -> Column:
    return F.when(~F.isnan(column), F.col(column))
