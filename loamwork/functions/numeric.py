"""Numeric parsing and cleaning. Text that is no number becomes null, never an error."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def to_int(column: Column) -> Column:
    return column.try_cast("bigint")


def to_double(column: Column) -> Column:
    return column.try_cast("double")


def sentinel_to_zero(column: Column, sentinel: str = "?") -> Column:
    """The missing-value mark becomes 0; other junk becomes null."""
    return F.when(column == sentinel, F.lit(0.0)).otherwise(to_double(column))


def clamp_negative(column: Column) -> Column:
    """Negative values become 0; null stays null."""
    return F.when(column < 0, F.lit(0.0)).otherwise(column)


def truncate(column: Column) -> Column:
    """Drop the fraction, toward zero."""
    return column.cast("bigint")


def shift_label(column: Column, by: int = 1) -> Column:
    """One-based class codes to zero-based."""
    return column - F.lit(by)


def one_hot(index: Column, size: int) -> Column:
    """Array of ``size`` doubles with 1.0 at a zero-based index."""
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: (i == index).cast("double"))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
