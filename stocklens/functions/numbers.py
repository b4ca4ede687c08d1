"""Number rules of the reports: defaults, conversions that truncate or round."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def sum_where(condition: str, value: str) -> Column:
    """Sum of ``value`` over the rows meeting ``condition``; NULL when there are none."""
    return F.expr(f"sum({value}) FILTER (WHERE {condition})")


def add_up(terms: Iterable[str]) -> Column:
    """Sum of columns, a NULL counting as 0."""
    return F.expr(" + ".join(f"coalesce({t}, 0D)" for t in terms))


def to_decimal(c: Column, precision: int, scale: int) -> Column:
    """Decimal of a double, rounded half up; raises when it does not fit.

    The step over ten digits removes the last-bit noise of a division, so that
    5.004999999999999 (100.1 / 20) rounds as 5.005 does.
    """
    return c.cast("decimal(38,10)").cast(f"decimal({precision},{scale})")


def to_whole(c: Column) -> Column:
    """Whole number toward zero, as the reports show quantities.

    64 bits: the stock of one product may exceed 32.
    """
    return c.cast("bigint")


def number_text(c: Column) -> Column:
    """Number as text: whole numbers without a decimal point."""
    return F.when(c == F.floor(c), c.cast("bigint").cast("string")).otherwise(c.cast("string"))


def text_or_blank(present: Column, value: Column) -> Column:
    """Number as text where ``present`` is not NULL, else an empty text."""
    return F.when(present.isNull(), "").otherwise(number_text(value))
