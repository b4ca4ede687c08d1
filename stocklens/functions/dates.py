"""Date rules of the reports. Every window hangs on an explicit ``as_of`` date."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def session_today(spark: SparkSession) -> date:
    """Today in the session's time zone (``current_date()``), the default of every ``as_of``.

    The date of the query engine, as a database's own date would be, not the clock of the
    machine the driver runs on.
    """
    return spark.range(1).select(F.current_date()).first()[0]


def in_last_days(ts: Column, as_of: date, days: int) -> Column:
    """The day of ``ts`` lies 0 to ``days`` days before ``as_of``; later days are out.

    A plain range on the stored timestamp, so a Parquet scan can skip row groups.
    """
    first, after = as_of - timedelta(days=days), as_of + timedelta(days=1)
    return (ts >= F.lit(first)) & (ts < F.lit(after))


def in_year(ts: Column, year: int) -> Column:
    """``ts`` falls in the calendar year; a range, not ``year(ts)``, so scans can skip."""
    return (ts >= F.lit(date(year, 1, 1))) & (ts < F.lit(date(year + 1, 1, 1)))


def month_index(year: Column, month: Column) -> Column:
    """Months counted through the years: differences cross a year's end."""
    return year.cast("int") * 12 + month.cast("int")


def month_index_of(d: date) -> int:
    return d.year * 12 + d.month


def entry_clock(ts: Column) -> Column:
    """Time of entry on a 12-hour clock without am/pm: 13:23 shows as 01:23."""
    return F.date_format(ts, "hh:mm")
