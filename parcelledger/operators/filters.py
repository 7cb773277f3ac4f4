"""Window scans as half-open ranges on the raw instant column (pushed to the scan)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame

from parcelledger.functions.columns import ColumnLike, as_column
from parcelledger.functions.time import JAKARTA, months_before, utc_bound


def since(instant: ColumnLike, day: date, tz: str = JAKARTA) -> Column:
    """Predicate: the local date of ``instant`` is ``day`` or later."""
    return as_column(instant) >= utc_bound(day, tz)


def within_days(instant: ColumnLike, first: date, last: date, tz: str = JAKARTA) -> Column:
    """Predicate: the local date of ``instant`` lies in ``first..last`` inclusive."""
    until = utc_bound(last + timedelta(days=1), tz)
    return since(instant, first, tz) & (as_column(instant) < until)


def recent(df: DataFrame, instant: str, days: int, as_of: date, tz: str = JAKARTA) -> DataFrame:
    """Rows whose local date is at most ``days`` days before the reporting date."""
    return df.filter(since(instant, as_of - timedelta(days=days), tz))


def recent_months(
    df: DataFrame, instant: str, months: int, as_of: date, tz: str = JAKARTA
) -> DataFrame:
    """Rows whose local date is at most ``months`` calendar months back."""
    return df.filter(since(instant, months_before(as_of, months), tz))


def on_days(
    df: DataFrame, instant: str, as_of: date, days: int = 1, tz: str = JAKARTA
) -> DataFrame:
    """Rows of the ``days`` whole local days that end with the day before ``as_of``."""
    yesterday = as_of - timedelta(days=1)
    return df.filter(within_days(instant, as_of - timedelta(days=days), yesterday, tz))
