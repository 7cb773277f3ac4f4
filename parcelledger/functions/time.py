"""UTC instants, local civil times and day arithmetic.

Every instant column holds UTC. Conversions happen only in projections; filters
compare the raw column with a bound computed on the driver, so they reach the scan.
"""

from __future__ import annotations

import calendar
from datetime import UTC, date, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelledger.functions.columns import ColumnLike, as_column

JAKARTA = "Asia/Jakarta"


def local_datetime(instant: ColumnLike, tz: str = JAKARTA) -> Column:
    """Civil date and time of a UTC instant in ``tz``; the session zone must be UTC.

    ``convert_timezone`` would parse the names of both zones for every row.
    """
    return F.from_utc_timestamp(as_column(instant).cast("timestamp"), tz).cast("timestamp_ntz")


def local_date(instant: ColumnLike, tz: str = JAKARTA) -> Column:
    """Civil date of a UTC instant in ``tz``."""
    return local_datetime(instant, tz).cast("date")


def day_start(day: ColumnLike) -> Column:
    """Midnight of a civil date as a datetime."""
    return as_column(day).cast("date").cast("timestamp_ntz")


def utc_bound(day: date, tz: str = JAKARTA) -> Column:
    """The UTC instant at which the civil ``day`` starts in ``tz``, as a literal."""
    midnight = datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(tz))
    wall = midnight.astimezone(UTC).replace(tzinfo=None)
    return F.lit(wall.isoformat(sep=" ")).cast("timestamp_ntz")


def months_before(day: date, months: int) -> date:
    """``day`` moved back by whole months, clamped to the end of a shorter month."""
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return date(year, month + 1, min(day.day, last))


def day_age(day: ColumnLike, as_of: date) -> Column:
    """Whole days from ``day`` to the reporting date."""
    return F.datediff(F.lit(as_of), as_column(day).cast("date"))
