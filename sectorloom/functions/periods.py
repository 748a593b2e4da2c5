"""Calendar keys and date windows.

Keys are built through DATE so that they do not depend on the session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def period_start(ts: Column, unit: str) -> Column:
    """First moment of the month, quarter or year holding ``ts``."""
    return F.trunc(ts.cast("date"), unit).cast("timestamp_ntz")


def year_stamp(year: Column) -> Column:
    """January 1st of a year given as text or number; text may go on after the year, as in ``2023/24``.

    NULL if it does not begin with a year.
    """
    first = F.lit(1)
    midnight = F.lit(0)
    return F.try_make_timestamp_ntz(
        F.regexp_extract(year.cast("string"), r"^\s*(\d{4})(?!\d)", 1).try_cast("int"), first, first, midnight, midnight, midnight
    )


def within_year(day: Column, year: int) -> Column:
    """Dates of one year, as a range that file statistics can prune."""
    start, stop = dt.date(year, 1, 1), dt.date(year + 1, 1, 1)
    return (day >= F.lit(start)) & (day < F.lit(stop))


def full_months_before(as_of: dt.date, months: int) -> tuple[Column, Column]:
    """[start, stop) of the ``months`` complete months before the month of ``as_of``."""
    stop = as_of.replace(day=1)
    year, month = divmod(stop.year * 12 + stop.month - 1 - months, 12)
    start = dt.date(year, month + 1, 1)
    return _moment(start), _moment(stop)


def _moment(day: dt.date) -> Column:
    return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")
