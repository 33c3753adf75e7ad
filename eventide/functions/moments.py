"""Time helpers. Days and hours are those of the session zone, which the jobs keep at UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventide.context import wall_time


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def utc_day(column: str | Column) -> Column:
    return F.to_date(_col(column))


def hour_floor(column: str | Column) -> Column:
    return F.date_trunc("HOUR", _col(column))


def whole_seconds_between(end: str | Column, start: str | Column) -> Column:
    """Whole elapsed seconds from start to end; negative when end is earlier."""
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def in_days(column: str, first: dt.date, last: dt.date) -> Column:
    """Rows of a timestamp column between two days, both included.

    Written as a range on the bare column, so that file statistics can skip data; `to_date(ts) = d`
    could not.
    """
    begin = dt.datetime.combine(first, dt.time())
    end = dt.datetime.combine(last, dt.time()) + dt.timedelta(days=1)
    return (F.col(column) >= wall_time(begin)) & (F.col(column) < wall_time(end))
