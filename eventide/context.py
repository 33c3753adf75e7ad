"""Values that belong to one run: the run day, the run time and the run id."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunContext:
    """Everything a plan may ask the clock for, fixed once so that a replay gives the same rows."""

    ds: dt.date
    now: dt.datetime
    invocation_id: str = "manual"

    @classmethod
    def of(cls, ds: str, now: str | None = None, invocation_id: str = "manual") -> RunContext:
        day = dt.date.fromisoformat(ds)
        at = dt.datetime.fromisoformat(now) if now else dt.datetime.combine(day, dt.time(3))
        return cls(day, at, invocation_id)

    @property
    def ds_col(self) -> Column:
        return F.lit(self.ds.isoformat()).cast("date")

    @property
    def now_col(self) -> Column:
        return utc_literal(self.now)


def utc_literal(moment: dt.datetime) -> Column:
    """A UTC timestamp literal that does not depend on the zone of the driver process."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ") + "Z").cast("timestamp")


def wall_time(moment: dt.datetime) -> Column:
    """A moment to compare columns with, in UTC and without zone.

    Compared with a column without zone it needs no cast of the column, and compared with a zoned column
    Spark turns the literal into a zoned one, so either way the comparison reaches the file reader.
    """
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
