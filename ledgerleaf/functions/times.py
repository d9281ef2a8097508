"""Time arithmetic. "Now" is always an argument, so every job can be repeated."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def as_datetime(as_of: datetime | date | str) -> datetime:
    """A naive UTC datetime from a datetime, a date or ISO text."""
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    elif not isinstance(as_of, datetime):
        as_of = datetime(as_of.year, as_of.month, as_of.day)
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    return as_of


def utc_now() -> datetime:
    """The clock, for callers that measure; jobs themselves take their times as arguments."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def ts_literal(as_of: datetime | date | str) -> Column:
    """A ``timestamp_ntz`` literal: foldable, so comparisons with it reach the scan."""
    return F.lit(as_datetime(as_of).isoformat(sep=" ")).cast("timestamp_ntz")


def older_than(ts: Column, as_of, **age: float) -> Column:
    """``ts < as_of - age``; the cut-off is computed once, in the literal."""
    return ts < ts_literal(as_datetime(as_of) - timedelta(**age))


def within_last(ts: Column, as_of, **age: float) -> Column:
    """``ts > as_of - age``."""
    return ts > ts_literal(as_datetime(as_of) - timedelta(**age))


def boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """Number of unit boundaries crossed between two times.

    10:00:59 to 10:01:01 is one minute here, where counting whole units gives zero.
    """
    size = UNIT_SECONDS[unit]

    def index(ts: Column) -> Column:
        # seconds since a fixed day without a time zone: no clock change moves a boundary
        local = ts.cast("timestamp_ntz")
        seconds = F.datediff(local.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
        return F.floor((seconds + F.hour(local) * 3600 + F.minute(local) * 60 + F.floor(F.second(local))) / F.lit(size))

    return (index(end) - index(start)).cast("bigint")
