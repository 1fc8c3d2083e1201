"""Dates, clocks and trailing windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from orefold import fixed_values as fixed
from orefold.functions.text import WHITE_SPACE

DISPLAY_DATE = "d MMM yyyy"
END_OF_TIME = "9999-12-31"


def as_of_date(as_of: str | dt.date | None = None) -> Column:
    """The report date as a column: given, or today."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def parse_display_date(c: Column) -> Column:
    """``22 Apr 2026`` -> date; anything else gives null.

    Outer and repeated blanks are accepted. A two-digit year gives null.
    """
    as_it_is = F.try_to_date(c, DISPLAY_DATE)
    # evaluated only for the few texts that do not parse as they are
    tidied = F.try_to_date(F.trim(F.regexp_replace(c, WHITE_SPACE, " ")), DISPLAY_DATE)
    return F.coalesce(as_it_is, tidied)


def iso_date(c: Column) -> Column:
    """``22 Apr 2026`` -> ``2026-04-22`` as text; anything else gives null."""
    return parse_display_date(c).cast("string")


def on_or_after(c: Column, days: int, as_of: str | dt.date | None = None) -> Column:
    """True from ``days`` days before the report date on; there is no upper end."""
    start = F.date_sub(as_of_date(as_of), days)
    return c >= start


def bar_clock(c: Column, clock: str = "wall") -> Column:
    """ISO text with an offset -> timestamp without zone.

    ``wall`` keeps the exchange's clock time, ``utc`` converts to UTC.
    """
    if clock == "wall":
        return c.cast("timestamp_ntz")
    if clock == "utc":
        return c.cast("timestamp").cast("timestamp_ntz")
    raise ValueError(f"clock must be 'wall' or 'utc', not {clock!r}")


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def day_bucket(ts: Column) -> Column:
    """The day as a never-null key; a null time sorts, and so falls, into the last one."""
    return F.coalesce(day_of(ts), F.lit(END_OF_TIME).cast("date"))


def grain_start(ts: Column, grain: str) -> Column:
    """Start of the hour, day, ... as a never-null key; a null time falls into the last one."""
    start = F.date_trunc(grain, ts).cast("timestamp_ntz")
    return F.coalesce(start, F.lit(END_OF_TIME).cast("timestamp_ntz"))


def report_date(trade_date: Column, lag_days: Column) -> Column:
    """Trade date plus the disclosure lag; a missing lag counts as none."""
    return F.date_add(trade_date, F.coalesce(lag_days, F.lit(0)))


def is_late(lag_days: Column) -> Column:
    """True or false, never null."""
    return F.coalesce(lag_days, F.lit(0)) > fixed.DISCLOSURE_WINDOW_DAYS
