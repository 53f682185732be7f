"""Date column functions (C13, C14), registered for SQL use by X1."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def format_date(ts: str | Column) -> Column:
    """``YYYY-MM-DD`` with the year space-padded to 4; null gives ''."""
    t = _c(ts).cast("timestamp")
    # format_string prints null arguments as "null", so test for null first
    return F.when(t.isNull(), F.lit("")).otherwise(
        F.format_string("%4d-%02d-%02d", F.year(t), F.month(t), F.dayofmonth(t)))


# Age periods, largest first: (unit seconds on the day count or
# the in-day seconds, singular, plural).  Days are floored like integer division.
PERIODS = [("days", 365, "year", "years"), ("days", 30, "month", "months"), ("days", 7, "week", "weeks"),
           ("days", 1, "day", "days"), ("secs", 3600, "hour", "hours"), ("secs", 60, "minute", "minutes"),
           ("secs", 1, "second", "seconds")]


def pretty_date(ts: str | Column, now: str | _dt.datetime | Column, default: str = "just now") -> Column:
    """C14: age text such as ``3 days ago``.

    The difference ``now - ts`` is split like a time delta into whole days
    (floored, so a future time gives -1 days) and seconds inside the day; the
    first non-zero of years (days/365), months (days/30), weeks, days, hours,
    minutes, seconds wins, with the singular for exactly 1.  All zero gives
    ``default``.  ``now`` is a parameter so results are reproducible.
    """
    if isinstance(now, _dt.datetime):
        now_c = F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    elif isinstance(now, str):
        now_c = F.lit(now).cast("timestamp_ntz")
    else:
        now_c = now
    # wall-clock difference, independent of the session time zone
    t = _c(ts).cast("timestamp_ntz")
    diff_us = F.timestamp_diff("MICROSECOND", t, now_c.cast("timestamp_ntz"))
    total_s = F.floor(diff_us / F.lit(1_000_000))
    days = F.floor(total_s / F.lit(86400))
    secs = total_s - days * 86400
    out = F.lit(default)
    for base, unit, one, many in reversed(PERIODS):
        v = F.floor((days if base == "days" else secs) / F.lit(unit)).cast("long")
        txt = F.when(v == 1, F.format_string("%d %s ago", v, F.lit(one))) \
               .otherwise(F.format_string("%d %s ago", v, F.lit(many)))
        out = F.when(v != 0, txt).otherwise(out)
    return F.when(t.isNull(), F.lit(None).cast("string")).otherwise(out)
