"""Date helpers: two-digit years, weekday names, week starts, second differences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day_month_yy(c: Column, pivot: int = 70) -> Column:
    """Parse ``d/M/yy`` text (one- or two-digit day and month) to DATE.

    Two-digit years ``>= pivot`` belong to the 1900s, the rest to the 2000s, as the PostgreSQL
    ``YY`` field does; Spark alone would put every year in 2000-2099.
    """
    d = F.to_date(c, "d/M/yy")
    return F.when(F.year(d) >= 2000 + pivot, F.add_months(d, -1200)).otherwise(d)


def day_name(c: Column, padded: bool = False) -> Column:
    """English weekday name; ``padded`` blank-pads to 9 characters like ``TO_CHAR(x, 'Day')``."""
    name = F.date_format(c, "EEEE")
    return F.rpad(name, 9, " ") if padded else name


def week_start(c: Column, anchor: str | dt.date | None = None) -> Column:
    """Start of the 7-day period holding ``c`` as TIMESTAMP_NTZ.

    Without ``anchor`` weeks start on Monday (``date_trunc('week', …)``); with an anchor date the
    periods are ``anchor + 7k`` days.
    """
    if anchor is None:
        return F.date_trunc("week", c).cast("timestamp_ntz")
    a = F.lit(anchor).cast("date")
    days = F.date_diff(c.cast("date"), a)
    return F.date_add(a, (F.floor(days / 7) * 7).cast("int")).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end`` (``EXTRACT(EPOCH FROM end - start)`` for whole-second data)."""
    return F.timestamp_diff("SECOND", start, end)
