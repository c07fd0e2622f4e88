"""Date and time column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.functions.text import col_of

# A Sunday (start of the Sunday-first weekday list) and the
# English weekday names in dayofweek order (1 = Sunday).
SUNDAY = dt.date(1970, 1, 4)
WEEKDAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def weekday_name(c: str | Column) -> Column:
    """Full English weekday name ("Monday") of the calendar date of ``c``
    (no time-zone conversion of timestamp_ntz values)."""
    dow = F.dayofweek(col_of(c).cast("date"))
    name = F.when(dow == 1, F.lit(WEEKDAY_NAMES[0]))
    for i, n in enumerate(WEEKDAY_NAMES[1:], start=2):
        name = name.when(dow == i, F.lit(n))
    return name                     # NULL date -> NULL


def elapsed_minutes(start: str | Column, end: str | Column) -> Column:
    """Whole minutes from start to end, truncated toward zero (10m59s -> 10).

    Computed from the difference interval: for timestamp_ntz values that is
    wall-clock time, independent of the session time zone (timestamp_diff
    goes through the session zone and moves times inside a DST gap).
    """
    return (col_of(end) - col_of(start)).cast("interval minute").cast("bigint")


def week_bucket(c: str | Column, start: dt.date, end: dt.date, days: int = 7) -> Column:
    """1-based ``days``-long bucket of a date counted from ``start``.

    NULL outside [start, end]; the last bucket may be shorter (it stops at
    ``end``).
    """
    c = col_of(c)
    offset = F.datediff(c, F.lit(start))
    inside = c.between(F.lit(start), F.lit(end))
    return F.when(inside, F.floor(offset / days).cast("int") + 1)


def sunday_first_weekdays(position: Column) -> Column:
    """Weekday name for position 1 (Sunday) .. 7 (Saturday)."""
    return weekday_name(F.date_add(F.lit(SUNDAY), position - 1))
