"""Aggregate expressions.

Text aggregation (a comma-joined list per group) is built from sorted
arrays so that the result does not depend on row order. Lists with
repeats are built from (value, count) pairs: the array gathered per group
is bounded by the number of distinct values, the counts are 64-bit and are
combined map-side before the shuffle. The text itself holds every repeat,
so it is as long as the group's history; a text that would pass the 2 GB of
one cell fails with a message, and the counted rows are the form to use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.functions.text import col_of

TEXT_AGG_SEPARATOR = ","


def join_or_null(arr: Column, sep: str = TEXT_AGG_SEPARATOR) -> Column:
    """``sep``-joined array; NULL when there is nothing to join (as a SQL
    text aggregate over only NULLs)."""
    return F.when(F.size(arr) > 0, F.array_join(arr, sep))


def concat_distinct(c: str | Column, sep: str = TEXT_AGG_SEPARATOR) -> Column:
    """Sorted distinct non-NULL values of a group joined by ``sep``."""
    return join_or_null(F.array_sort(F.collect_set(col_of(c))), sep)


def collect_counted(value: str | Column, count: str | Column) -> Column:
    """Aggregate: sorted array of struct(value, n) for pre-counted rows."""
    return F.array_sort(F.collect_list(F.struct(col_of(value).alias("value"), col_of(count).cast("bigint").alias("n"))))


MAX_TEXT = (1 << 31) - 64


def expand_counted(counted: Column, sep: str = TEXT_AGG_SEPARATOR) -> Column:
    """Join a sorted struct(value, n) array into text, value repeated n times
    (by repeating the text, not by an array of n values).

    NULL values are skipped; NULL when no value is left.
    """
    present = F.filter(counted, lambda s: s["value"].isNotNull())
    size = F.aggregate(present, F.lit(0.0), lambda a, s: a + (F.octet_length(s["value"]) + len(sep)) * s["n"])

    def often(s: Column) -> Column:
        n = F.least(s["n"], F.lit(MAX_TEXT)).cast("int")
        return F.concat(F.repeat(F.concat(s["value"], F.lit(sep)), n - 1), s["value"])

    text = join_or_null(F.transform(present, often), sep)
    return F.when(size > MAX_TEXT, F.raise_error(F.lit(
        "a text of over 2 GB does not fit one cell: use the counted rows"))).otherwise(text)


def exact_avg(c: str | Column) -> Column:
    """Mean as double from an exact sum and count (order independent)."""
    c = col_of(c)
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))
