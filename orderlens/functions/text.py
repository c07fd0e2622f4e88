"""Text column expressions: sentinels, number extraction, delimited lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sentinel texts that mean "no value", and the number
# pattern of the cleaning step. The pattern's '.' is unescaped and only one
# digit may follow it, so "23.45 km" gives "23.4" and "10 5" gives "10 5"
# (which then fails the numeric cast and becomes NULL).
NULL_SENTINELS = ("", "null")
REFERENCE_NUMBER_PATTERN = "[0-9]+.[0-9]|[0-9]+"
STRICT_NUMBER_PATTERN = "[0-9]+(\\.[0-9]+)?"
LIST_SEPARATOR = ","
# Wide enough for any number a person writes (26 digits before the point).
NUMBER_TYPE = "decimal(32,6)"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nullify(c: str | Column, sentinels: tuple[str, ...] = NULL_SENTINELS) -> Column:
    """NULL when the text is one of ``sentinels`` (exact, case-sensitive)."""
    c = col_of(c)
    return F.when(c.isin(*sentinels), F.lit(None).cast("string")).otherwise(c)


def extract_number(c: str | Column, pattern: str = REFERENCE_NUMBER_PATTERN,
                   dtype: str = NUMBER_TYPE) -> Column:
    """First match of ``pattern`` cast to ``dtype``; NULL on no match or bad text."""
    return F.regexp_substr(col_of(c), F.lit(pattern)).try_cast(dtype)


def list_tokens(c: str | Column, sep: str = LIST_SEPARATOR) -> Column:
    """Delimited text -> array of space-trimmed tokens (NULL text -> NULL array).

    Same result as splitting on ``sep`` and trimming every token, but done
    by one regex split of the trimmed text (codegen, no per-token lambda).
    Empty tokens (``"1, "``) are kept as ``""``; they match no id.
    """
    return F.split(F.trim(col_of(c)), f" *{sep} *")


def list_length(c: str | Column, sep: str = LIST_SEPARATOR) -> Column:
    """Number of separators + 1, NULL for NULL text."""
    c = col_of(c)
    return F.when(c.isNotNull(), F.size(F.split(c, sep)))
