"""Cleaning of the raw delivery tables into typed columns (K1-K9).

The reference rewrites the columns in place with nine UPDATE statements.
Here each table is cleaned by one projection, fused by codegen into the
scan stage; the result is a new DataFrame and the input is untouched.
Cleaning is idempotent: a cleaned frame passes through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.text import NUMBER_TYPE, REFERENCE_NUMBER_PATTERN, extract_number, nullify


def _is_text(df: DataFrame, col: str) -> bool:
    return dict(df.dtypes).get(col) == "string"


def clean_runner_orders(df: DataFrame, number_pattern: str = REFERENCE_NUMBER_PATTERN,
                        number_type: str = NUMBER_TYPE) -> DataFrame:
    """cancellation: '' and 'null' -> NULL (K1, K2).
    distance: 'null' -> NULL, then the number in the text (K3, K4).
    duration: the number in the text; 'null' has none and becomes NULL (K5).
    pickup_time: text -> timestamp; unparsable text ('null') -> NULL.
    Numbers that do not parse after extraction ("10 5") become NULL.
    """
    out = {}
    if _is_text(df, "cancellation"):
        out["cancellation"] = nullify("cancellation")
    if _is_text(df, "distance"):
        out["distance"] = extract_number(nullify("distance", ("null",)), number_pattern, number_type)
    if _is_text(df, "duration"):
        out["duration"] = extract_number("duration", number_pattern, number_type)
    if _is_text(df, "pickup_time"):
        out["pickup_time"] = F.col("pickup_time").try_cast("timestamp_ntz")
    return df.withColumns(out) if out else df


def clean_customer_orders(df: DataFrame) -> DataFrame:
    """exclusions / extras: '' and 'null' -> NULL (K6-K9)."""
    return df.withColumns({"exclusions": nullify("exclusions"), "extras": nullify("extras")})
