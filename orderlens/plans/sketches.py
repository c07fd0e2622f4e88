"""Distinct counts from stored sketches (the approximate form of Q2 and Q16).

A HyperLogLog sketch per small group (a day, a customer's month) is stored once;
sketches of any groups are united for the distinct count of all of them without
reading the facts again, and later facts are appended as further sketches. The
exact count stays the default of the library; the queries here state both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12
# Four standard errors of a sketch of 2**LG_K registers (1.04 / sqrt(4096) each).
ERROR_BOUND = 4 * 1.04 / (1 << LG_K) ** 0.5


def sketched(df: DataFrame, keys: Sequence[Column | str], value: Column) -> DataFrame:
    """One sketch of ``value`` (a whole number or text) per key."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, LG_K).alias("sketch"))


def distinct_from(stored: DataFrame, keys: Sequence[Column | str], out: str) -> DataFrame:
    """Approximate distinct count per key, from the united sketches."""
    return stored.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out))


def with_error(exact: DataFrame, estimated: DataFrame, keys: Sequence[str], count: str, estimate: str) -> DataFrame:
    """Exact counts, estimates and the relative error of each."""
    return exact.join(estimated, list(keys)).withColumn(
        "relative_error", F.abs(F.col(estimate) - F.col(count)) / F.col(count))


def customers_by_month(sales: DataFrame, stored: DataFrame) -> DataFrame:
    """Distinct customers of each month: exact, and from the sketches of its
    days. stored (order_date, sketch)."""
    keys = [F.year("order_date").alias("year"), F.month("order_date").alias("month")]
    exact = sales.groupBy(*keys).agg(F.count_distinct("customer_id").alias("customers"))
    return with_error(exact, distinct_from(stored, keys, "estimate"), ["year", "month"], "customers", "estimate")


def visit_days(sales: DataFrame, stored: DataFrame) -> DataFrame:
    """Distinct days of each customer: exact (Q2), and from the sketches of
    the customer's months. stored (customer_id, month, sketch)."""
    exact = sales.groupBy("customer_id").agg(F.count_distinct("order_date").alias("Days_visited"))
    return with_error(exact, distinct_from(stored, ["customer_id"], "estimate"), ["customer_id"], "Days_visited", "estimate")
