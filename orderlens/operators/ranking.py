"""Rank operators: rank one with ties, full dense ranks, top-1.

``rank_one`` is ``dense_rank() = 1`` per group in one reading: equal rows are
counted first (map-side), and the rank is taken over the distinct rows with
Spark's group limit, which drops all but the first key's rows of a group before
they are shuffled. A group of a third of all rows, even with one key value,
reaches a task as its distinct tied rows only.

``dense_rank_rows`` is the full dense rank: the distinct keys of a group are
numbered over range partitions, so that a group with a third of all keys is
spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.operators.lists import repeat_rows
from orderlens.operators.prefix import running_total


def rank_one(df: DataFrame, by: Sequence[str], order_by: str, descending: bool = False, times: str = "times") -> DataFrame:
    """Distinct rows whose dense rank of ``order_by`` within ``by`` is 1, and
    how often each stands in ``df``. NULLs sort lowest: first in ascending
    order, last in descending."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(times))
    c = F.col(order_by)
    rank = F.rank().over(Window.partitionBy(*by).orderBy(c.desc() if descending else c.asc()))
    return counted.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def keep_rank_one(df: DataFrame, by: Sequence[str], order_by: str, descending: bool = False) -> DataFrame:
    """Rows whose dense rank of ``order_by`` within ``by`` is 1 (all ties and
    repeated rows kept)."""
    return repeat_rows(rank_one(df, by, order_by, descending, "_times"), "_times")


def dense_rank_keys(keys: DataFrame, by: Sequence[str], order_by: str, descending: bool = False,
                    rank: str = "rank") -> DataFrame:
    """Distinct (by, order_by) with the dense rank of ``order_by`` within ``by``.
    NULLs sort lowest."""
    distinct = keys.select(*by, order_by).distinct()
    c = F.col(order_by)
    before = running_total(distinct, by, [c.desc() if descending else c.asc()], F.lit(1), "_before")
    return before.select(*by, order_by, (F.col("_before") + 1).alias(rank))


def dense_rank_rows(df: DataFrame, by: Sequence[str], order_by: str, descending: bool = False,
                    rank: str = "rank") -> DataFrame:
    """``df`` with the dense rank of ``order_by`` within ``by``."""
    ranks = dense_rank_keys(df, by, order_by, descending, rank)
    ranks = ranks.select(*[F.col(c).alias(f"_by_{c}") for c in (*by, order_by)], rank)
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in (*by, order_by)]
    return df.join(ranks, same).select(*df.columns, rank)


def top_one(df: DataFrame, order_by: Sequence[Column]) -> DataFrame:
    """First row by ``order_by`` (the caller adds a unique tiebreak key)."""
    return df.orderBy(*order_by).limit(1)
