"""Zero-filled counts over a fixed list of keys (weekdays, week numbers)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.time import sunday_first_weekdays


def key_range(spark: SparkSession, name: str, first: int, last: int) -> DataFrame:
    """One int column ``name`` holding first..last (a generated relation)."""
    return spark.range(first, last + 1, numPartitions=1).select(F.col("id").cast("int").alias(name))


def weekday_list(spark: SparkSession, name: str) -> DataFrame:
    """Seven rows: Sunday .. Saturday."""
    return key_range(spark, "_pos", 1, 7).select(sunday_first_weekdays(F.col("_pos")).alias(name))


def zero_fill(keys: DataFrame, key: str, counts: DataFrame, count_key: str | Column,
              count_col: str, out: str) -> DataFrame:
    """Every key with its count, 0 where the key has none. How ``counts`` is
    joined is up to its size at run time.
    """
    ck = F.col(count_key) if isinstance(count_key, str) else count_key
    c = counts.select(ck.alias("_ck"), F.col(count_col).alias("_cnt"))
    return keys.join(c, keys[key] == c["_ck"], "left").select(
        keys[key], F.coalesce(c["_cnt"], F.lit(0)).cast("bigint").alias(out))
