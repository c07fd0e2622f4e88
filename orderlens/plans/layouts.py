"""Pipelines over tables that were stored with a layout for them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType, TimestampNTZType

from orderlens.functions.text import NUMBER_TYPE
from orderlens.plans import delivery
from orderlens.sources.sinks import save_table

_NUMBER = DecimalType(*[int(n) for n in NUMBER_TYPE.removeprefix("decimal(").removesuffix(")").split(",")])

LINES_SCHEMA = StructType([
    StructField("order_id", LongType()), StructField("customer_id", LongType()), StructField("pizza_id", LongType()),
    StructField("exclusions", StringType()), StructField("extras", StringType()), StructField("order_time", TimestampNTZType()),
])
RUNS_SCHEMA = StructType([
    StructField("order_id", LongType()), StructField("runner_id", LongType()), StructField("pickup_time", TimestampNTZType()),
    StructField("distance", _NUMBER), StructField("duration", _NUMBER), StructField("cancellation", StringType()),
])


def catalog_name(path: str) -> str:
    """A catalog name for the table in folder ``path``."""
    return os.path.basename(path.rstrip("/")).replace("-", "_")


def by_order(df: DataFrame, schema: StructType, path: str, buckets: int) -> DataFrame:
    """``df`` as a catalog table in buckets by order id: created with the rows
    of even orders, then those of odd ones are added."""
    even = F.pmod(F.col("order_id"), F.lit(2)) == 0
    layout = {"bucket_by": ["order_id"], "buckets": buckets}
    save_table(df.filter(even), catalog_name(path), schema, path, **layout)
    return save_table(df.filter(~even), catalog_name(path), schema, path, mode="append", **layout)


def prep_time_bucketed(spark: SparkSession, customer_orders: DataFrame, runner_orders: DataFrame, path: str) -> DataFrame:
    """Q27 over two tables with the same buckets: neither the lines nor the
    runner rows are shuffled by the query, however often it runs."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return delivery.prep_time_by_order(by_order(customer_orders, LINES_SCHEMA, f"{path}-lines", buckets),
                                       by_order(runner_orders, RUNS_SCHEMA, f"{path}-runs", buckets))
