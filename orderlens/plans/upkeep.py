"""Incremental upkeep of the product reports (Q18, Q32, Q37, Q38 after Q43).

Order lines are reduced to partials (product, kind, token) -> sums, which are
all that these reports need of them. Each batch of lines adds its own partials
to the stored ones; reports merge them by summing and never read earlier lines
again. Batches are folders of one table: a batch that is written again (after a
failure, say) replaces itself. Names, prices and recipes are joined to the
merged partials, so that a new product or recipe is picked up with no rewrite.

A line is weighed by the runner rows of its order at the time of its batch, so
an order's runner rows must be there before its lines are added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from orderlens.plans.composition import line_partials, usage_of
from orderlens.plans.finance import price_of
from orderlens.sources.sinks import conform

PARTIALS_SCHEMA = StructType([
    StructField("pizza_id", LongType()),
    StructField("kind", StringType()),
    StructField("token", StringType()),
    StructField("used", LongType()),
    StructField("delivered", LongType()),
])


def add_batch(path: str, batch: int, customer_orders: DataFrame, runner_orders: DataFrame) -> None:
    """Store the partials of a batch of lines; written again, they replace the
    batch's earlier ones and no others."""
    rows = conform(line_partials(customer_orders, runner_orders), PARTIALS_SCHEMA)
    (rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch").parquet(path))


def merged(spark: SparkSession, path: str) -> DataFrame:
    """All batches' partials as one."""
    schema = StructType([*PARTIALS_SCHEMA.fields, StructField("batch", LongType())])
    return (spark.read.schema(schema).parquet(path).groupBy("pizza_id", "kind", "token")
            .agg(F.sum("used").alias("used"), F.sum("delivered").alias("delivered")))


def _delivered(partials: DataFrame) -> DataFrame:
    return (partials.filter((F.col("kind") == "line") & (F.col("delivered") > 0))
            .groupBy("pizza_id").agg(F.sum("delivered").alias("_n")))


def delivered_by_product(partials: DataFrame, pizza_names: DataFrame) -> DataFrame:
    """Q18 from the stored partials."""
    return (_delivered(partials).join(pizza_names, "pizza_id").groupBy("pizza_id", "pizza_name")
            .agg(F.sum("_n").alias("no_of_pizza_delivered")))


def ingredient_usage(partials: DataFrame, pizza_recipes: DataFrame, pizza_toppings: DataFrame, sort: bool = True) -> DataFrame:
    """Q37 from the stored partials."""
    return usage_of(partials, pizza_recipes, pizza_toppings, sort)


def revenue(partials: DataFrame, pizza_names: DataFrame, prices: dict[str, int]) -> DataFrame:
    """Q38 from the stored partials."""
    priced = pizza_names.filter(F.col("pizza_name").isin(list(prices))).select(
        "pizza_id", price_of(F.col("pizza_name"), prices).alias("_price"))
    return _delivered(partials).join(priced, "pizza_id").agg(
        F.coalesce(F.sum(F.col("_price") * F.col("_n")), F.lit(0)).cast("bigint").alias("money_made_so_far"))


def one_line_each(customer_orders: DataFrame, product: DataFrame, extras: str) -> DataFrame:
    """A further line of ``product`` (one row: pizza_id) in every order."""
    orders = customer_orders.groupBy("order_id").agg(F.min("customer_id").alias("customer_id"), F.min("order_time").alias("order_time"))
    return orders.crossJoin(F.broadcast(product.select("pizza_id"))).select(      # one row
        "order_id", "customer_id", "pizza_id", F.lit(None).cast("string").alias("exclusions"), F.lit(extras).alias("extras"), "order_time")
