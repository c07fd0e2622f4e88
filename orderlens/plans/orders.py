"""Order-volume pipelines over the cleaned delivery tables (Q15-Q24).

Role columns: customer_orders(order_id, customer_id, pizza_id, exclusions,
extras, order_time) with one row per ordered line and no line key;
runner_orders(order_id, runner_id, pickup_time, distance, duration,
cancellation), NULL cancellation = delivered; pizza_names(pizza_id,
pizza_name).

Where a count is grouped by a dimension attribute the fact is counted per
dimension key first and the dimension joined to the (much smaller)
aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.time import weekday_name
from orderlens.operators.calendar import weekday_list, zero_fill
from orderlens.operators.prefix import global_row_number
from orderlens.operators.ranking import top_one


def delivered() -> F.Column:
    """True for a runner row of a delivered (not cancelled) order."""
    return F.col("cancellation").isNull()


def delivered_orders(runner_orders: DataFrame) -> DataFrame:
    """Runner rows of delivered orders (order_id only)."""
    return runner_orders.filter(delivered()).select("order_id")


def order_lines_total(customer_orders: DataFrame) -> DataFrame:
    """Q15: number of ordered lines."""
    return customer_orders.agg(F.count(F.lit(1)).alias("no_of_pizzas_ordered"))


def order_lines_numbered(customer_orders: DataFrame) -> DataFrame:
    """Every line with its number over the whole table, by order, product and
    lists (the reference numbers lines to tell them apart)."""
    c = customer_orders.select("order_id", "pizza_id", "exclusions", "extras")
    return global_row_number(c, [F.col(k).asc_nulls_first() for k in c.columns], "line_no")


def unique_customers(customer_orders: DataFrame) -> DataFrame:
    """Q16: number of distinct customers (the reference counts customers)."""
    return customer_orders.agg(F.count_distinct("customer_id").alias("no_of_unique_customer_orders"))


def deliveries_by_runner(runner_orders: DataFrame) -> DataFrame:
    """Q17: delivered orders per runner."""
    return runner_orders.filter(delivered()).groupBy("runner_id").agg(
        F.count(F.lit(1)).alias("orders_delivered"))


def delivered_by_product(customer_orders: DataFrame, runner_orders: DataFrame,
                         pizza_names: DataFrame) -> DataFrame:
    """Q18: delivered lines per product (one row per delivered runner row)."""
    lines = customer_orders.select("order_id", "pizza_id").join(delivered_orders(runner_orders), "order_id")
    per_id = lines.groupBy("pizza_id").agg(F.count(F.lit(1)).alias("_n"))
    return per_id.join(pizza_names, "pizza_id").groupBy("pizza_id", "pizza_name").agg(
        F.sum("_n").alias("no_of_pizza_delivered"))


def ordered_by_customer_product(customer_orders: DataFrame, pizza_names: DataFrame) -> DataFrame:
    """Q19: lines per customer and product name, cancelled orders included."""
    per_id = customer_orders.groupBy("customer_id", "pizza_id").agg(F.count(F.lit(1)).alias("_n"))
    return (per_id.join(pizza_names, "pizza_id").groupBy("customer_id", "pizza_name")
            .agg(F.sum("_n").alias("no_of_pizza_ordered")).orderBy("customer_id"))


def max_lines_per_order(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Q20: the largest number of lines in one delivered order (no row if none)."""
    lines = customer_orders.select("order_id").join(delivered_orders(runner_orders), "order_id")
    per_order = lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("maximum_no_of_pizzas_delivered"))
    return top_one(per_order, [F.col("maximum_no_of_pizzas_delivered").desc()]).select(
        "maximum_no_of_pizzas_delivered")


def _change_label() -> F.Column:
    no_change = F.col("exclusions").isNull() & F.col("extras").isNull()
    return F.when(no_change, "no change").otherwise("at least 1 change")


def changed_vs_unchanged(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Q21: delivered lines per customer with / without any modification."""
    lines = customer_orders.join(delivered_orders(runner_orders), "order_id", "left_semi")
    return (lines.groupBy("customer_id", _change_label().alias("changes_made"))
            .agg(F.count(F.lit(1)).alias("no_of_delivered_pizzas")).orderBy("customer_id"))


def both_modifiers(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Q22: delivered lines with both exclusions and extras.

    The reference joins every runner row of the order (inner join) and
    requires the order to be delivered (IN); both are taken from one
    per-order summary so the lines are joined once.
    """
    per_order = runner_orders.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.max(delivered().cast("int")).alias("_ok"))
    lines = customer_orders.filter(F.col("exclusions").isNotNull() & F.col("extras").isNotNull())
    j = lines.select("order_id").join(per_order.filter(F.col("_ok") == 1), "order_id")
    return j.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint")
                 .alias("no_of_delivered_pizzas_with_both_exclusions_and_extras"))


def volume_by_order_time(customer_orders: DataFrame, grain: str = "time") -> DataFrame:
    """Q23: lines per order time, shown as day, month, hour.

    ``grain='time'`` groups by the order time itself, as the reference does
    (several rows may share an hour); ``grain='hour'`` groups by the hour.
    """
    t = F.col("order_time")
    key = t if grain == "time" else F.date_trunc("hour", t)
    g = customer_orders.groupBy(key.alias("_t")).agg(F.count(F.lit(1)).alias("no_of_pizzas_ordered"))
    return g.select(F.dayofmonth("_t").alias("day"), F.month("_t").alias("month"),
                    F.hour("_t").alias("hour"), "no_of_pizzas_ordered")


def volume_by_weekday(spark: SparkSession, customer_orders: DataFrame) -> DataFrame:
    """Q24: lines per weekday name, all seven days listed (zero-filled)."""
    counts = customer_orders.groupBy(weekday_name("order_time").alias("_day")).agg(
        F.count(F.lit(1)).alias("_n"))
    return zero_fill(weekday_list(spark, "name_week"), "name_week", counts, "_day", "_n", "no_of_orders")
