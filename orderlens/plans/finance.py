"""Pricing, ratings and menu-evolution pipelines (Q38-Q43)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from orderlens.functions.text import list_length
from orderlens.functions.time import elapsed_minutes
from orderlens.plans.composition import recipe_ingredients
from orderlens.plans.delivery import speed
from orderlens.plans.orders import delivered
from orderlens.sources.sinks import conform, read_written, write_table

# Declared schema of the ratings table. Ids are 64-bit here (the test data's
# keys are bigint); the rating is an integer 1..5.
RATINGS_SCHEMA = StructType([
    StructField("order_id", LongType()),
    StructField("customer_id", LongType()),
    StructField("runner_id", LongType()),
    StructField("rating", IntegerType()),
])

# Fixed value: runner pay per unit of distance.
RUNNER_PAY_PER_DISTANCE = Decimal("0.3")


def price_of(name: Column, prices: dict[str, int]) -> Column:
    expr = None
    for product, price in prices.items():
        expr = (F.when(name == product, F.lit(price)) if expr is None
                else expr.when(name == product, F.lit(price)))
    return expr.otherwise(F.lit(0))


def _revenue(customer_orders: DataFrame, pizza_names: DataFrame, runner_orders: DataFrame,
             prices: dict[str, int]) -> DataFrame:
    """Revenue of delivered lines (a line counts once per delivered runner row
    of its order, as an inner join would).

    Only lines of priced products go on to the orders: prices are summed per
    product id, which few lines have, and delivered rows counted per order.
    """
    priced = (pizza_names.filter(F.col("pizza_name").isin(list(prices)))
              .groupBy("pizza_id").agg(F.sum(price_of(F.col("pizza_name"), prices)).alias("_price")))
    runs = runner_orders.filter(delivered()).groupBy("order_id").agg(F.count(F.lit(1)).alias("_runs"))
    lines = customer_orders.select("order_id", "pizza_id").join(priced, "pizza_id").join(runs, "order_id")
    return lines.agg(F.coalesce(F.sum(F.col("_price") * F.col("_runs")), F.lit(0)).cast("bigint").alias("_revenue"))


def revenue(customer_orders: DataFrame, pizza_names: DataFrame, runner_orders: DataFrame,
            prices: dict[str, int]) -> DataFrame:
    """Q38: fixed price per named product over delivered lines; other
    products add nothing."""
    return _revenue(customer_orders, pizza_names, runner_orders, prices).select(
        F.col("_revenue").alias("money_made_so_far"))


def revenue_with_extras(customer_orders: DataFrame, pizza_names: DataFrame, runner_orders: DataFrame,
                        prices: dict[str, int], extra_charge: int = 1) -> DataFrame:
    """Q39: Q38 plus ``extra_charge`` per listed extra over all lines
    (cancelled included); NULL when no line has extras. The extras are
    summed map-side, beside the join for the revenue."""
    extras = customer_orders.agg(F.sum(list_length("extras")).cast("bigint").alias("_extras"))
    return (_revenue(customer_orders, pizza_names, runner_orders, prices).crossJoin(F.broadcast(extras))   # a row each
            .select((F.col("_revenue") + F.col("_extras") * extra_charge).alias("money_made_so_far")))


def ratings_table(runner_orders: DataFrame, order_customers: DataFrame,
                  rating: Column | None = None) -> DataFrame:
    """Q40: a ratings row (order, customer, runner, rating 1..5) for every
    delivered runner row, conformed to RATINGS_SCHEMA. Repeated rows of
    ``order_customers`` count once.

    ``rating`` defaults to a deterministic stand-in (1 + order_id mod 5);
    write it with ``sources.sinks.write_table(df, path, RATINGS_SCHEMA)``.
    """
    rating = rating if rating is not None else (F.pmod(F.col("order_id"), F.lit(5)) + 1)
    runs = runner_orders.filter(delivered()).select("order_id", "runner_id")
    rows = runs.join(order_customers.select("order_id", "customer_id").distinct(), "order_id")
    return rated(rows.withColumn("rating", rating))


def rated(rows: DataFrame) -> DataFrame:
    """Given rating rows, conformed to RATINGS_SCHEMA. A rating outside 1..5
    fails the job (NULL, not rated, passes)."""
    r = F.col("rating")
    message = F.concat(F.lit("rating outside 1..5: "), r.cast("string"))
    return conform(rows.withColumn("rating", F.when(r.isNull() | r.between(1, 5), r).otherwise(
        F.raise_error(message).cast("int"))), RATINGS_SCHEMA)


def ratings_written(spark: SparkSession, ratings: DataFrame, path: str) -> DataFrame:
    """Q40 as a table: create it with the ratings of even orders, add those of
    the odd ones, and read it back."""
    even = F.pmod(F.col("order_id"), F.lit(2)) == 0
    write_table(ratings.filter(even), path, RATINGS_SCHEMA)
    write_table(ratings.filter(~even), path, RATINGS_SCHEMA, mode="append")
    return read_written(spark, path, RATINGS_SCHEMA)


def delivery_report(customer_orders: DataFrame, runner_ratings: DataFrame,
                    runner_orders: DataFrame, sort: bool = True) -> DataFrame:
    """Q41: one row per rated (customer, order, runner) with times, minutes to
    pickup, duration, speed and number of lines.

    Lines are summarised per order (count, earliest and latest order time)
    before joining, which gives the same values as joining the lines: the
    minimum minutes-to-pickup comes from the latest order time. Columns the
    reference leaves ungrouped take their minimum.
    """
    per_order = customer_orders.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_lines"), F.min("order_time").alias("_first"),
        F.max("order_time").alias("_last"))
    rr = runner_ratings.select("order_id", "customer_id", "runner_id", "rating")
    ro = runner_orders.select("order_id", "pickup_time", "distance", "duration")
    j = per_order.join(rr, "order_id").join(ro, "order_id")
    out = j.groupBy("customer_id", "order_id", "runner_id").agg(
        F.min("rating").alias("rating"),
        F.min("_first").alias("order_time"),
        F.min("pickup_time").alias("pickup_time"),
        F.min(elapsed_minutes("_last", "pickup_time")).alias("Time_between_order_and_pickup"),
        F.min("duration").alias("Delivery_duration"),
        F.min(speed()).alias("Average_speed"),
        F.sum("_lines").alias("Total_number_of_pizzas"),
    )
    return out.orderBy("customer_id", "order_id") if sort else out


def net_revenue(customer_orders: DataFrame, pizza_names: DataFrame, runner_orders: DataFrame,
                prices: dict[str, int], pay_per_distance: Decimal = RUNNER_PAY_PER_DISTANCE) -> DataFrame:
    """Q42: Q38 minus runner pay (``pay_per_distance`` x total delivered distance)."""
    pay = runner_orders.filter(delivered()).agg(
        (F.sum("distance").cast("decimal(30,6)") * F.lit(pay_per_distance)).alias("_pay"))
    return _revenue(customer_orders, pizza_names, runner_orders, prices).crossJoin(F.broadcast(pay)).select(
        (F.col("_revenue") - F.col("_pay")).cast("decimal(38,7)").alias("money_made_so_far"))


def add_product(pizza_names: DataFrame, pizza_recipes: DataFrame, name: str,
                toppings: str) -> tuple[DataFrame, DataFrame]:
    """Q43: append a product (next free id) and its recipe to the two
    dimensions. The id is computed by Spark (max + 1), not on the driver."""
    next_id = pizza_names.agg((F.coalesce(F.max("pizza_id"), F.lit(0)) + 1).alias("pizza_id"))
    new_name = next_id.select(F.col("pizza_id").cast(pizza_names.schema["pizza_id"].dataType),
                              F.lit(name).alias("pizza_name"))
    new_recipe = next_id.select(F.col("pizza_id").cast(pizza_recipes.schema["pizza_id"].dataType),
                                F.lit(toppings).alias("toppings"))
    return (pizza_names.unionByName(new_name), pizza_recipes.unionByName(new_recipe))


def menu_after_new_product(pizza_names: DataFrame, pizza_recipes: DataFrame, pizza_toppings: DataFrame,
                           name: str, toppings: str) -> DataFrame:
    """Q43 check: Q32's ingredient rows over the extended dimensions, with the
    product name, so the new product shows up like every other."""
    names, recipes = add_product(pizza_names, pizza_recipes, name, toppings)
    return recipe_ingredients(recipes, pizza_toppings, sort=False).join(names, "pizza_id").select(
        "pizza_id", "pizza_name", "topping_id", "topping_name")
