"""Binding of the analytics roles to the driver's TPC-H-style tables.

The pipelines are written against role tables (sales, menu, members,
customer_orders, runner_orders, runners, pizza_names, pizza_recipes,
pizza_toppings, runner_ratings). The driver's data has none of these, so
each role is a deterministic projection of the given tables; the same
projections are written in DuckDB SQL in ``plans/oracle.py``. All of them
are lazy DataFrames, so filters and column pruning from a pipeline reach
the parquet scans.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.sources.tables import read_table

# Fixed values of this binding (they replace the reference's literals).
PROMO_ITEM = "PROMO"                       # the item with a 2x points multiplier
PRICED_PRODUCTS = {"red plate": 12, "small widget": 10}   # fixed price per named product
SIGNUP_PERIOD_START = dt.date(2024, 1, 1)  # first day of week 1
SIGNUP_PERIOD_END = dt.date(2024, 1, 31)   # last day of the last (short) week
MEMBER_SEGMENT = "BUILDING"
MEMBER_EPOCH = dt.date(1998, 1, 1)
RUNNER_COUNT = 50


def _s(c: Column) -> Column:
    return c.cast("string")


class RoleTables:
    """Role DataFrames over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _t(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # -- loyalty roles ---------------------------------------------------
    @cached_property
    def menu(self) -> DataFrame:
        return self._t("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_name"),
            F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
        )

    @cached_property
    def sales(self) -> DataFrame:
        o = self._t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        li = self._t("lineitem").select("l_orderkey", "l_partkey")
        return o.join(li, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("l_partkey").alias("product_id"),
        )

    @cached_property
    def members(self) -> DataFrame:
        c = self._t("customer").filter(F.col("c_mktsegment") == MEMBER_SEGMENT)
        return c.select(
            F.col("c_custkey").alias("customer_id"),
            F.date_add(F.lit(MEMBER_EPOCH), (F.col("c_custkey") % 365).cast("int")).alias("join_date"),
        )

    # -- delivery roles --------------------------------------------------
    @cached_property
    def runners(self) -> DataFrame:
        ev = self._t("events").filter(F.col("event_type") == "signup")
        return ev.groupBy(F.col("user_id").alias("runner_id")).agg(
            F.min("ts").cast("date").alias("registration_date"))

    @cached_property
    def pizza_names(self) -> DataFrame:
        return self._t("part").select(F.col("p_partkey").alias("pizza_id"),
                                      F.col("p_name").alias("pizza_name"))

    @cached_property
    def pizza_toppings(self) -> DataFrame:
        return self._t("supplier").select(F.col("s_suppkey").alias("topping_id"),
                                          F.col("s_name").alias("topping_name"))

    @cached_property
    def pizza_recipes(self) -> DataFrame:
        li = self._t("lineitem").select("l_partkey", "l_suppkey")
        return li.groupBy(F.col("l_partkey").alias("pizza_id")).agg(
            F.array_join(F.transform(F.array_sort(F.collect_set("l_suppkey")), _s), ", ")
            .alias("toppings"))

    @cached_property
    def customer_orders_raw(self) -> DataFrame:
        return customer_orders_from(self._t("lineitem"), self._t("orders"))

    @cached_property
    def runner_orders_raw(self) -> DataFrame:
        return runner_orders_from(self._t("orders"))

    # -- cleaned delivery facts (K1-K9) ----------------------------------
    @cached_property
    def customer_orders(self) -> DataFrame:
        from orderlens.operators.cleaning import clean_customer_orders
        return of_orders(clean_customer_orders(order_lines_from(self._t("lineitem"))), self._t("orders"))

    @cached_property
    def runner_orders(self) -> DataFrame:
        from orderlens.operators.cleaning import clean_runner_orders
        return clean_runner_orders(self.runner_orders_raw)

    @cached_property
    def runner_ratings(self) -> DataFrame:
        """Ratings for every delivered order, derived by the ratings pipeline."""
        from orderlens.plans.finance import ratings_table
        o = self._t("orders").select(F.col("o_orderkey").alias("order_id"),
                                     F.col("o_custkey").alias("customer_id"))
        return ratings_table(self.runner_orders, o)


def order_lines_from(lineitem: DataFrame) -> DataFrame:
    """Raw (uncleaned) lines without what their order says. The lists are
    written here, before the join of the orders: fewer columns are shuffled."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    sk = F.col("l_suppkey")
    ln = F.col("l_linenumber")
    exclusions = (F.when(ln == 1, F.lit(""))
                  .when(ln == 2, F.lit("null"))
                  .when(ln == 3, F.lit(None).cast("string"))
                  .when(ln == 4, _s(sk))
                  .when(ln == 5, F.concat(_s(sk), F.lit(", "), _s((sk + 1) % 10)))
                  .otherwise(F.lit("")))
    rf = F.col("l_returnflag")
    extras = (F.when(rf == "R", F.concat(_s((sk + 3) % 10), F.lit(", "), _s(sk)))
              .when(rf == "A", F.lit("null"))
              .otherwise(F.lit("")))
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("pizza_id"),
                     exclusions.alias("exclusions"), extras.alias("extras"))


def of_orders(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines with the customer and the time of their order."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    order_time = F.timestamp_add("MINUTE", (F.col("order_id") % 1440).cast("int"), F.col("o_orderdate"))
    return lines.join(o, F.col("order_id") == F.col("o_orderkey")).select(
        "order_id", F.col("o_custkey").alias("customer_id"), "pizza_id", "exclusions", "extras",
        order_time.alias("order_time"))


def customer_orders_from(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Raw (uncleaned) order lines from lineitem x orders."""
    return of_orders(order_lines_from(lineitem), orders)


def runner_orders_from(orders: DataFrame) -> DataFrame:
    """Raw (uncleaned) runner rows, one per order: dirty text columns with
    unit suffixes and 'null' / '' sentinels."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("o_orderkey")
    m9 = k % 9
    pickup = F.when(m9 == 0, F.lit("null")).otherwise(
        _s(F.timestamp_add("MINUTE", (10 + k % 1500).cast("int"), F.col("o_orderdate"))))
    dist_n = _s(5 + k % 40)
    distance = (F.when(m9 == 0, F.lit("null"))
                .when(m9 == 1, F.concat(dist_n, F.lit("km")))
                .when(m9 == 2, F.concat(dist_n, F.lit(".4 km")))
                .when(m9 == 3, F.concat(dist_n, F.lit(".25km")))
                .otherwise(dist_n))
    dur_n = _s(8 + k % 30)
    duration = (F.when(m9 == 0, F.lit("null"))
                .when(m9 == 1, F.concat(dur_n, F.lit(" minutes")))
                .when(m9 == 2, F.concat(dur_n, F.lit("mins")))
                .otherwise(dur_n))
    cancellation = (F.when(m9 == 0, F.lit("Customer Cancellation"))
                    .when(m9 == 1, F.lit(""))
                    .when(m9 == 2, F.lit("null"))
                    .when(m9 == 3, F.lit(None).cast("string"))
                    .otherwise(F.lit("")))
    return o.select(
        k.alias("order_id"),
        (F.col("o_custkey") % RUNNER_COUNT).alias("runner_id"),
        pickup.alias("pickup_time"),
        distance.alias("distance"),
        duration.alias("duration"),
        cancellation.alias("cancellation"),
    )
