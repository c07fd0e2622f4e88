"""The query registry: one callable (spark, sf_dir) -> DataFrame per question.

Every callable binds the roles to the driver's tables (``RoleTables``),
runs the pipeline over the whole tables and presents the result with
engine-neutral types (``present``) so that it can be compared value by
value with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from orderlens.plans import composition, delivery, finance, layouts, loyalty, orders, sketches, upkeep
from orderlens.session import scratch_path
from orderlens.sources import roles as R
from orderlens.sources.roles import RoleTables
from orderlens.sources.sinks import read_written, write_table

# The product added by the menu-evolution question.
NEW_PRODUCT_NAME = "Supreme"
NEW_PRODUCT_TOPPINGS = "1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12"
NEW_PRODUCT_PRICE = 9
NEW_PRODUCT_EXTRAS = "1"
# Characters of a text chunk; small, so that the test tables have several.
CHUNK = 256


def present(df: DataFrame) -> DataFrame:
    """Decimals -> exact text, dates -> 'yyyy-MM-dd', timestamps ->
    'yyyy-MM-dd HH:mm:ss[.ffffff]' (wall clock for timestamp_ntz, session
    zone for timestamp), no trailing zeros of a second; other types
    unchanged. Row order is kept."""
    exact = (DecimalType, DateType, TimestampNTZType, TimestampType)
    return df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, exact)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def _q(build: Callable[[SparkSession, RoleTables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(build(spark, RoleTables(spark, sf_dir)))
    run.__doc__ = build.__doc__
    return run


def _written(s: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(s, name)
    write_table(df, path, df.schema)
    return read_written(s, path, df.schema)


def _customers_by_month(s: SparkSession, t: RoleTables) -> DataFrame:
    daily = _written(s, sketches.sketched(t.sales, ["order_date"], F.col("customer_id")), "daily")
    found = sketches.customers_by_month(t.sales, daily)
    return found.select("year", "month", "customers", (F.col("relative_error") <= sketches.ERROR_BOUND).alias("within_bound"))


def _visit_days(s: SparkSession, t: RoleTables) -> DataFrame:
    keys = ["customer_id", F.trunc("order_date", "month").alias("month")]
    monthly = _written(s, sketches.sketched(t.sales, keys, F.unix_date("order_date")), "monthly")
    found = sketches.visit_days(t.sales, monthly)
    return found.select("customer_id", "Days_visited", (F.col("relative_error") <= sketches.ERROR_BOUND).alias("within_bound"))


def _extended(s: SparkSession, t: RoleTables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored partials of all lines and, as a second batch, of a line of the
    new product in every order; names and recipes with the new product."""
    names, recipes = finance.add_product(t.pizza_names, t.pizza_recipes, NEW_PRODUCT_NAME, NEW_PRODUCT_TOPPINGS)
    path = scratch_path(s, "partials")
    product = t.pizza_names.agg((F.coalesce(F.max("pizza_id"), F.lit(0)) + 1).alias("pizza_id"))
    upkeep.add_batch(path, 1, t.customer_orders, t.runner_orders)
    upkeep.add_batch(path, 2, upkeep.one_line_each(t.customer_orders, product, NEW_PRODUCT_EXTRAS), t.runner_orders)
    return upkeep.merged(s, path), names, recipes


def _delivered_extended(s: SparkSession, t: RoleTables) -> DataFrame:
    partials, names, _ = _extended(s, t)
    return upkeep.delivered_by_product(partials, names)


def _usage_extended(s: SparkSession, t: RoleTables) -> DataFrame:
    partials, _, recipes = _extended(s, t)
    return upkeep.ingredient_usage(partials, recipes, t.pizza_toppings)


def _revenue_extended(s: SparkSession, t: RoleTables) -> DataFrame:
    partials, names, _ = _extended(s, t)
    return upkeep.revenue(partials, names, {**R.PRICED_PRODUCTS, NEW_PRODUCT_NAME: NEW_PRODUCT_PRICE})


def _promo_by_month(s: SparkSession, t: RoleTables) -> DataFrame:
    path = scratch_path(s, "sales_by_month")
    sales = loyalty.sales_by_month(t.sales, layouts.catalog_name(path), path)
    return loyalty.points_promo_window(sales, t.menu, t.members, R.PROMO_ITEM)


_BUILDERS: dict[str, Callable[[SparkSession, RoleTables], DataFrame]] = {
    # loyalty (Q1-Q14)
    "spend_by_customer": lambda s, t: loyalty.spend_by_customer(t.sales, t.menu),
    "visit_days": lambda s, t: loyalty.visit_days(t.sales),
    "first_items": lambda s, t: loyalty.first_items(t.sales, t.menu),
    "top_item": lambda s, t: loyalty.top_item(t.sales, t.menu),
    "favourite_items": lambda s, t: loyalty.favourite_items(t.sales, t.menu),
    "first_after_join": lambda s, t: loyalty.first_after_join(t.sales, t.menu, t.members),
    "last_before_join_counts": lambda s, t: loyalty.last_before_join_counts(t.sales, t.menu, t.members),
    "last_before_join": lambda s, t: loyalty.last_before_join(t.sales, t.menu, t.members),
    "totals_before_join": lambda s, t: loyalty.totals_before_join(t.sales, t.menu, t.members),
    "points_basic": lambda s, t: loyalty.points_basic(t.sales, t.menu, R.PROMO_ITEM),
    "points_promo_window": lambda s, t: loyalty.points_promo_window(t.sales, t.menu, t.members, R.PROMO_ITEM),
    "join_all": lambda s, t: loyalty.join_all(t.sales, t.menu, t.members),
    "rank_all": lambda s, t: loyalty.rank_all(t.sales, t.menu, t.members),
    "visit_calendar": lambda s, t: loyalty.visit_calendar(t.sales),
    "tried_before_join_counts": lambda s, t: loyalty.tried_before_join_counts(t.sales, t.menu, t.members),
    "tried_before_join": lambda s, t: loyalty.tried_before_join(t.sales, t.menu, t.members),
    # cleaning (K1-K9)
    "clean_runner_orders": lambda s, t: t.runner_orders,
    "clean_customer_orders": lambda s, t: t.customer_orders,
    # order metrics (Q15-Q24)
    "order_lines_total": lambda s, t: orders.order_lines_total(t.customer_orders),
    "unique_customers": lambda s, t: orders.unique_customers(t.customer_orders),
    "deliveries_by_runner": lambda s, t: orders.deliveries_by_runner(t.runner_orders),
    "delivered_by_product": lambda s, t: orders.delivered_by_product(t.customer_orders, t.runner_orders,
                                                                     t.pizza_names),
    "ordered_by_customer_product": lambda s, t: orders.ordered_by_customer_product(t.customer_orders,
                                                                                   t.pizza_names),
    "max_lines_per_order": lambda s, t: orders.max_lines_per_order(t.customer_orders, t.runner_orders),
    "changed_vs_unchanged": lambda s, t: orders.changed_vs_unchanged(t.customer_orders, t.runner_orders),
    "both_modifiers": lambda s, t: orders.both_modifiers(t.customer_orders, t.runner_orders),
    "volume_by_order_time": lambda s, t: orders.volume_by_order_time(t.customer_orders),
    "volume_by_weekday": lambda s, t: orders.volume_by_weekday(s, t.customer_orders),
    # delivery experience (Q25-Q31)
    "signups_by_week": lambda s, t: delivery.signups_by_week(s, t.runners, R.SIGNUP_PERIOD_START,
                                                             R.SIGNUP_PERIOD_END),
    "avg_pickup_minutes": lambda s, t: delivery.avg_pickup_minutes(t.customer_orders, t.runner_orders),
    "prep_time_by_order": lambda s, t: delivery.prep_time_by_order(t.customer_orders, t.runner_orders),
    "avg_distance_by_customer": lambda s, t: delivery.avg_distance_by_customer(t.customer_orders,
                                                                               t.runner_orders),
    "duration_spread": lambda s, t: delivery.duration_spread(t.runner_orders),
    "speed_by_delivery": lambda s, t: delivery.speed_by_delivery(t.runner_orders),
    "delivery_success_pct": lambda s, t: delivery.delivery_success_pct(t.runner_orders),
    # lists and composition (Q32-Q37)
    "recipe_ingredients": lambda s, t: composition.recipe_ingredients(t.pizza_recipes, t.pizza_toppings),
    "most_common_extra": lambda s, t: composition.most_common_extra(t.customer_orders, t.pizza_toppings),
    "most_common_exclusion": lambda s, t: composition.most_common_exclusion(t.customer_orders,
                                                                            t.pizza_toppings),
    "order_item_text": lambda s, t: composition.order_item_text(t.customer_orders, t.pizza_names,
                                                                t.pizza_toppings),
    "ingredient_list_text": lambda s, t: composition.ingredient_list_text(
        t.customer_orders, t.pizza_recipes, t.pizza_names, t.pizza_toppings),
    "ingredient_usage": lambda s, t: composition.ingredient_usage(
        t.customer_orders, t.pizza_recipes, t.runner_orders, t.pizza_toppings),
    # pricing, ratings, evolution (Q38-Q43)
    "revenue": lambda s, t: finance.revenue(t.customer_orders, t.pizza_names, t.runner_orders,
                                            R.PRICED_PRODUCTS),
    "revenue_with_extras": lambda s, t: finance.revenue_with_extras(t.customer_orders, t.pizza_names,
                                                                    t.runner_orders, R.PRICED_PRODUCTS),
    "ratings_table": lambda s, t: t.runner_ratings,
    "ratings_written": lambda s, t: finance.ratings_written(s, t.runner_ratings, scratch_path(s, "ratings")),
    "delivery_report": lambda s, t: finance.delivery_report(t.customer_orders, t.runner_ratings,
                                                            t.runner_orders),
    "net_revenue": lambda s, t: finance.net_revenue(t.customer_orders, t.pizza_names, t.runner_orders,
                                                    R.PRICED_PRODUCTS),
    "add_product": lambda s, t: finance.menu_after_new_product(
        t.pizza_names, t.pizza_recipes, t.pizza_toppings, NEW_PRODUCT_NAME, NEW_PRODUCT_TOPPINGS),
    # the reports with the new product, from stored partials (Q43 in Q18, Q37, Q38)
    "delivered_by_product_extended": _delivered_extended,
    "ingredient_usage_extended": _usage_extended,
    "revenue_extended": _revenue_extended,
    # further forms: numbers, ranks, chunks, layouts, sketches
    "order_lines_numbered": lambda s, t: orders.order_lines_numbered(t.customer_orders),
    "item_ranks": lambda s, t: loyalty.item_ranks(t.sales, t.menu),
    "last_before_join_chunks": lambda s, t: loyalty.last_before_join_chunks(t.sales, t.menu, t.members, CHUNK),
    "tried_before_join_chunks": lambda s, t: loyalty.tried_before_join_chunks(t.sales, t.menu, t.members, CHUNK),
    "points_promo_by_month": _promo_by_month,
    "prep_time_bucketed": lambda s, t: layouts.prep_time_bucketed(s, t.customer_orders, t.runner_orders,
                                                                  scratch_path(s, "bucketed")),
    "customers_by_month_sketched": _customers_by_month,
    "visit_days_sketched": _visit_days,
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _q(v) for k, v in _BUILDERS.items()}
