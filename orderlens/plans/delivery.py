"""Runner and delivery-experience pipelines (Q25-Q31).

Order-line facts are reduced to one row per order (or per order and
order time) before they meet the runner table, so the joins work at order
grain instead of line grain.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.agg import exact_avg
from orderlens.functions.time import elapsed_minutes, week_bucket
from orderlens.operators.calendar import key_range, zero_fill
from orderlens.plans.orders import delivered


def signups_by_week(spark: SparkSession, runners: DataFrame, start: dt.date, end: dt.date,
                    days: int = 7) -> DataFrame:
    """Q25: registrations per ``days``-long period from ``start`` to ``end``
    (inclusive, the last period may be shorter), every period listed."""
    n_weeks = math.ceil(((end - start).days + 1) / days)
    counts = runners.groupBy(week_bucket("registration_date", start, end, days).alias("_w")).agg(
        F.count(F.lit(1)).alias("_n"))
    return zero_fill(key_range(spark, "Week", 1, n_weeks), "Week", counts, "_w", "_n",
                     "No_of_registration")


def _delivered_runs(runner_orders: DataFrame, *cols: str) -> DataFrame:
    return runner_orders.filter(delivered()).select("order_id", *cols)


def avg_pickup_minutes(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Q26: mean whole minutes from order to pickup per runner, each
    (order, runner, minutes) counted once."""
    times = customer_orders.select("order_id", "order_time").distinct()
    runs = _delivered_runs(runner_orders, "runner_id", "pickup_time")
    m = times.join(runs, "order_id").select(
        "order_id", "runner_id", elapsed_minutes("order_time", "pickup_time").alias("_m")).distinct()
    return m.groupBy("runner_id").agg(exact_avg("_m").alias("avg_minutes_taken_by_runner"))


def prep_time_by_order(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Q27: lines and minutes to pickup per delivered order.

    The reference shows one (unspecified) line's minutes; this takes the
    smallest, i.e. from the latest order time of the order. Lines are
    summarised per order before the join.
    """
    per_order = customer_orders.groupBy("order_id").agg(
        F.count("pizza_id").alias("_lines"), F.max("order_time").alias("_last"))
    j = per_order.join(_delivered_runs(runner_orders, "pickup_time"), "order_id")
    return j.groupBy("order_id").agg(
        F.sum("_lines").alias("no_of_pizzas"),
        F.min(elapsed_minutes("_last", "pickup_time")).alias("preparation_time"))


def avg_distance_by_customer(customer_orders: DataFrame, runner_orders: DataFrame) -> DataFrame:
    """Q28: mean distance per customer over distinct (order, customer, distance)."""
    oc = customer_orders.select("order_id", "customer_id").distinct()
    d = oc.join(_delivered_runs(runner_orders, "distance"), "order_id").select(
        "order_id", "customer_id", "distance").distinct()
    return d.groupBy("customer_id").agg(exact_avg("distance").alias("avg_distance_travelled"))


def duration_spread(runner_orders: DataFrame) -> DataFrame:
    """Q29: longest minus shortest duration over all runner rows (numeric)."""
    return runner_orders.agg((F.max("duration") - F.min("duration"))
                             .alias("difference_between_longest_and_shortest_duration"))


def speed(distance: str = "distance", duration: str = "duration") -> F.Column:
    """Distance per minute; NULL for a zero or missing duration."""
    return F.try_divide(F.col(distance).cast("double"), F.col(duration).cast("double"))


def speed_by_delivery(runner_orders: DataFrame) -> DataFrame:
    """Q30: distance, duration and speed (distance per minute) per delivery."""
    g = runner_orders.filter(delivered()).groupBy("runner_id", "order_id").agg(
        F.min("distance").alias("distance"), F.min("duration").alias("duration"),
        F.avg(speed()).alias("avg_speed"))
    return g.orderBy("runner_id", "order_id")


def delivery_success_pct(runner_orders: DataFrame) -> DataFrame:
    """Q31: 100 * delivered / all runner rows, per runner (0 kept).

    The reference left-joins two aggregates of the same table; one
    conditional aggregate gives the same numbers from one scan.
    """
    g = runner_orders.groupBy("runner_id").agg(
        F.count(F.lit(1)).alias("_all"), F.count_if(delivered()).alias("_ok"))
    return g.select("runner_id", (F.try_divide(F.col("_ok").cast("double"), F.col("_all").cast("double"))
                                  * 100).alias("successful_delivery_percentage"))
