"""Loyalty / spend pipelines over sales, menu and members (Q1-Q14).

Role columns: sales(customer_id, order_date, product_id),
menu(product_id, product_name, price), members(customer_id, join_date).

Text aggregates are sorted by value (the reference leaves their order
open). Per-customer lists are built from per-(customer, item) counts, so a
customer with a huge share of the rows is combined map-side and the array
gathered per customer is bounded by the number of distinct items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StructField, StructType

from orderlens.functions.agg import collect_counted, concat_distinct, expand_counted
from orderlens.functions.time import weekday_name
from orderlens.operators.chunks import CHUNK_CHARS, text_chunks
from orderlens.operators.ranking import dense_rank_keys, dense_rank_rows, keep_rank_one, rank_one, top_one
from orderlens.sources.sinks import save_table

C, D, P, N, PRICE, J = "customer_id", "order_date", "product_id", "product_name", "price", "join_date"
MONTH = "order_month"

# Declared layout of sales stored by the month of their date.
SALES_SCHEMA = StructType([StructField(C, LongType()), StructField(D, DateType()), StructField(P, LongType()),
                           StructField(MONTH, IntegerType())])


def _named(sales: DataFrame, menu: DataFrame) -> DataFrame:
    return sales.join(menu, P)


def _member_sales(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    return members.join(sales, C).join(menu, P)


def spend_by_customer(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Q1: total price of everything each customer bought."""
    return _named(sales, menu).groupBy(C).agg(F.sum(PRICE).alias("Amount_spent"))


def visit_days(sales: DataFrame) -> DataFrame:
    """Q2: number of distinct order dates per customer."""
    return sales.groupBy(C).agg(F.count_distinct(D).alias("Days_visited"))


def first_items(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Q3: distinct names of everything bought on each customer's first date."""
    firsts = rank_one(_named(sales, menu).select(C, D, N), [C], D)
    return firsts.groupBy(C).agg(concat_distinct(N).alias("first_item"))


def top_item(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Q4: the most bought product (ties -> lowest product_id)."""
    counts = _named(sales, menu).groupBy(P, N).agg(F.count(P).alias("times_purchased"))
    return top_one(counts, [F.col("times_purchased").desc(), F.col(P).asc_nulls_last()])


def favourite_items(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Q5: per customer, every item tied at the highest purchase count."""
    counts = _named(sales, menu).groupBy(C, N).agg(F.count(N).alias("count_item"))
    best = rank_one(counts, [C], "count_item", descending=True)
    return best.groupBy(C).agg(concat_distinct(N).alias("most_popular_item"))


def first_after_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Q6: items bought on the first date strictly after joining, one row per sale."""
    j = _member_sales(sales, menu, members).filter(F.col(D) > F.col(J)).select(C, D, N)
    return keep_rank_one(j, [C], D).select(C, F.col(N).alias("first_item_purchased"))


def last_before_join_counts(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Q7 as rows: items bought on the last date strictly before joining, and
    how often."""
    j = _member_sales(sales, menu, members).filter(F.col(D) < F.col(J)).select(C, D, N)
    # The tied rows are of one date, so they are distinct in (customer, name).
    return rank_one(j, [C], D, descending=True).select(C, N, "times")


def last_before_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Q7: ``last_before_join_counts`` as one text per customer with repeats
    (one cell holds them all)."""
    counted = last_before_join_counts(sales, menu, members)
    return counted.groupBy(C).agg(expand_counted(collect_counted(N, "times")).alias("first_item_purchased"))


def last_before_join_chunks(sales: DataFrame, menu: DataFrame, members: DataFrame, size: int = CHUNK_CHARS) -> DataFrame:
    """Q7's text in numbered chunks of ``size`` characters, for lists of any length."""
    return text_chunks(last_before_join_counts(sales, menu, members), [C], N, "times", size=size)


def totals_before_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Q8: distinct items and amount spent before joining."""
    j = _member_sales(sales, menu, members).filter(F.col(D) < F.col(J))
    return j.groupBy(C).agg(F.count_distinct(N).alias("items"), F.sum(PRICE).alias("amount_spent"))


def points_basic(sales: DataFrame, menu: DataFrame, promo_item: str,
                 points_per_unit: int = 10, promo_multiplier: int = 2) -> DataFrame:
    """Q9: points per customer; ``promo_item`` earns ``promo_multiplier``x.

    The reference adds two per-customer sums (promo item / every other item)
    with a full outer join. A row with a NULL name belongs to neither sum, so
    this is one conditional sum over rows with a name, in one aggregation.
    """
    rate = F.when(F.col(N) == promo_item, points_per_unit * promo_multiplier).otherwise(points_per_unit)
    j = _named(sales, menu).filter(F.col(N).isNotNull())
    return j.groupBy(C).agg(F.coalesce(F.sum(F.col(PRICE) * rate), F.lit(0)).alias("points"))


def points_promo_window(sales: DataFrame, menu: DataFrame, members: DataFrame, promo_item: str,
                        month: int = 1, window_days: int = 7, points_per_unit: int = 10,
                        promo_multiplier: int = 2) -> DataFrame:
    """Q10: members' points in ``month`` (of any year) with every item doubled
    from the join date through join date + window_days - 1 (both inclusive).
    Rows no branch covers (NULL name outside the window, NULL join date)
    add nothing."""
    d, jd, name, price = F.col(D), F.col(J), F.col(N), F.col(PRICE)
    promo_rate = points_per_unit * promo_multiplier
    # The item's usual rate; NULL for a NULL name (neither promo nor other).
    rate = F.when(name == promo_item, promo_rate).when(name != promo_item, points_per_unit)
    end = F.date_add(jd, window_days - 1)
    pts = (F.when(d < jd, price * rate)
           .when(d.between(jd, end), price * promo_rate)
           .when(d > end, price * rate))
    # Sales stored by month (``sales_by_month``) are read for that month only.
    in_month = F.col(MONTH) == month if MONTH in sales.columns else F.month(d) == month
    j = _member_sales(sales.filter(in_month), menu, members)
    return j.groupBy(C).agg(F.sum(pts).alias("points")).orderBy(C)


def join_all(sales: DataFrame, menu: DataFrame, members: DataFrame, sort: bool = True) -> DataFrame:
    """Q11: every sale with a Y/N flag for membership at the time of sale.

    Sales of members are flagged by date (NULL join date -> NULL flag);
    sales of customers NOT IN members are 'N' under SQL NOT IN rules (a
    NULL member key removes them all; a NULL sales key is removed unless
    there are no members). The reference's two branches (member join, NOT
    IN) are one left join here, so the sales are read once; the NOT IN
    rules come from a one-row summary of members (see ``not_in``).
    """
    named = _named(sales, menu).select(C, D, N, PRICE)
    mem = members.select(F.col(C).alias("_mc"), F.col(J), F.lit(True).alias("_matched"))
    summary = members.agg(F.count(F.lit(1)).alias("_n_members"),
                          F.count_if(F.col(C).isNull()).alias("_n_null"))
    j = named.join(mem, named[C] == mem["_mc"], "left").crossJoin(F.broadcast(summary))
    matched = F.col("_matched").isNotNull()
    not_in_members = (F.col("_n_members") == 0) | ((F.col("_n_null") == 0) & F.col(C).isNotNull())
    flag = (F.when(~matched, F.lit("N"))
            .when(F.col(D) >= F.col(J), "Y").when(F.col(D) < F.col(J), "N"))
    out = j.filter(matched | not_in_members).select(C, D, N, PRICE, flag.alias("member"))
    return out.orderBy(C, D, N, PRICE) if sort else out


def rank_all(sales: DataFrame, menu: DataFrame, members: DataFrame, sort: bool = True) -> DataFrame:
    """Q12: Q11 plus the dense rank of the order date among a customer's member
    ('Y') rows; text 'null' for the other rows (so the column is text).

    The ranks are computed over the distinct (customer, date) keys of members'
    sales from their join date on (a customer's rows collapse to its dates
    before they are numbered) and joined back on (customer, date); a customer's
    dates are numbered over range partitions. The rules for customers that are no members
    play no part in them.
    """
    # Rows whose flag is NULL (member with a NULL join date) are in neither
    # the 'Y' nor the 'N' part, so they are left out.
    rows = join_all(sales, menu, members, sort=False).filter(F.col("member").isNotNull())
    keys = (sales.join(members, C).filter(F.col(D) >= F.col(J)).join(menu.select(P), P, "left_semi")
            .select(C, D).distinct())
    ranks = dense_rank_keys(keys, [C], D, rank="_rank")
    out = rows.join(ranks, [C, D], "left").select(
        C, D, N, PRICE, "member",
        F.when(F.col("member") == "Y", F.col("_rank").cast("string")).otherwise(F.lit("null")).alias("ranking"))
    return out.orderBy(C, D, N, PRICE) if sort else out


def item_ranks(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Every item of a customer with its dense rank by number bought (most
    first) and by the date it was first bought. A customer's counts and dates
    are numbered over range partitions."""
    counts = _named(sales, menu).groupBy(C, N).agg(F.count(F.lit(1)).alias("times"), F.min(D).alias("first_date"))
    return dense_rank_rows(dense_rank_rows(counts, [C], "times", descending=True, rank="rank_by_times"),
                           [C], "first_date", rank="rank_by_date")


def sales_by_month(sales: DataFrame, name: str, path: str) -> DataFrame:
    """Sales as a catalog table with a folder per month of the order date."""
    return save_table(sales.withColumn(MONTH, F.month(D)), name, SALES_SCHEMA, path, partition_by=[MONTH])


def visit_calendar(sales: DataFrame) -> DataFrame:
    """Q13: each (date, customer) visit with its weekday name."""
    return (sales.select(D, C).distinct()
            .select(D, C, weekday_name(D).alias("day")).orderBy(C))


def tried_before_join_counts(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Q14 as rows: per customer each item bought before joining (kind 'item')
    and each date of a visit (kind 'day'), with their counts."""
    j = sales.join(members, C).join(menu, P).filter(F.col(D) < F.col(J))
    facts = j.select(C, F.explode(F.array(
        F.struct(F.lit("item").alias("_kind"), F.col(N).alias("_value")),
        F.struct(F.lit("day").alias("_kind"), F.col(D).cast("string").alias("_value")))).alias("_f"))
    return facts.groupBy(C, F.col("_f._kind").alias("kind"), F.col("_f._value").alias("value")).agg(
        F.count(F.lit(1)).alias("times"))


def tried_before_join_chunks(sales: DataFrame, menu: DataFrame, members: DataFrame, size: int = CHUNK_CHARS) -> DataFrame:
    """Q14's list of items in numbered chunks of ``size`` characters."""
    items = tried_before_join_counts(sales, menu, members).filter(F.col("kind") == "item")
    return text_chunks(items, [C], "value", "times", size=size)


def tried_before_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Q14: items (with repeats, one cell holds them all) and number of visit
    days before joining.

    One pass: every sale emits an item fact and a date fact, both counted
    per (customer, kind, value) map-side; the per-customer step then
    collects the item counts (bounded by distinct items) and counts the
    distinct dates.
    """
    is_item = F.col("kind") == "item"
    items = F.array_sort(F.collect_list(F.when(is_item, F.struct("value", F.col("times").alias("n")))))
    return tried_before_join_counts(sales, menu, members).groupBy(C).agg(
        expand_counted(items).alias("items_tried"),
        F.count_if(~is_item & F.col("value").isNotNull()).alias("no_of_visits"))
