"""One customer holds a third of all sales, half of them on one date: results stay exact.

The pipelines are run with more shuffle partitions than usual and checked
against a pandas brute force of the question's definition.
"""

import datetime as dt

import pandas as pd
from conftest import rows
from pyspark.sql import functions as F

from orderlens.plans import loyalty as L

N_ROWS = 30_000
HOT = 0
HOT_DATE = dt.date(2021, 1, 1)


def _tables(spark):
    ids = spark.range(N_ROWS)
    sales = ids.select(
        F.when(F.col("id") % 3 == 0, F.lit(HOT)).otherwise(F.col("id") % 400 + 1).alias("customer_id"),
        F.when(F.col("id") % 6 == 0, F.lit(HOT_DATE)).otherwise(
            F.date_add(F.lit(HOT_DATE), (F.col("id") % 37).cast("int"))).alias("order_date"),
        ((F.col("id") * 7919) % 9).cast("int").alias("product_id"))
    menu = spark.createDataFrame([(i, f"item{i % 6}", i + 1) for i in range(9)],
                                 "product_id int, product_name string, price int").withColumn(
        "price", F.col("price").cast("decimal(10,2)"))
    members = spark.range(0, 60).select(F.col("id").alias("customer_id"),
                                        F.date_add(F.lit(dt.date(2021, 1, 5)),
                                                   (F.col("id") % 20).cast("int")).alias("join_date"))
    return sales, menu, members


def test_skewed_customer(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sales, menu, members = _tables(spark)
        s = sales.toPandas().merge(menu.toPandas(), on="product_id")
        m = members.toPandas()
        assert (s.customer_id == HOT).mean() > 0.3

        # Q3: distinct names on each customer's first date
        first = s[s.order_date == s.groupby("customer_id").order_date.transform("min")]
        want = sorted((c, ",".join(sorted(set(g.product_name)))) for c, g in first.groupby("customer_id"))
        assert sorted(rows(L.first_items(sales, menu))) == want

        # Q5: all names tied at the highest count
        cnt = s.groupby(["customer_id", "product_name"]).size().rename("n").reset_index()
        top = cnt[cnt.n == cnt.groupby("customer_id").n.transform("max")]
        want = sorted((c, ",".join(sorted(g.product_name))) for c, g in top.groupby("customer_id"))
        assert sorted(rows(L.favourite_items(sales, menu))) == want

        # Q12: dense rank of the date among the member's 'Y' rows
        sm = s.merge(m, on="customer_id")
        y = sm[sm.order_date >= sm.join_date].copy()
        y["ranking"] = y.groupby("customer_id").order_date.rank(method="dense").astype(int).astype(str)
        want = sorted(tuples_of(y[["customer_id", "order_date", "ranking"]]))
        got = [(c, d, r) for c, d, r, mem in rows(L.rank_all(sales, menu, members),
                                                  "customer_id", "order_date", "ranking", "member") if mem == "Y"]
        assert sorted(got) == want

        # Q14: items with repeats and visit days before joining
        b = sm[sm.order_date < sm.join_date]
        want = sorted((c, ",".join(sorted(g.product_name)), g.order_date.nunique())
                      for c, g in b.groupby("customer_id"))
        assert sorted(rows(L.tried_before_join(sales, menu, members))) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def tuples_of(df: pd.DataFrame) -> list[tuple]:
    return [tuple(r) for r in df.itertuples(index=False, name=None)]
