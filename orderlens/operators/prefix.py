"""Running totals and row numbers whose groups are spread over tasks.

A window over a whole table, or over a group with a third of its rows, is one
task. Here the rows are sorted over range partitions and written to the shared
scratch folder (so that a second reading, or a lost executor, sees the same
partitions); totals are made inside each partition, and what stands in earlier
partitions is added. That takes one row per partition: only the group that a
partition starts with can have rows in earlier ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import scratch_path

ROW_BITS = 33          # of monotonically_increasing_id: the row inside its partition


def _placed(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` sorted over range partitions, written and read back with ``_at``:
    the partition and the row inside it. Equal rows may be split too."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    ranged.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path)


def _part(at: str = "_at") -> Column:
    return F.shiftright(F.col(at), ROW_BITS)


def _earlier(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """parts (by, _part, _sum) -> (by, _part, _before) for the partitions that
    start inside a group: the sum of the group's earlier partitions. At most a
    row per partition, so that it may be broadcast."""
    w = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("_before", F.sum("_sum").over(w)).filter(F.col("_before").isNotNull()).drop("_sum")


def running_total(df: DataFrame, by: Sequence[str], order_by: Sequence[Column], value: Column, out: str) -> DataFrame:
    """``df`` with the total of ``value`` (a whole number) over the rows before
    this one in its group. Rows that are equal in ``order_by`` are taken in any
    order."""
    rows = _placed(df.withColumn("_value", value.cast("long")), [*[F.col(b) for b in by], *order_by], "running")
    rows = rows.withColumn("_part", _part())
    earlier = _earlier(rows.groupBy(*by, "_part").agg(F.sum("_value").alias("_sum")), by)
    earlier = earlier.select(*[F.col(b).alias(f"_by_{b}") for b in by], F.col("_part").alias("_p"), "_before")
    inside = Window.partitionBy(*by, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col("_part") == F.col("_p"), *[F.col(b).eqNullSafe(F.col(f"_by_{b}")) for b in by]]
    total = F.coalesce(F.sum("_value").over(inside), F.lit(0)) + F.coalesce("_before", F.lit(0))
    return rows.join(F.broadcast(earlier), same, "left").withColumn(out, total.cast("long")).select(*df.columns, out)


def global_row_number(df: DataFrame, order_by: Sequence[Column], out: str) -> DataFrame:
    """``row_number() over (order by ...)`` of the whole table, without gaps,
    from 1. The rows are shuffled once; what is put in one place is a count per
    partition."""
    rows = _placed(df, order_by, "numbered").withColumn("_part", _part())
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_sum"))
    first = _earlier(counts, []).select(F.col("_part").alias("_p"), "_before")
    inside = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (rows.join(F.broadcast(first), F.col("_part") == F.col("_p"), "left")
            .withColumn(out, F.coalesce("_before", F.lit(0)) + inside + 1).select(*df.columns, out))
