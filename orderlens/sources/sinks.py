"""Table sinks: schema-checked overwrite and append, in folders and in the catalog.

The reference creates and fills a table in place (drop / create /
insert). Here a table is a parquet folder on shared storage; ``overwrite``
replaces it and ``append`` adds rows. Rows are cast to the declared
StructType first, so a value that does not fit fails the job (ANSI cast)
instead of silently changing the table's schema.

``save_table`` declares the table in the catalog with a layout: buckets by a
key, so that joins and aggregates on it need no shuffle, or folders by a column,
so that a filter on it reads only its folders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast ``df`` to exactly ``schema`` (by column name)."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns for schema: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _checked(mode: str) -> str:
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    return mode


def write_table(df: DataFrame, path: str, schema: StructType, mode: str = "overwrite") -> None:
    conform(df, schema).write.mode(_checked(mode)).parquet(path)


def read_written(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def save_table(df: DataFrame, name: str, schema: StructType, path: str, mode: str = "overwrite",
               bucket_by: Sequence[str] = (), buckets: int = 0, partition_by: Sequence[str] = ()) -> DataFrame:
    """Create (``overwrite``) or add to (``append``) catalog table ``name`` in
    folder ``path``, and return it. An append needs the layout that the table
    was created with.

    Rows are dealt out by the layout's columns first, so that a task writes a
    few files; what a hot key makes too large is split over several tasks, each
    with a file of its own in the key's bucket or folder.
    """
    spark, rows = df.sparkSession, conform(df, schema)
    layout = [*partition_by, *bucket_by]
    if bool(bucket_by) != (buckets > 0):
        raise ValueError("buckets must be positive with bucket_by, and only with it")
    if layout:
        rows = rows.hint("rebalance", *([buckets] if buckets else []), *layout)
    writer = rows.write.format("parquet").mode(_checked(mode)).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)
    return spark.table(name)
