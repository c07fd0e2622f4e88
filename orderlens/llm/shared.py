"""Small helpers of the training-data operators."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import orderlens
from orderlens.session import ensure_checkpoint_dir

_shipped: set[str] = set()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_bytes(spark: SparkSession, uri: str, raw: bytes) -> None:
    """A small file in any store that Spark reaches."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(uri)
    stream = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    stream.write(raw)
    stream.close()


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once per application: their Python
    workers import the operators' modules."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root, raw = Path(orderlens.__file__).parent, io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    uri = f"{shared_path(spark, 'code')}.zip"
    write_bytes(spark, uri, raw.getvalue())
    sc.addPyFile(uri)
    _shipped.add(sc.applicationId)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    survives lost executors, and a failed task is simply run again."""
    spark = df.sparkSession
    ship_code(spark)
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def running_start(totals: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` over a table with one row per
    partition (or per partition and size class): a table as small as the
    number of partitions, so that one task may order it."""
    from pyspark.sql import Window
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0).cast("long")))
