"""SparkSession construction and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every pipeline relies on. AQE re-plans joins from runtime sizes
# (broadcast only below spark.sql.autoBroadcastJoinThreshold, which Spark
# checks against real shuffle statistics) and splits skewed partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "orderlens", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    On a cluster pass master=None and let spark-submit decide; the shuffle
    partition count should then come from the cluster config (AQE coalesces
    small partitions at run time).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is;
    if it is missing there, this fails instead of falling back to a folder
    that only one machine can see. Only for a local master (tests, bench)
    is a scratch folder created when the setting is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="orderlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def local_session(cores: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests and the bench: local[N], small shuffle count."""
    n = cores or int(os.environ.get("BENCH_CPUS", "8"))
    return build_session(master=f"local[{n}]", shuffle_partitions=shuffle_partitions or n,
                         extra={"spark.driver.memory": "8g"})
