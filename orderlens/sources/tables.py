"""Parquet scans of the driver's tables.

A plain ``spark.read.parquet`` and a check of the columns' types; every
pipeline selects the columns it needs so that Catalyst prunes the scan
(ReadSchema) and pushes filters (PushedFilters) into it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


# Columns and types that the roles rely on; checked on every load.
REQUIRED = {
    "customer": {"c_custkey": "bigint", "c_mktsegment": "string"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string"},
    "part": {"p_partkey": "bigint", "p_name": "string", "p_type": "string", "p_retailprice": "double"},
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderdate": ("timestamp_ntz", "timestamp")},
    "lineitem": {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
                 "l_returnflag": "string"},
    "events": {"ts": ("timestamp_ntz", "timestamp"), "user_id": "bigint", "event_type": "string"},
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return check_columns(spark.read.parquet(table_path(sf_dir, name)), REQUIRED.get(name, {}), name)


def check_columns(df: DataFrame, required: dict[str, str | tuple[str, ...]], what: str) -> DataFrame:
    """Fail early when a bound table lacks a role column or has the wrong type.

    ``required`` maps column name to a Spark simple type string such as
    ``"bigint"`` or ``"string"``, or to several of them; ``"*"`` accepts any type.
    """
    types = dict(df.dtypes)
    for col, want in required.items():
        if col not in types:
            raise ValueError(f"{what}: missing column {col!r}; have {sorted(types)}")
        if want != "*" and types[col] not in ((want,) if isinstance(want, str) else want):
            raise ValueError(f"{what}: column {col!r} is {types[col]}, expected {want}")
    return df
