"""Join operators that Spark has no single scalable form for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_in(df: DataFrame, key: str, other: DataFrame, other_key: str | None = None,
           null_aware: bool = True) -> DataFrame:
    """Rows of ``df`` whose ``key`` is NOT IN ``other.other_key``.

    SQL NOT IN is three-valued: one NULL on the right empties the result,
    and a NULL left key is dropped unless the right side is empty. Spark
    plans NOT IN as a null-aware anti join that can only broadcast the right
    side. Here it is a plain (shuffle or broadcast, chosen by AQE from the
    real size) ``left_anti`` join plus a one-row summary of the right side
    (row count, NULL count) that is cross-joined for the NULL rules; only
    that one row is broadcast.

    ``null_aware=False`` gives NOT EXISTS semantics instead (NULL left keys
    kept, NULL right keys ignored).
    """
    other_key = other_key or key
    right = other.select(F.col(other_key).alias("_nk"))
    kept = df.join(right, df[key] == right["_nk"], "left_anti")
    if not null_aware:
        return kept
    summary = right.agg(F.count(F.lit(1)).alias("_n_right"),
                        F.count_if(F.col("_nk").isNull()).alias("_n_null"))
    ok = (F.col("_n_right") == 0) | ((F.col("_n_null") == 0) & F.col(key).isNotNull())
    return kept.crossJoin(F.broadcast(summary)).filter(ok).drop("_n_right", "_n_null")
