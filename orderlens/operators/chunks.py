"""Text lists of any length as numbered chunks.

A text aggregate holds a group's whole history in one cell, which ends at 2 GB.
``text_chunks`` gives the same text cut into pieces of bounded size, from the
counted rows: where each value's repeats start in the text is a running total of
lengths, so every chunk can be made by itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.agg import TEXT_AGG_SEPARATOR
from orderlens.operators.prefix import running_total

CHUNK_CHARS = 1 << 20


def text_chunks(counted: DataFrame, by: Sequence[str], value: str, times: str, text: str = "text",
                chunk: str = "chunk", size: int = CHUNK_CHARS, sep: str = TEXT_AGG_SEPARATOR) -> DataFrame:
    """counted (by, value, times), one row per (by, value) -> by, ``chunk`` (from
    0) and ``text``. A group's chunks, one after the other, are its sorted
    values, each ``times`` times, joined by ``sep``. A chunk has ``size``
    characters (the first fewer by the separator, the last what is left). NULL
    values are skipped; a group without others has no chunk."""
    if size <= len(sep):
        raise ValueError("size must be larger than the separator")
    rows = counted.filter(F.col(value).isNotNull() & (F.col(times) > 0)).select(
        *by, F.col(value).alias("_v"), (F.char_length(value) + len(sep)).cast("long").alias("_len"), F.col(times).cast("long").alias("_n"))
    # A separator stands before each value here; the first chunk drops its own.
    placed = running_total(rows, by, [F.col("_v")], F.col("_len") * F.col("_n"), "_start")
    stop = F.col("_start") + F.col("_len") * F.col("_n")
    cut = placed.withColumn("_stop", stop).withColumn(
        chunk, F.explode(F.sequence(F.expr(f"_start div {size}"), F.expr(f"(_stop - 1) div {size}"))))
    a = F.greatest("_start", F.col(chunk) * size)
    z = F.least("_stop", (F.col(chunk) + 1) * size)
    skip = F.pmod(a - F.col("_start"), F.col("_len"))
    repeats = F.ceil((skip + z - a) / F.col("_len")).cast("int")
    piece = F.substring(F.repeat(F.concat(F.lit(sep), F.col("_v")), repeats), (skip + 1).cast("int"), (z - a).cast("int"))
    pieces = cut.select(*by, chunk, F.struct(a.alias("at"), piece.alias("piece")).alias("_p"))
    whole = F.array_join(F.transform(F.array_sort("_ps"), lambda p: p["piece"]), "")
    return (pieces.groupBy(*by, chunk).agg(F.collect_list("_p").alias("_ps"))
            .select(*by, chunk, F.when(F.col(chunk) == 0, F.substring(whole, len(sep) + 1, size)).otherwise(whole).alias(text)))
