"""A training corpus from the documents table, stage by stage.

Every stage is a function (spark, docs, sf_dir) -> DataFrame; its result is
written and read back as the next stage's docs. All stages but the last return
the columns of documents.

1. quality_rules: documents that the rules reject go; without a reference of
   their own language the base rules alone decide.
2. line_dedup: later copies of runs of lines go, and documents of which
   nothing is left.
3. near_duplicates: of each group of near duplicates the smallest id stays.
4. secret_scan: secrets are masked in the text.
5. packing: documents become token sequences (one row per piece).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.jaccard import jaccard_components
from orderlens.llm.linededup import dedup_lines
from orderlens.llm.packing import pack_documents
from orderlens.llm.quality import accepted
from orderlens.llm.secretscan import redacted
from orderlens.llm.shared import table, written

WORD = r"[^\x20\x09-\x0D]"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = dedup_lines(docs).filter((F.col("n_removed") == 0) | F.col("text").rlike(WORD))
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("text")).otherwise(F.col("row.text")),
           "n_chars": F.when(changed, F.length("text")).otherwise(F.col("row.n_chars"))} if "n_chars" in docs.columns else {
           "text": F.when(changed, F.col("text")).otherwise(F.col("row.text"))}
    return out.select(*[(new[c].cast(t) if c in new else F.col(f"row.`{c}`")).alias(c) for c, t in docs.dtypes])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = written(jaccard_components(docs), "groups")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select(
        "row", F.col("row.doc_id").cast("long").alias("id"), F.col("row.text").cast("string").alias("text"))
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone"), "text_hash").distinct()
    kept = rows.join(gone, (F.col("id") == F.col("gone")) & (F.xxhash64("text") == F.col("text_hash")), "left_anti")
    # Rows that stand more than once under one id are one document.
    repeated = found.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("again")).count().filter("count > 1").select("again")
    if repeated.isEmpty():
        return kept.select("row.*")
    once = kept.join(repeated, F.col("id") == F.col("again"), "left_semi").dropDuplicates(["id", "text"])
    return kept.join(repeated, F.col("id") == F.col("again"), "left_anti").unionByName(once).select("row.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

# Tokens of a vocabulary file and cut signatures are beyond SQL: tested
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
