"""Line dedup by a suffix array over line-id sequences, in SQL functions only.

The lines that hold a word form a sequence per document. A line that occurs
once in the corpus is in no repeated run, so the suffix array holds the
suffixes that start with a repeated line, each cut where its next unique line
stands, or after the line at which ``MIN_WORDS`` words beyond its first line
are reached: no run that decides a deletion is longer than that.

* Ranks by prefix doubling (``suffix_ranks``): a suffix's rank is one more
  than the number of suffixes before its class. Classes of equal first 2^k
  lines are split by the rank of the suffix 2^k lines on: (rank, next rank) is
  counted over the corpus, put in order over range partitions and joined back.
  What is alone in its class, or ends, keeps its rank.
* Longest common prefixes (``suffix_array``): the suffixes are sorted by rank
  over range partitions, and each is compared with the one before it, over the
  partitions' borders too.
* Intervals (``repeated_runs``): at depth n an interval ends where the common
  prefix is below n; breaks are counted by a running total spread over tasks.
  An interval of two suffixes or more is a repeated run of n lines with a first
  place (by document id, then line) and a number of copies. For each suffix the
  depths from MIN_WORDS words on are looked at; the deepest interval in which
  it is not the first is its maximal run, and its lines are deleted.

A run of ``MIN_WORDS`` words or more with an equal run earlier (by document id,
then place; the two may overlap) is a later copy.

Edge cases: a null text stays null, an empty one empty; lines without a word
take no part and stay; rows with one
doc_id are ordered by the text's hash, and exact repeats of a row lose the
same lines; rows with a null doc_id are left as they are and are no copies of
anything; texts of any length are read whole; an empty table gives no rows;
further columns are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm.shared import table, written
from orderlens.operators.prefix import running_total

MIN_WORDS = 50
_SPACE = r"[\\x20\\x09-\\x0D]"
_SUFFIX = ["doc_id", "text_hash", "nth"]
ROW_BITS = 33          # of monotonically_increasing_id: the row inside its partition


def line_suffixes(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs (doc_id, text) -> one row per line with a word: doc_id, text_hash,
    nth, line (its id), reach (lines until min_words words, 0 if the document
    has fewer), places (line numbers in the text) and head (hashes) of the
    lines up to the cut by words."""
    lines = (docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
             .select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.expr(
                 f"filter(transform(split(text, '\\n'), (x, i) -> named_struct('i', i, 'x', x, "
                 f"'w', size(filter(split(x, '{_SPACE}+'), w -> w <> '')))), s -> s.w > 0)").alias("lines"))
             .withColumn("m", F.size("lines")).filter("m > 0")
             .withColumn("ids", F.expr("transform(lines, s -> unhex(md5(s.x)))"))
             .withColumn("hashes", F.expr("transform(lines, s -> xxhash64(s.x))"))
             .withColumn("sizes", F.expr("transform(lines, s -> CAST(s.w AS LONG))"))
             .withColumn("numbers", F.expr("transform(lines, s -> s.i)")).drop("lines"))
    reach = (f"aggregate(slice(sizes, i + 1, {min_words}), named_struct('n', 0, 's', 0L), "
             f"(a, w) -> CASE WHEN a.s >= {min_words} THEN a ELSE named_struct('n', a.n + 1, 's', a.s + w) END, "
             f"a -> CASE WHEN a.s >= {min_words} THEN a.n ELSE 0 END)")
    depth = "IF(coalesce(get(reaches, i + 1), 0) > 0, 1 + reaches[i + 1], m - i)"
    return (lines.withColumn("seq", F.expr("sequence(0, m - 1)")).withColumn("reaches", F.expr(f"transform(seq, i -> {reach})"))
            .withColumn("depths", F.expr(f"transform(seq, i -> {depth})"))
            .select("doc_id", "text_hash", F.expr(
                "inline(transform(seq, i -> named_struct('nth', i, 'line', ids[i], 'reach', reaches[i], "
                "'places', slice(numbers, i + 1, depths[i]), 'head', slice(hashes, i + 1, depths[i]))))")))


def suffix_ranks(suffixes: DataFrame) -> DataFrame:
    """Suffixes that start with a repeated line (doc_id, text_hash, nth, line,
    depth) -> doc_id, text_hash, nth, rank."""
    counts = suffixes.groupBy("line").agg(F.count(F.lit(1)).alias("members"))
    ranked = running_total(counts, [], [F.col("line")], F.col("members"), "before")
    state = written(suffixes.join(ranked, "line").select(*_SUFFIX, "depth", (F.col("before") + 1).alias("rank"),
                                                         (F.col("members") == 1).alias("done")), "ranks")
    settled, step = [], 1
    document = Window.partitionBy("doc_id", "text_hash")
    while not state.filter("NOT done").isEmpty():
        ahead = document.orderBy("nth").rangeBetween(step, step)
        # Nothing there (the end or a unique line), or beyond the cut: 0, before all ranks.
        following = F.when(F.col("depth") > step, F.coalesce(F.first("rank").over(ahead), F.lit(0))).otherwise(F.lit(0)).cast("long")
        # Documents without an open suffix have their ranks and leave the rounds.
        paired = written(state.withColumn("following", following).withColumn("busy", F.max(~F.col("done")).over(document)), "pairs")
        settled.append(paired.filter("NOT busy").select(*_SUFFIX, "rank"))
        open_ = paired.filter("NOT done")
        classes = open_.groupBy("rank", "following").agg(F.count(F.lit(1)).alias("members"))
        split = running_total(classes, ["rank"], [F.col("following")], F.col("members"), "before")
        again = (open_.join(split, ["rank", "following"])
                 .select(*_SUFFIX, "depth", (F.col("rank") + F.col("before")).alias("rank"),
                         ((F.col("members") == 1) | (F.col("following") == 0)).alias("done")))
        state = written(again.unionByName(paired.filter("busy AND done").drop("following", "busy")), "ranks")
        step *= 2
    return reduce(DataFrame.unionByName, settled, state.select(*_SUFFIX, "rank"))


def suffix_array(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs (doc_id, text) -> the suffixes from which min_words words are
    reached, in suffix order: place (struct of doc_id, text_hash, nth), at (its
    order), reach, places, depth, lcp (lines in common with the one before)."""
    found = written(line_suffixes(docs, min_words), "lines")
    # Exact repeats of a row are one document, so that a row repeated many
    # times makes no large group.
    repeated = found.groupBy("line").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("line")
    suffixes = written(found.join(repeated, "line").dropDuplicates(_SUFFIX).withColumn("depth", F.size("head")), "suffixes")
    ranks = suffix_ranks(suffixes.select(*_SUFFIX, "line", "depth"))
    order = ["rank", *_SUFFIX]
    rows = (suffixes.filter("reach > 0").join(ranks, _SUFFIX)
            .select("rank", *_SUFFIX, "reach", "places", "head")
            .repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("at", F.monotonically_increasing_id()))
    rows = written(rows, "order").withColumn("part", F.shiftright("at", ROW_BITS))
    ends = rows.groupBy("part").agg(F.max_by("head", "at").alias("last"))      # a row per partition
    ends = ends.select(F.col("part").alias("_part"), F.lag("last").over(Window.orderBy("part")).alias("border"))
    rows = (rows.withColumn("before", F.lag("head").over(Window.partitionBy("part").orderBy("at")))
            .join(F.broadcast(ends), F.col("part") == F.col("_part"))
            .withColumn("before", F.coalesce("before", "border", F.array().cast("array<bigint>"))))
    differ = F.expr("array_position(zip_with(head, before, (a, b) -> coalesce(a = b, false)), false)")
    lcp = F.when(differ == 0, F.size("head")).otherwise(differ - 1).cast("int")
    return rows.select(F.struct(*_SUFFIX).alias("place"), "at", "reach", "places", F.size("head").alias("depth"), lcp.alias("lcp"))


def suffix_intervals(array: DataFrame) -> DataFrame:
    """suffix_array -> a row per suffix and depth from ``reach`` on: n (lines),
    interval, place, lines (their numbers in the text)."""
    deep = array.select("place", "at", "places", "lcp", F.explode(F.expr("sequence(reach, depth)")).alias("n"))
    breaks = (F.col("lcp") < F.col("n")).cast("long")
    return (running_total(deep, ["n"], [F.col("at")], breaks, "before")
            .select("n", (F.col("before") + breaks).alias("interval"), "place", F.expr("slice(places, 1, n)").alias("lines")))


def repeated_runs(intervals: DataFrame) -> DataFrame:
    """suffix_intervals -> one row per run of n lines that occurs twice or
    more: n, interval, first (place), copies."""
    return (intervals.groupBy("n", "interval").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("copies"))
            .filter("copies > 1"))


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs (doc_id, text) -> doc_id, text_hash, removed (line numbers)."""
    intervals = written(suffix_intervals(suffix_array(docs, min_words)), "intervals")
    runs = written(repeated_runs(intervals), "repeated")
    longest = (intervals.join(runs.drop("copies"), ["n", "interval"]).filter(F.col("place") > F.col("first"))
               .groupBy("place").agg(F.max_by("lines", "n").alias("lines")))
    return (longest.groupBy("place.doc_id", "place.text_hash")
            .agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("removed")))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs -> struct ``row`` (the row as it was), text, n_lines, n_removed."""
    cut = later_copies(docs.select("doc_id", F.col("text").cast("string").alias("text")), min_words)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("_d"),
                       F.xxhash64(F.col("text").cast("string")).alias("_h"))
    joined = rows.join(cut, (rows["_d"] == cut["doc_id"]) & (rows["_h"] == cut["text_hash"]), "left")
    return (joined.withColumn("_lines", F.split(F.col("row.text").cast("string"), "\n"))
            .withColumn("n_lines", F.coalesce(F.size("_lines"), F.lit(0)).cast("long"))
            .withColumn("n_removed", F.coalesce(F.size("removed"), F.lit(0)).cast("long"))
            .withColumn("n_lines", F.greatest("n_lines", F.lit(0).cast("long")))
            .withColumn("n_removed", F.greatest("n_removed", F.lit(0).cast("long")))
            .withColumn("text", F.expr(
                "CASE WHEN removed IS NULL THEN CAST(row.text AS STRING) ELSE array_join(transform("
                "array_except(sequence(0, size(_lines) - 1), removed), i -> _lines[i]), '\\n') END"))
            .select("row", "text", "n_lines", "n_removed"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("row.doc_id", "n_lines", "n_removed", "text")


OP3_SQL = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL
), worded AS (
  SELECT *, len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS w FROM line
), l AS (
  SELECT doc_id, pos, line, w, row_number() OVER d AS nth, sum(w) OVER d AS upto FROM worded WHERE w > 0
  WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), whole AS (
  SELECT doc_id, list(line ORDER BY pos) AS all_lines FROM l GROUP BY doc_id
), run AS (
  SELECT a.doc_id, a.nth, b.nth AS upto, list_slice(all_lines, a.nth, b.nth) AS run
  FROM l a JOIN l b ON a.doc_id = b.doc_id AND b.nth BETWEEN a.nth AND a.nth + 49
  JOIN whole ON whole.doc_id = a.doc_id
  WHERE b.upto - a.upto + a.w >= 50 AND (b.upto - b.w - a.upto + a.w < 50 OR b.upto - a.upto < 50)
), copy AS (
  SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, nth) > 1
), gone AS (
  SELECT DISTINCT l.doc_id, l.pos FROM l JOIN copy ON l.doc_id = copy.doc_id AND l.nth BETWEEN copy.nth AND copy.upto
), kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM line ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
), n AS (
  SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
       coalesce(n.n, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""
