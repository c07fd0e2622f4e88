"""Quality rules by distribution divergence, in SQL functions only.

Two histograms of each document, of character classes and of common words of
its language, are compared with those of the language as a whole (summed over
all documents of at least ``MIN_WORDS`` words) by the Jensen-Shannon distance
(base 2, 0 to 1). A document is rejected if it fails the base rules (too few
words, too many repeated three-word windows) or lies too far from its
language. Guards: characters are compared only from ``MIN_CHARS`` word
characters on, common words only from ``MIN_JUDGED_WORDS`` words on.

Every language has a reference, summed over its documents however many they
are, so that a document's verdict does not depend on the size of the table.
Documents without a language, or in one without a document of ``MIN_WORDS``
words, are judged by the base rules only. The references, a row per language,
are joined as their size allows.

Edge cases: a null or empty text has no words, all counts 0, and fails the
base rules; texts of any length are judged whole; repeated rows are judged
each; an empty table gives no rows; further columns are ignored by
``quality_report`` and kept by ``accepted``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.shared import table, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CHARS = 200
MIN_JUDGED_WORDS = 100
MAX_CHAR_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.2          # plus WORD_NOISE / sqrt(words): a short text's counts scatter
WORD_NOISE = 0.5

# Common words of four languages.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "it", "that", "for", "was", "on", "are", "with", "be", "this"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "sur"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no"],
}
SPACE = r"[\x20\x09-\x0D]"
_CLASSES = ["n_lower", "n_space", "n_symbols", "n_upper", "n_letter", "n_digit", "n_punct", "n_rest"]


def _words() -> Column:
    return F.filter(F.split(F.col("t"), SPACE + "+"), lambda w: w != "")


def _windows() -> Column:
    """Hashes of the three-word windows of ``words``."""
    n = F.greatest(F.size("words") - 2, F.lit(0))
    one, two, three = (F.slice("words", F.lit(i), n).alias(a) for i, a in ((1, "a"), (2, "b"), (3, "c")))
    return F.transform(F.arrays_zip(one, two, three), lambda w: F.xxhash64(w["a"], w["b"], w["c"]))


# Words in windows whose hash occurs again: sort (hash, place), keep places
# whose neighbour has the same hash, and sum up what their windows cover.
_REPEATED = """
CASE WHEN size(array_distinct(windows)) = size(windows) THEN 0L ELSE
  aggregate(
    array_sort(transform(
      transform(array(array_sort(transform(windows, (h, i) -> named_struct('h', h, 'i', i)))),
        s -> filter(s, (e, j) -> (j > 0 AND get(s, j - 1).h = e.h) OR (j + 1 < size(s) AND get(s, j + 1).h = e.h)))[0],
      e -> e.i)),
    named_struct('n', 0L, 'upto', -1),
    (a, i) -> named_struct('n', a.n + CAST(i + 2 - greatest(a.upto, i - 1) AS LONG), 'upto', i + 2),
    a -> a.n)
END"""


def _removed(longer: str, shorter: str) -> Column:
    return (F.length(longer) - F.length(shorter)).cast("long")


def histograms(docs: DataFrame) -> DataFrame:
    """Add t (the text, null as empty), words, the character classes and the
    counts of the language's common words (the last: other words)."""
    lists = F.create_map(*[x for k, v in COMMON_WORDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    out = docs.withColumn("t", F.coalesce(F.col("text").cast("string"), F.lit(""))).withColumn("words", _words())
    steps = [("n_lower", "[a-z]+"), ("n_space", SPACE + "+"), ("n_symbols", "[#*$%&|<>]+"), ("n_upper", r"\p{Lu}+"),
             ("n_letter", r"\p{L}+"), ("n_digit", r"\p{Nd}+"), ("n_punct", r"[.,;:!?'\"()-]+")]
    last = "t"
    for name, pattern in steps:          # each class is taken away before the next is counted
        out = out.withColumn(f"_{name}", F.regexp_replace(last, pattern, "")).withColumn(name, _removed(last, f"_{name}"))
        last = f"_{name}"
    joined = F.concat(F.lit(" "), F.lower(F.array_join("words", "  ")), F.lit(" "))
    out = (out.withColumn("n_rest", F.length(last).cast("long")).withColumn("n_words", F.size("words").cast("long"))
           .withColumn("_j", joined)
           .withColumn("_list", F.coalesce(lists[F.col("lang")], F.array().cast("array<string>"))))
    out = out.withColumn("_common", F.expr(
        "transform(_list, w -> CAST((octet_length(_j) - octet_length(replace(_j, concat(' ', w, ' '), '')))"
        " / (octet_length(w) + 2) AS LONG))"))
    out = out.withColumn("common", F.concat("_common", F.array(
        F.col("n_words") - F.aggregate("_common", F.lit(0).cast("long"), lambda a, x: a + x))))
    return out.withColumn("classes", F.array(*_CLASSES)).drop("_j", "_list", "_common", *[f"_{n}" for n, _ in steps])


def base_features(out: DataFrame) -> DataFrame:
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (out.withColumn("_lines", lines).withColumn("windows", _windows())
            .withColumn("word_chars", (F.length("t") - F.col("n_space")).cast("long"))
            .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
            .withColumn("n_repeat_words", F.expr(_REPEATED))
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT))
            .drop("_lines", "windows"))


def references(features: DataFrame) -> DataFrame:
    """Histograms of each language, summed over its documents of MIN_WORDS
    words or more: as many rows as languages."""
    size = len(next(iter(COMMON_WORDS.values()))) + 1
    columns = [(f"{c}_{i}", F.coalesce(F.get(F.col(c), F.lit(i)), F.lit(0).cast("long")))
               for c, n in (("classes", len(_CLASSES)), ("common", size)) for i in range(n)]
    total = (features.filter((F.col("n_words") >= MIN_WORDS) & F.col("lang").isNotNull())
             .groupBy(F.col("lang").alias("ref_lang"), F.size("common").alias("k")).agg(*[F.sum(v).alias(c) for c, v in columns]))
    return total.select("ref_lang", F.array(*[f"classes_{i}" for i in range(len(_CLASSES))]).alias("ref_classes"),
                        F.slice(F.array(*[f"common_{i}" for i in range(size)]), F.lit(1), F.col("k")).alias("ref_common"))


def distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance of two arrays of counts; null if one is empty or
    sums to 0."""
    return F.expr(f"""
      transform(array(named_struct('p', aggregate({p}, 0D, (a, x) -> a + x), 'q', aggregate({q}, 0D, (a, x) -> a + x))), s ->
        CASE WHEN s.p > 0 AND s.q > 0 AND size({p}) = size({q}) THEN sqrt(greatest(0D, aggregate(zip_with({p}, {q}, (a, b) ->
          CASE WHEN a > 0 THEN a / s.p * log2(2 * (a / s.p) / (a / s.p + b / s.q)) / 2 ELSE 0D END +
          CASE WHEN b > 0 THEN b / s.q * log2(2 * (b / s.q) / (a / s.p + b / s.q)) / 2 ELSE 0D END), 0D, (a, x) -> a + x))) END)[0]""")


def judged(features: DataFrame, refs: DataFrame) -> DataFrame:
    """Add char_distance, word_distance and kept."""
    out = (features.join(refs, features["lang"] == refs["ref_lang"], "left")
           .withColumn("char_distance", F.when(F.col("word_chars") >= MIN_CHARS, distance("classes", "ref_classes")))
           .withColumn("word_distance", F.when((F.col("n_words") >= MIN_JUDGED_WORDS) & (F.size("common") > 1),
                                               distance("common", "ref_common"))))
    far = (F.coalesce(F.col("char_distance"), F.lit(0.0)) > MAX_CHAR_DISTANCE) | (
        F.coalesce(F.col("word_distance"), F.lit(0.0)) > MAX_WORD_DISTANCE + WORD_NOISE / F.sqrt("n_words"))
    return out.withColumn("kept", ~F.col("base_failed") & ~far)


REPORT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def quality_report(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, lang) -> the report's columns and both distances."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    features = written(base_features(histograms(rows)).select(
        "lang", "classes", "common", *[c for c in REPORT if c != "kept"]), "features")
    return judged(features, references(features)).select(*REPORT, "char_distance", "word_distance")


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with their own columns. The references
    come from a first pass; the verdict is made beside the text, without a
    join by id."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    refs = written(references(histograms(rows)), "references")
    verdicts = judged(base_features(histograms(rows)), refs)
    # A filter would be pushed down, and with it all that the verdict is made
    # of would be computed again for each use; a generator is not.
    return (verdicts.select(F.explode(F.when(F.col("kept"), F.array("row")).otherwise(F.array().cast(
        verdicts.select(F.array("row")).schema[0].dataType))).alias("row")).select("row.*"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents")).select(*REPORT)


def _oracle() -> str:
    space, classes = r"[\x20\x09-\x0D]", ["[a-z]", r"[\x20\x09-\x0D]", "[#*$%&|<>]", r"\p{Lu}", r"\p{L}", r"\p{Nd}", r"[.,;:!?''\"()-]"]
    size = len(next(iter(COMMON_WORDS.values()))) + 1
    lists = " ".join(f"WHEN '{k}' THEN {v}" for k, v in COMMON_WORDS.items())
    left = ["t"]
    for c in classes:
        left.append(f"regexp_replace({left[-1]}, '{c}+', '', 'g')")
    counts = ", ".join([f"length({a}) - length({b})" for a, b in zip(left, left[1:])] + [f"length({left[-1]})"])

    def sums(name: str, n: int) -> str:
        return "[" + ", ".join(f"sum(coalesce({name}[{i}], 0))" for i in range(1, n + 1)) + "]"

    def distance(p: str, q: str) -> str:
        return f"""CASE WHEN list_sum({p}) > 0 AND list_sum({q}) > 0 AND len({p}) = len({q}) THEN sqrt(greatest(0, list_sum(list_transform(
          list_zip(list_transform({p}, lambda x: x / list_sum({p})), list_transform({q}, lambda x: x / list_sum({q}))), lambda z:
          CASE WHEN z[1] > 0 THEN z[1] * log2(2 * z[1] / (z[1] + z[2])) / 2 ELSE 0 END +
          CASE WHEN z[2] > 0 THEN z[2] * log2(2 * z[2] / (z[1] + z[2])) / 2 ELSE 0 END)))) ELSE 0 END"""

    return f"""
WITH d AS (
  SELECT doc_id, lang, t, list_filter(regexp_split_to_array(t, '{space}+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines, [{counts}] AS classes
  FROM (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents)
), e AS (
  SELECT *, len(w) AS n, list_transform(coalesce(CASE lang {lists} END, []), lambda c: len(list_filter(w, lambda x: lower(x) = c))) AS listed FROM d
), f AS (
  SELECT *, list_append(listed, n - coalesce(list_sum(listed), 0)) AS common FROM e
), win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
  FROM (SELECT doc_id, w, unnest(range(1, n - 1)) AS i FROM f WHERE n > 2)
), again AS (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i) AS k FROM again GROUP BY doc_id
), base AS (
  SELECT f.*, coalesce(k, 0) AS k, n < {MIN_WORDS} OR 100 * coalesce(k, 0) > {MAX_REPEAT_PERCENT} * n AS failed
  FROM f LEFT JOIN covered USING (doc_id)
), ref AS (
  SELECT lang, {sums("classes", len(classes) + 1)} AS ref, {sums("common", size)} AS ref_common FROM f
  WHERE n >= {MIN_WORDS} GROUP BY lang
), near AS (
  SELECT base.*, len(t) - classes[2] AS chars, {distance("classes", "ref")} AS char_distance,
         {distance("common", "ref_common")} AS word_distance
  FROM base LEFT JOIN ref USING (lang)
)
SELECT doc_id, n AS n_words, chars AS word_chars, classes[3] AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
       k AS n_repeat_words, failed AS base_failed,
       NOT failed AND NOT (chars >= {MIN_CHARS} AND coalesce(char_distance, 0) > {MAX_CHAR_DISTANCE})
         AND NOT (n >= {MIN_JUDGED_WORDS} AND len(common) > 1 AND coalesce(word_distance, 0) > {MAX_WORD_DISTANCE} + {WORD_NOISE} / sqrt(n)) AS kept
FROM near
"""


OP6_SQL = _oracle()
