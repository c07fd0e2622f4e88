"""URL filters: rules first, then gradient-boosted trees.

A rule is a host (or a suffix of it) and the start of a path, with a verdict;
the rule with the longest host wins, among those the one with the longest path,
and ``block`` where two are equal. Rules are a list or a table of any size:
each distinct host and path asks for its host suffixes, and for the starts of
its path at the lengths that rules of such a suffix have, so that rules are
found by joins on equal keys. URLs that no rule fits are
judged by gradient-boosted trees on lexical features (length, depth, digit
ratio, entropy, parameters, host labels, and how often URLs of the same host
suffix were allowed). The rates of the suffixes come from all URLs that a rule
has labelled; the trees are trained from ``MAX_TRAINING`` distinct ones of
them at most, half of each verdict, drawn by the hash of the URL and weighted
by the share of the verdict among all labelled URLs.

Edge cases: a null url, or one without ``://``, has an empty host and path,
fits no rule and is judged by the trees like any other; without labelled URLs
of both verdicts the one verdict there is (``allow`` if there is none) goes
to all; urls of any length are read whole; repeated rows are judged each; an
empty table gives no rows; further columns are ignored. Rules with a null fit
nothing; without rules all URLs are judged by the trees.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.shared import table, written

MAX_TRAINING = 20_000
TREES = 8
DEPTH = 3
# Verdict, host, start of the path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
FEATURES = ["f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_digits", "f_entropy",
            "f_parameters", "f_query_length", "f_fragment", "f_suffix"]


def parsed(pages: DataFrame) -> DataFrame:
    """Add host and path."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise("")
    host = F.regexp_extract("_rest", r"(?s)^([^/?#]*)", 1)
    return (pages.withColumn("_url", url).withColumn("_rest", rest)
            .withColumn("host", F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            .withColumn("path", F.regexp_extract("_rest", r"(?s)^[^/?#]*([^?#]*)", 1)).drop("_rest"))


def rule_table(spark: SparkSession, rules) -> DataFrame:
    """Rules as rows (verdict, rule_host, rule_start), one per host and start."""
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([tuple(r) for r in rules], "verdict string, host string, start string")
    return (rules.select("verdict", F.col("host").alias("rule_host"), F.col("start").alias("rule_start"))
            .filter("verdict IS NOT NULL").groupBy("rule_host", "rule_start").agg(F.max("verdict").alias("rule_verdict")))


def ruled(rows: DataFrame, rules=RULES) -> DataFrame:
    """Add rule (host and path start, like ``net/es/``) and rule_verdict."""
    known = rule_table(rows.sparkSession, rules)
    lengths = known.select("rule_host", F.length("rule_start").alias("_n")).distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    asked = (rows.select("host", "path").distinct().withColumn("rule_host", F.explode(suffixes)).join(lengths, "rule_host")
             .filter(F.length("path") >= F.col("_n")).withColumn("rule_start", F.expr("substring(path, 1, _n)")))
    best = (asked.join(known, ["rule_host", "rule_start"]).groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule_host").alias("h"), "_n", F.concat("rule_host", "rule_start").alias("rule"), "rule_verdict")).alias("_r"))
            .select("host", "path", "_r.rule", "_r.rule_verdict"))
    return rows.join(best, ["host", "path"], "left")


def lexical(rows: DataFrame) -> DataFrame:
    """Add the lexical features of _url, host and path."""
    length = F.length("_url").cast("double")
    entropy = F.expr("""aggregate(transform(filter(array_distinct(split(_url, '')), c -> c <> ''), c ->
        (length(_url) - length(replace(_url, c, ''))) / length(_url)), 0D, (a, p) -> a - p * log2(p))""")
    query = F.regexp_extract("_url", r"(?s)\?([^#]*)", 1)
    return (rows.withColumn("f_length", length)
            .withColumn("f_host_length", F.length("host").cast("double"))
            .withColumn("f_path_length", F.length("path").cast("double"))
            .withColumn("f_depth", F.size(F.filter(F.split("path", "/"), lambda x: x != "")).cast("double"))
            .withColumn("f_labels", F.size(F.filter(F.split("host", r"\."), lambda x: x != "")).cast("double"))
            .withColumn("f_digits", F.coalesce(F.try_divide(length - F.length(F.regexp_replace("_url", "[0-9]+", "")), length), F.lit(0.0)))
            .withColumn("f_entropy", F.coalesce(entropy, F.lit(0.0)))
            .withColumn("f_parameters", F.size(F.filter(F.split(query, "&"), lambda x: x != "")).cast("double"))
            .withColumn("f_query_length", F.length(query).cast("double"))
            .withColumn("f_fragment", F.contains("_url", F.lit("#")).cast("double"))
            .withColumn("suffix", F.substring_index("host", ".", -1)))


def url_verdicts(pages: DataFrame, rules=RULES, max_training: int = MAX_TRAINING) -> DataFrame:
    """pages (page_id, url) -> page_id, host, path, rule, verdict, score."""
    rows = lexical(ruled(parsed(pages.select("page_id", "url")), rules))
    labelled = rows.filter("rule_verdict IS NOT NULL").withColumn("label", (F.col("rule_verdict") == "allow").cast("double"))
    # The rate is drawn to the overall one by ten further URLs.
    counts = written(labelled.groupBy("suffix").agg(F.sum("label").alias("allowed"), F.count("*").alias("n")), "suffixes")
    allowed, n = counts.agg(F.coalesce(F.sum("allowed"), F.lit(0.0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    label = {k: v for k, v in ((1.0, allowed), (0.0, n - allowed)) if v}
    overall = allowed / max(1, n)
    rates = counts.select("suffix", ((F.col("allowed") + 10 * overall) / (F.col("n") + 10)).alias("f_suffix"))

    def with_rate(df: DataFrame) -> DataFrame:
        return df.join(rates, "suffix", "left").withColumn("f_suffix", F.coalesce("f_suffix", F.lit(overall)))

    if len(label) < 2:
        score = F.lit(1.0 if label.get(0.0, 0) == 0 else 0.0)
        judged = rows.withColumn("score", score)
    else:
        assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
        columns = ["label", "suffix", *[f for f in FEATURES if f != "f_suffix"]]
        some = labelled.select("_url", *columns).dropDuplicates(["_url"])
        half = max(1, max_training // 2)
        drawn = [some.filter(F.col("label") == k).orderBy(F.xxhash64("_url"), "_url").limit(half) for k in (0.0, 1.0)]
        sample = written(drawn[0].unionByName(drawn[1]).select(*columns), "labelled")
        sizes = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
        weight = F.when(F.col("label") == 1.0, label[1.0] / sizes[1.0]).otherwise(label[0.0] / sizes[0.0]) * (sum(sizes.values()) / n)
        training = assemble.transform(with_rate(sample)).select("label", "features", weight.alias("weight"))
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, stepSize=0.3, weightCol="weight").fit(training)
        from pyspark.ml.functions import vector_to_array
        judged = (model.transform(assemble.transform(with_rate(rows)))
                  .withColumn("score", F.get(vector_to_array("probability"), F.lit(1))))
    verdict = F.coalesce("rule_verdict", F.when(F.col("score") >= 0.5, "allow").otherwise("block"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))
