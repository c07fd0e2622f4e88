import math
import re
import unicodedata
from collections import Counter

import pytest

from orderlens.llm import quality as Q

SCHEMA = "doc_id long, text string, lang string, kept string, n_words string, row string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    t = text or ""
    w = WORD.findall(t)
    windows = list(zip(w, w[1:], w[2:]))
    often, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if often[x] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    failed = len(w) < Q.MIN_WORDS or 100 * len(covered) > Q.MAX_REPEAT_PERCENT * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed


def histograms(text, lang):
    t = text or ""
    kind = Counter()
    for c in t:
        k = unicodedata.category(c)
        kind["lower" if "a" <= c <= "z" else "space" if c in " \t\n\x0b\f\r" else "symbols" if c in "#*$%&|<>" else "upper" if k == "Lu"
             else "letter" if k[0] == "L" else "digit" if k == "Nd" else "punct" if c in ".,;:!?'\"()-" else "rest"] += 1
    words = [w.lower() for w in WORD.findall(t)]
    common = Q.COMMON_WORDS.get(lang, [])
    counts = [words.count(c) for c in common]
    return [kind[k] for k in ("lower", "space", "symbols", "upper", "letter", "digit", "punct", "rest")], counts + [len(words) - sum(counts)]


def distance(p, q):
    if len(p) != len(q) or not sum(p) or not sum(q):
        return 0
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    part = lambda a, b: a * math.log2(2 * a / (a + b)) / 2 if a else 0
    return math.sqrt(max(0, sum(part(a, b) + part(b, a) for a, b in zip(p, q))))


def brute(rows):
    """(doc_id, text, lang) -> doc_id, base features, kept."""
    add = lambda hs: [sum(x) for x in zip(*hs)]
    made = [(d, t, lang, base(t), *histograms(t, lang)) for d, t, lang in rows]
    out = []
    for d, _, lang, features, classes, common in made:
        like = [m for m in made if m[2] == lang and m[3][0] >= Q.MIN_WORDS]
        ref, ref_common = (add([m[4] for m in like]), add([m[5] for m in like])) if lang is not None and like else ([], [])
        far = features[1] >= Q.MIN_CHARS and distance(classes, ref) > Q.MAX_CHAR_DISTANCE
        if features[0] >= Q.MIN_JUDGED_WORDS and len(common) > 1:
            far |= distance(common, ref_common) > Q.MAX_WORD_DISTANCE + Q.WORD_NOISE / math.sqrt(features[0])
        out.append((d, *features, not features[-1] and not far))
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    got = Q.quality_report(df).select(*Q.REPORT)
    expected = brute(rows)
    assert sorted(map(tuple, got.collect()), key=str) == expected
    kept = Q.accepted(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r[0] for r in expected if r[-1]), key=str)
    return expected


def test_whole_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").collect()]
    expected = check(spark, rows)
    verdicts = Counter(r[-1] for r in expected if not r[-2])
    assert verdicts[True] > 10 * verdicts[False] > 0


def test_edges(spark):
    good = "The end of a long day is the start of another, and it was good. " * 3 + " ".join(f"word{i} of" for i in range(60))
    check(spark, [(1, None, "en"), (2, "", "en"), (3, " \t\n\x0b", None), (4, good, "en"), (4, good, "en"), (5, good, None), (6, good, "xx"),
                  (7, "a b c " * 40, "en"), (8, "é Ü １ 漢字 🙂 " * 60, "fr"), (9, "%%% ### *** " + "zz| " * 300, "en"), (None, good, "en"),
                  (10, "a b c a b c d", "en"), (11, "x y z\u00a0w " * 70, "de"), (12, "same\nsame\n\n \nsame", "en"), (13, " ".join(f"q{i}" for i in range(30_000)), "en")])


def test_pipeline_keeps_clean_documents_of_rare_languages(spark):
    import corpus_pipeline
    english = "The end of a long day is the start of another, and it was good. " * 3 + " ".join(f"word{i} of" for i in range(60))
    russian = " ".join(f"слово{'абвгде'[i % 6]}{'жзиклмн'[i % 7]}" + "опрст"[i % 5] * (1 + i // 42) for i in range(120))
    junk = " ".join(f"%{i}%#" * 2 for i in range(120))
    rows = [(i, english, "en") for i in range(3000)] + [(5000, russian, "ru"), (5001, russian, None)]
    rows += [(6000 + i, russian, "bg") for i in range(3)] + [(9000, junk, "en"), (9001, "short", "ru")]
    # Beside them so much English that bg has under a thousandth.
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    many = spark.range(10_000, 120_000).selectExpr("id AS doc_id", "'few words' AS text", "'en' AS lang", "'x' AS kept", "'y' AS n_words", "'z' AS row")
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs.unionByName(many), "").select("doc_id").collect()}
    assert kept == {r[0] for r in rows if r[0] < 9000}


def test_verdicts_of_a_doubled_table(spark):
    """The same documents twice, and beside many others, get the same verdicts."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()]
    rows += [(50_000, " ".join(f"ещё{i} слово{i % 50}" for i in range(90)), "ru"), (50_001, "plain words " + " ".join(f"w{i}" for i in range(90)), None)]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    other = spark.range(200_000, 320_000).selectExpr("id AS doc_id", "'few words' AS text", "'en' AS lang", "'x' AS kept", "'y' AS n_words", "'z' AS row")
    again = df.unionByName(df.withColumn("doc_id", df.doc_id + 100_000)).unionByName(other)
    once = {r.doc_id: r.kept for r in Q.quality_report(df).collect()}
    twice = {r.doc_id: r.kept for r in Q.quality_report(again).filter("doc_id < 200000").collect()}
    assert twice == {**once, **{k + 100_000: v for k, v in once.items()}} and (once[50_000], once[50_001]) == (True, True)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert Q.quality_report(df).count() == 0 and Q.accepted(df).count() == 0


@pytest.mark.parametrize("p,q", [([1, 0], [0, 1]), ([1, 2, 3], [1, 2, 3]), ([0, 0], [1, 1]), ([5, 1, 0], [1, 1, 7])])
def test_distance(spark, p, q):
    got = spark.createDataFrame([(p, q)], "p array<long>, q array<long>").select(Q.distance("p", "q")).first()[0]
    assert (got is None and not sum(p)) or abs(got - distance(p, q)) < 1e-12
