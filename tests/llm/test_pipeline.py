"""The pipeline against the brute-force versions of its stages."""

import zlib

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from orderlens.llm import packing as P
from orderlens.llm import secretscan as S

from . import test_jaccard, test_linededup, test_quality, test_tokens

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def brute(docs):
    """(doc_id, text, lang) rows -> pieces (doc_id, start, length, crc)."""
    judged = test_quality.brute(docs)
    ok = {r[0] for r in judged if r[-1]}
    docs = [d for d in docs if d[0] in ok]
    lines = {r[0]: r for r in test_linededup.brute([(d, t) for d, t, _ in docs], 50)}
    docs = [(d, lines[d][3], lang) for d, t, lang in docs if lines[d][2] == 0 or test_linededup.WORD.search(lines[d][3])]
    part = {d: c for d, _, c in test_jaccard.brute([(d, t) for d, t, _ in docs])}
    docs = [x for x in docs if part[x[0]] == x[0]]
    counts = {}
    for _, t, _ in docs:
        for *_, name, at in S.candidates(t or ""):
            counts[name, at] = counts.get((name, at), 0) + 1
    limits = S.step_up([(*k, n) for k, n in counts.items()])
    docs = [(d, S.masked(t, limits), lang) for d, t, lang in docs]
    out = []
    for (d, _, _), ids in zip(docs, test_tokens.library_ids([t for _, t, _ in docs])):
        ids = np.append(ids, np.uint32(0)).astype("<u4")
        at = 0
        for n in P.piece_lengths(len(ids), 1024):
            out.append((d, at, n, zlib.crc32(ids[at:at + n].tobytes())))
            at += n
    return sorted(out)


@pytest.mark.parametrize("d", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_against_brute_force(spark, d):
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "lang").collect()]
    got = E.queries()["pipeline"](spark, d).select("doc_id", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == brute(docs)


def test_stages_keep_the_columns(spark, tmp_path):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    odd = [(None, None, None, None, None), (-1, "", "en", "s", 0), (-2, None, "xx", None, None), tuple(rows[0]), tuple(rows[0])]
    docs = spark.createDataFrame([tuple(r) for r in rows] + odd, COLUMNS)
    for name, stage in C.STAGES:
        out = stage(spark, docs, "")
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert out.dtypes == docs.dtypes
        docs = out
    assert docs.count() > 0 and docs.filter("doc_id = %d" % rows[0].doc_id).groupBy("start").count().filter("count > 1").count() == 0


def test_empty_documents(spark):
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in C.STAGES:
        assert stage(spark, docs, "").count() == 0


def test_stage_results_on_their_own(spark):
    long = " ".join(f"The word number {i} of" for i in range(40))
    near = long.replace("number 7 ", "number seven ")
    docs = spark.createDataFrame([(3, long, "en", "s", len(long)), (2, near, "en", "s", len(near)), (5, long, "en", "s", len(long)), (9, "", "en", "s", 0),
                                  (5, long, "en", "s", len(long))], COLUMNS)
    left = sorted(r.doc_id for r in C.near_duplicates(spark, docs, "").collect())
    assert left == [2, 9]
    lines = sorted((r.doc_id, r.text == long) for r in C.line_dedup(spark, docs.filter("doc_id <> 2"), "").collect())
    assert lines == [(3, True), (9, False)]
    twice = docs.filter("doc_id = 5")
    assert C.near_duplicates(spark, twice, "").count() == 1
    masked = C.secret_scan(spark, spark.createDataFrame([(1, "x password=abcdefgh1 y", "en", "s", 22)], COLUMNS), "").first()
    assert (masked.text, masked.n_chars) == ("x [SECRET] y", 12)


def test_near_duplicates_with_clashing_columns(spark):
    """Extra columns may have any name; rows that repeat an id and a text are one."""
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, text), (2, text + " end"), (2, text + " end"), (3, "another text " + " ".join(f"x{i}" for i in range(60))), (3, None), (None, text), (4, "")]
    extra = ["_d", "_h", "id", "row", "gone", "again", "text_hash", "component_id", "a.b"]
    df = spark.createDataFrame([(*r, *extra) for r in rows], "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in extra))
    got = C.near_duplicates(spark, df, "")
    assert got.columns == df.columns
    assert sorted((str(r[0]), str(r[1])[:7]) for r in got.collect()) == [("1", "word0 w"), ("3", "None"), ("3", "another"), ("4", ""), ("None", "word0 w")]
