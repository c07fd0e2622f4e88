import math
import re
import textwrap

from orderlens.llm import licenses as L

SCHEMA = "id long, path string, text string, licence string, score string"
MIT, GPL, APACHE = (L.TEMPLATES[k] for k in ("MIT", "GPL-3.0", "Apache-2.0"))


def scan(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    return {r.id: r for r in L.licence_scan(df).collect()}


def test_own_and_inherited(spark):
    got = scan(spark, [
        (1, "a/LICENSE", MIT), (2, "a/b/x.py", "hello"), (3, "a/b/c/y.py", f"{APACHE}\ncode"), (4, "z.py", "x"), (5, None, "x"),
        (6, "a//b/c/COPYING.txt", f"some\n{GPL}\nx"), (7, "a/b/c/d/e.txt", None), (8, "a/b/c/q", "a licence to fish for many kinds of fish"),
        (9, "ab/x", ""), (10, None, MIT), (11, "w/only.txt", f"\n{MIT}\n"), (12, "w/other", "code"), (13, "a/b/x.py", "hello")])
    assert [(got[i].licence, got[i].origin) for i in range(1, 14)] == [
        ("MIT", "own"), ("MIT", "inherited"), ("Apache-2.0", "own"), (None, None), (None, None), ("GPL-3.0", "own"), ("GPL-3.0", "inherited"),
        ("GPL-3.0", "inherited"), (None, None), ("MIT", "own"), ("MIT", "own"), ("MIT", "inherited"), ("MIT", "inherited")]
    assert got[7].licence_path == "a//b/c/COPYING.txt" and got[2].licence_path == "a/LICENSE"


def test_first_of_several_licence_files(spark):
    got = scan(spark, [(1, "d/LICENSE.b", GPL), (2, "d/LICENSE.a", MIT), (3, "d/x", "code"), (4, "LICENSE", APACHE), (5, "e/f", "code")])
    assert got[3].licence_path == "d/LICENSE.a" and got[5].licence == "Apache-2.0"


def test_empty_and_long(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert L.licence_scan(df).count() == 0
    got = scan(spark, [(1, "x", "word " * 200_000 + f"\n{MIT}"), (2, "y", f"{MIT}\n" * 2000)])
    assert got[1].licence == "MIT" and got[2].licence == "MIT"


def test_many_matched_lines_in_one_file(spark):
    """Lines are compared with their templates only, not with each other."""
    import time
    scan(spark, [(1, "w", "All rights reserved.\n" * 10)])
    start = time.time()
    got = scan(spark, [(1, "LICENSE", "All rights reserved.\n" * 40_000), (2, "a", "All rights reserved.\n" * 500 + f"{MIT}\n" * 500)])
    assert got[1].licence == got[2].licence == "Proprietary" and time.time() - start < 90


def terms(line):
    words = re.sub(r"[^\w.\-]+|_", " ", line.lower()).split(" ")
    return [w for w in (re.sub(r"^[.\-]+|[.\-]+$", "", w) for w in words) if w]


def test_cosine_against_brute_force(spark):
    texts = [MIT, f"prose here\n{MIT} And the license of others.", "copyright", "All rights reserved.", "license license MIT", f"{GPL}\n{MIT}", "nothing", ""]
    n = len(texts)
    df = {}
    for t in texts:
        for w in set(terms(t.replace("\n", " "))):
            df[w] = df.get(w, 0) + 1
    vocabulary = {w for t in L.TEMPLATES.values() for w in terms(t)}
    weight = lambda w: math.log((1 + n) / (1 + df.get(w, 0))) + 1 if w in vocabulary else math.log(1 + n) + 1

    def vector(line):
        ws = terms(line)
        return {w: ws.count(w) * weight(w) for w in ws}

    def cosine(a, b):
        norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return sum(x * b.get(w, 0) for w, x in a.items()) / norm if norm else 0

    got = scan(spark, [(i, f"f/{i}", t) for i, t in enumerate(texts)])
    for i, t in enumerate(texts):
        best = max((cosine(vector(x), vector(s)) for x in t.split("\n") for s in L.TEMPLATES.values()), default=0)
        if best >= L.MIN_COSINE:
            assert abs(got[i].score - best) < 1e-6
        else:
            assert got[i].score is None


def test_same_shares_score_the_same_in_tables_of_any_size(spark):
    """66 of 10,000 files state it, and the words of the template are in no other."""
    line, one = "All rights reserved.", {"Proprietary": "Copyright. All rights reserved."}
    scores = set()
    for n in (10_000, 20_000, 50_000):
        files = spark.range(n).selectExpr("id", "concat('d/', id) AS path", f"IF(id % 10000 < 66, '{line}', concat('prose ', id)) AS text")
        own = L.statements(files, one).filter("licence IS NOT NULL").groupBy("score").count().collect()
        assert [r["count"] for r in own] == [n * 66 // 10_000]
        scores |= {r.score for r in own}
        stated = L.statements(files).filter("licence IS NOT NULL").groupBy("licence", "score").count().collect()
        assert [tuple(r) for r in stated] == [("Proprietary", 1.0, n * 66 // 10_000)]
    assert len(scores) == 1


def test_header_blocks_and_licence_texts(spark):
    """Templates wrapped as comments or as a file, single lines without a word of licence, and prose."""
    def block(name, mark="# ", width=60):
        return "\n".join(mark + x for x in textwrap.wrap(L.TEMPLATES[name], width))

    code = "import os\nprint(os.name)\n"
    headers = ["Apache-2.0/header", "GPL-3.0/header", "GPL-2.0/header", "LGPL-3.0/header", "AGPL-3.0/header", "MPL-2.0/header", "MIT/grant", "BSD-3-Clause/text", "BSD-2-Clause/text"]
    lines = {"Redistribution and use in source and binary forms, with or without": "BSD-3-Clause", "MIT License": "MIT", "SPDX-License-Identifier: MIT": "MIT",
             "This Source Code Form is subject to the terms of the Mozilla Public": "MPL-2.0", "// SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0",
             "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007": "GPL-3.0"}
    prose = [(1000 + i, f"p/{i}", f"the words of a text with use and code number {i} in it\nand of others") for i in range(300)]
    texts = [(h.split("/")[0], f"{code}\n{block(h, mark)}\n\n{code}") for h in headers for mark in ("# ", " * ")]
    texts += [(v, f"{code}{k}\n{code}") for k, v in lines.items()]
    got = scan(spark, [*prose, *((i, f"c{i}/x", t) for i, (_, t) in enumerate(texts)),
                       (900, "w/a.txt", "Copyright (c) 2020 A. Person\n\n" + block("MIT/text", "", 75)), (901, "w/b", code), (902, "v/a.txt", code + block("MPL-2.0/header")), (903, "v/b", code)])
    assert [got[i].licence for i in range(len(texts))] == [x for x, _ in texts]
    assert (got[900].licence, got[901].licence, got[901].origin) == ("MIT", "MIT", "inherited")
    assert (got[902].licence, got[903].licence) == ("MPL-2.0", None)
    assert all(got[i].licence is None for i, *_ in prose)


def test_whole_table(spark):
    """Every document is judged; those that end in a template's line state it."""
    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/documents.parquet").collect()
    got = {r.doc_id: r for r in L.op4_licences(spark, d).collect()}
    assert len(got) == len(rows)
    for r in rows:
        for name, statement in L.TEMPLATES.items():
            if statement in (r.text or "").split("\n"):
                assert got[r.doc_id].origin == "own"
