import random
import re

import pytest

from orderlens.llm import linededup as D

SCHEMA = "doc_id long, text string, removed string, lines string, n_removed string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, least):
    """Delete every line of a run of lines (with a word) of ``least`` words or
    more that has an equal run earlier."""
    docs = []
    for d, t in rows:
        lines = (t or "").split("\n")
        docs.append((d, t, lines, [(i, x) for i, x in enumerate(lines) if WORD.search(x)]))
    order = sorted({(d, t) for d, t, *_ in docs if d is not None and t is not None})
    seen, gone = set(), {}
    for d, t in order:
        seq = [(i, x) for i, x in enumerate(t.split("\n")) if WORD.search(x)]
        for p in range(len(seq)):
            words = 0
            for q in range(p, min(len(seq), p + 3 * least)):
                words += len(WORD.findall(seq[q][1]))
                run = tuple(x for _, x in seq[p:q + 1])
                if words >= least:
                    if run in seen:
                        gone.setdefault((d, t), set()).update(i for i, _ in seq[p:q + 1])
                    seen.add(run)
    out = []
    for d, t, lines, _ in docs:
        cut = gone.get((d, t), set())
        out.append((d, len(lines) if t is not None else 0, len(cut), None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in cut)))
    return sorted(out, key=str)


def check(spark, rows, least):
    df = spark.createDataFrame([(d, t, "x", "y", "z") for d, t in rows], SCHEMA)
    got = D.dedup_lines(df, least).select("row.doc_id", "n_lines", "n_removed", "text").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, least)


@pytest.mark.parametrize("seed,least", [(1, 3), (2, 6), (3, 1), (4, 9)])
def test_against_brute_force(spark, seed, least):
    rng = random.Random(seed)
    lines = ["a b", "c", "d e f", "", " \t", "g h i j", "é k"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    check(spark, rows, least)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(5, long), (3, f"x\n{long}\n\ny"), (9, None), (8, ""), (7, "\n\n"), (None, long), (11, f"{long}\n{long}"), (12, "\n".join(["same line"] * 200)),
            (13, "q " * 49), (14, "q " * 49), (20, long), (20, long)]
    check(spark, rows, 50)


def test_one_id_with_several_texts(spark):
    a, b = "a b c d", "e f g h"
    df = spark.createDataFrame([(1, f"{a}\n{b}", "", "", ""), (1, f"{b}\nother", "", "", ""), (2, f"{a}\nz", "", "", "")], SCHEMA)
    got = sorted(r.text for r in D.dedup_lines(df, 4).collect())
    # Which text of id 1 comes first is up to its hash; b stands once, a once.
    assert sum(b in t for t in got) == 1 and sum(a in t for t in got) == 1


def test_empty_table(spark):
    assert D.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_text(spark):
    rows = [(1, "\n".join(f"line {i} of many" for i in range(20_000))), (2, "\n".join(f"line {i} of many" for i in range(10_000, 20_000)) + "\nend")]
    df = spark.createDataFrame([(d, t, "x", "y", "z") for d, t in rows], SCHEMA)
    got = {r.row.doc_id: r for r in D.dedup_lines(df).collect()}
    assert got[1].n_removed == 0 and got[2].n_removed == 10_000 and got[2].text == "end"
