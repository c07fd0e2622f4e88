"""Periodic runs against a brute force over all periods."""

import hashlib
import random
import re
import zlib

import pytest

from orderlens.llm import periodicruns as P

SCHEMA = "doc_id long, text string, runs string, n_words string"
WORD = re.compile(P.WORDS)


def brute(w: list, least: int) -> list[tuple[int, int, int]]:
    """Maximal stretches of equal pairs for each period, without those that
    have a smaller period too."""
    out, n = [], len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, 2 * q) and not any(
                    all(w[x] == w[x + r] for x in range(i, i + size - r)) for r in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out)


def planted(doc_id, text):
    w = WORD.findall(text or "")
    if doc_id is None or not w:
        return w
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def kept(w, runs):
    gone = {i for a, size, q in runs for i in range(a + q, a + size)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def expected(doc_id, text):
    w = planted(doc_id, text)
    runs = brute(w, 12)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2],
            sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(kept(w, runs)))


def texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = [rng.choice(["a", "b", "ü", "d" * 40][:rng.randint(1, 4)]) for _ in range(rng.randint(0, 60))]
        if words and rng.random() < 0.5:
            a, p = rng.randrange(len(words)), rng.randint(1, 9)
            words[a:] = [words[min(a + i % p, len(words) - 1)] for i in range(len(words) - a)]
        out.append("".join(w + rng.choice([" ", "\n", "\t \r\n"]) for w in words))
    return out


@pytest.mark.parametrize("least", [2, 3, 7, 12])
def test_runs_of_texts(least):
    cut = [t.encode().split() for t in texts(least, 300)]
    for w, got in zip(cut, P.runs_of_texts(cut, least)):
        assert [tuple(r) for r in got.tolist()] == brute(w, least)


def test_tree_holds_every_suffix():
    s = [1, 2, 2, 1, 2, 2, 1, 2, 1]
    tree = P.SuffixTree([*s, 0], 3)
    whole = [*s, 0]
    order = sorted(range(len(whole)), key=lambda i: whole[i:])
    assert tree.rank.tolist() == [order.index(i) for i in range(len(whole))]
    other = sorted(range(len(whole)), key=lambda i: [-x for x in whole[i:-1]])
    assert tree.reversed_rank().tolist() == [other.index(i) for i in range(len(whole))]


@pytest.mark.parametrize("batch", [50, 1_000_000])
def test_query(spark, tmp_path, monkeypatch, batch):
    monkeypatch.setattr(P, "TEXTS_PER_BATCH", batch)
    rows = [(i * 7 - 60, t) for i, t in enumerate(texts(5, 120))]
    rows += [(None, "x " * 30), (5000, None), (5001, ""), (5002, " \n\t "), (5003, "nbsp stays " * 13), (5003, "nbsp stays " * 13),
             (5004, " ".join(str(i % 700) for i in range(3000)))]
    (spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
     .write.parquet(str(tmp_path / "documents.parquet")))
    got = P.op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {k for c, k in got.dtypes if not c.endswith("sha256")} == {"bigint"}
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted((expected(*r) for r in rows), key=key)


def test_spans_and_texts(spark):
    df = spark.createDataFrame([(1, "s " + "a b c " * 5 + "e"), (2, "plain text")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in P.periodic_runs(df).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(1, 15, 3)]
    assert (got[1]["n_words"], got[1]["collapsed"], got[2]["collapsed"]) == (17, "s a b c e", "plain text")
    assert P.periodic_runs(df.limit(0)).collect() == []


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert P.op13_periodic_runs(spark, str(tmp_path)).collect() == []
