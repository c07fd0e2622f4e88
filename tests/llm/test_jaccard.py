import random
import re

import numpy as np
import pytest

from orderlens.llm import jaccard as J

SCHEMA = "doc_id long, text string, n string, component_id string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = WORD.findall((text or "").translate(UPPER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    up = {d: d for d, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return sorted((d, len(s), root(d)) for d, s in sets)


def check(spark, rows, **options):
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA)
    got = J.jaccard_components(df, **options)
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect())) == brute(rows)


def family(rng, n, size, edits, vocabulary):
    """n copies of a text of ``size`` words, each with up to ``edits`` words changed."""
    base = [rng.choice(vocabulary) for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        out.append(" ".join(w))
    return out


WORDS = [f"w{i}" for i in range(400)]


def corpus(seed):
    rng = random.Random(seed)
    texts = ["", None, " \n\t", "One two", "one TWO", "one two three", "É x", "é x", "a b c d e", "A  b\nc\x0bd e", "a b c d e f"]
    for size in (3, 5, 6, 7, 9, 12, 20, 40, 60, 130):
        texts += family(rng, 6, size, max(1, size // 12), WORDS)
    passage = " ".join(rng.choice(WORDS) for _ in range(60))
    for _ in range(25):                # a passage that many share, with more or less around it
        texts.append(" ".join([*rng.choices(WORDS, k=rng.choice([4, 10, 25, 60])), passage, *rng.choices(WORDS, k=rng.choice([0, 5, 30]))]))
    texts += family(rng, 40, 80, 3, WORDS)         # more near copies than a signature may have
    rng.shuffle(texts)
    rows = [(i * 3 - 30, t) for i, t in enumerate(texts)]
    return rows + [rows[-1], rows[20], rows[20]]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    check(spark, corpus(seed))


def test_every_signature_shared(spark):
    """With groups of two only, nearly all goes through the one-deletion
    neighbourhoods; with few pairs allowed too, through the rarest elements."""
    rows = corpus(3)
    check(spark, rows, group=2)
    check(spark, rows, group=2, pairs=1)


def test_edge_of_the_threshold(spark):
    """Exactly 80 of 100 shingles in common, and one less."""
    a = [f"x{i}" for i in range(94)]
    rows = [(1, " ".join(a)), (2, " ".join(a[:84] + [f"y{i}" for i in range(10)])), (3, " ".join(a[:83] + [f"z{i}" for i in range(11)])),
            (4, " ".join(a[10:] + a[:5]))]
    check(spark, rows)


def test_empty_table_and_null_ids(spark):
    assert J.jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(None, "a b c d e f", "", ""), (4, "a b c d e f", "", ""), (None, None, "", "")], SCHEMA)
    got = J.jaccard_components(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 2, None), (4, 2, 4), (None, 0, None)], key=str)


def test_long_text(spark):
    rng = random.Random(9)
    w = rng.choices(WORDS, k=60_000)
    v = list(w)
    for i in range(0, 60_000, 60):
        v[i] = "other"
    check(spark, [(1, " ".join(w)), (2, " ".join(v)), (3, " ".join(rng.choices(WORDS, k=50_000)))])


def test_components_of_a_chain(spark):
    from orderlens.llm.components import components
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7), (200, 150)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 150: 150, 200: 150}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_cells_never_part_similar_sets():
    """Sets that differ in few enough elements may always link; sets with a
    passage in common and too much besides hardly ever do."""
    rng = np.random.default_rng(5)
    sets = [rng.integers(1, 1 << 63, k).astype(np.uint64) for k in (9, 40, 300, 4000) for _ in range(20)]
    pairs = [(s, np.concatenate((s[len(s) // 10:], rng.integers(1, 1 << 63, len(s) // 10).astype(np.uint64)))) for s in sets]
    n = np.array([len(s) for p in pairs for s in p])
    cell = np.stack([J.cells(s) for p in pairs for s in p])
    at = np.arange(0, len(n), 2)
    assert J.may_link(n, cell, at, at + 1).all()
    passage = rng.integers(1, 1 << 63, 85).astype(np.uint64)
    others = [np.concatenate((passage, rng.integers(1, 1 << 63, 15).astype(np.uint64))) for _ in range(200)]
    i, j = np.triu_indices(200, 1)
    assert J.may_link(np.full(200, 100), np.stack([J.cells(s) for s in others]), i, j).mean() < 0.05


def test_a_passage_in_many_documents_gives_few_pairs(spark, monkeypatch):
    """240 documents of a passage and 14 to 18 shingles of their own: none are
    similar, and their pairs do not leave the buckets (28,680 did)."""
    rng = random.Random(8)
    passage = [rng.choice(WORDS) for _ in range(90)]
    rows = [(i, " ".join([*passage, *(f"own{i}x{k}" for k in range(rng.randint(14, 18)))])) for i in range(240)]
    met, keep = [], J.written
    monkeypatch.setattr(J, "written", lambda df, name: met.append((name, keep(df, name))) or met[-1][1])
    check(spark, rows, pairs=1 << 20)
    near = [df for name, df in met if name == "near"]
    assert len(near) == 1 and near[0].filter(near[0].kind == J.PAIR).count() <= 240


@pytest.mark.parametrize("common", [1, 50, 100_000])
def test_rarest_elements_of_many_sizes(spark, monkeypatch, common):
    """A passage in texts of all sizes, similar or not: all go through the
    rarest elements, of which none, some or all are known to every task."""
    rng = random.Random(common)
    passage = [rng.choice(WORDS) for _ in range(70)]
    texts = [" ".join([*passage[rng.choice([0, 0, 3, 9]):rng.choice([58, 62, 66, 70])], *(f"own{i}x{k}" for k in range(rng.randint(0, 16)))])
             for i in range(90)]
    texts += [" ".join([*passage, *tail]) for tail in ([f"t{j}x{k}" for k in range(6 + j)] for j in range(6)) for _ in range(2)]
    texts += [t + " more" for t in texts[-12:]] + family(rng, 12, 80, 3, WORDS) + [t[:-40] for t in family(rng, 8, 70, 2, WORDS)]
    rng.shuffle(texts)
    monkeypatch.setattr(J, "COMMON", common, raising=False)
    check(spark, list(enumerate(texts)), group=2, pairs=1)


def test_sets_are_not_moved_whole_to_find_their_rarest_elements(spark, monkeypatch):
    """240 sets of a passage and some elements of their own: none is moved
    with more elements than may be its rarest (all of them were), and those
    with more of their own than a similar set may lack meet in no pair."""
    rng = random.Random(8)
    passage = [rng.choice(WORDS) for _ in range(90)]
    rows = [(i, " ".join([*passage, *(f"own{i}x{k}" for k in range(rng.randint(10, 30)))])) for i in range(240)]
    met, keep = [], J.written
    monkeypatch.setattr(J, "written", lambda df, name: met.append((name, keep(df, name))) or met[-1][1])
    check(spark, rows, group=2, pairs=1)
    moved = [df for name, df in met if name == "elements"]
    assert len(moved) == 1 and 0 < moved[0].count() <= sum(len(shingles(t)) // 5 + 1 for _, t in rows)
