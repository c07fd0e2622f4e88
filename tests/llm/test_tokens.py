"""Token files, packing and the lexicon against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from orderlens.llm import lexicon as L
from orderlens.llm import packing as P
from orderlens.llm import tokenfile as T
from orderlens.llm import wordbpe as W

PATH = W.vocabulary_path()
SCHEMA = "doc_id long, text string, lang string, n_tokens string, start string, ids string"
TEXTS = ["", None, "x", "I'm don't 'll ''s a's's", "a  b\n\n c \n d\t\te  ", " 12ab34 ..'s", "՘abc def", "\U0001f642 x",
         "<|endoftext|> x<|endoftext|>", "x" * 300 + " " + "yz" * 70, " \n", "\x1c a\x85b　c  ", "漢字 かな カナ12。", "a" * 5000,
         "the the the", "the the the"]


def library_ids(texts):
    return [np.array(e.ids, "<u4") for e in W.library(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(3 * i - 5, t, "en", "clash", "clash", "clash") for i, t in enumerate(TEXTS)]
    rows += [rows[3], rows[3], (7, "another text of one id", "en", None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def random_texts(n):
    rng = random.Random(5)
    return ["".join(rng.choice(list("ab'st \n\t1.é漢rev ld’")) for _ in range(rng.randint(0, 160))) for _ in range(n)]


def test_words_of_random_texts():
    texts = [t or "" for t in TEXTS] + random_texts(2000)
    expected = library_ids(texts)
    words = [(w.text(i), k) for w, n in W.word_spans(random_texts(2000)) for i, k in enumerate(n.tolist())]
    frequent = sorted({w for w, _ in words})[::3]
    v = L.vocabulary(PATH)
    arrays = L.compile_lexicon(frequent, [v.merge(w.encode()) for w in frequent])
    for resolve in (None, L.LexiconResolver(arrays, v)):
        ids, counts = W.WordEncoder(PATH, resolve).encode(texts)
        parts = np.split(ids, np.cumsum(counts)[:-1])
        assert all(np.array_equal(a, b) for a, b in zip(parts, expected))
    assert [v.decode(x).decode("utf-8", "replace") for x in expected] == [
        W.library(PATH).decode(x.tolist(), skip_special_tokens=False) for x in expected]


def test_cache_limit_changes_nothing(monkeypatch):
    texts = random_texts(300)
    monkeypatch.setattr(W, "MAX_CACHED_WORDS", 50)
    monkeypatch.setattr(W, "_CHUNK_CHARS", 500)
    ids, _ = W.WordEncoder(PATH).encode(texts)
    assert np.array_equal(ids, np.concatenate(library_ids(texts)))


def test_lexicon_numbers_words(tmp_path):
    words = ["a", "ab", "abc", "b", "bc", "bbc", "éa", " the", " then"]
    arrays = L.compile_lexicon(words, [[i, i + 1] for i in range(len(words))])
    (tmp_path / "lexicon").write_bytes(L.to_bytes(arrays))
    arrays = L.map_file(str(tmp_path / "lexicon"))
    asked = words + ["", "c", "abcd", " th", "é"]
    flat = np.frombuffer("".join(asked).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(w) for w in asked])
    numbers = L.LexiconResolver(arrays, None).numbers(W.Words(flat, np.cumsum(sizes) - sizes, sizes))
    order = sorted(words)
    assert numbers.tolist() == [order.index(w) if w in words else -1 for w in asked]
    # Shared futures: fewer states than a tree of prefixes would have.
    assert len(arrays["final"]) < 1 + len({w[:k] for w in words for k in range(1, len(w) + 1)})


def test_empty_lexicon():
    arrays = L.compile_lexicon([], [])
    flat = np.array([97], np.uint32)
    assert L.LexiconResolver(arrays, None).numbers(W.Words(flat, np.array([0]), np.array([1]))).tolist() == [-1]


@pytest.mark.parametrize("ids", [[], [0], [1, 2, 3], list(range(5000)), [0] * 9000, [2**32 - 1, 0, 7]])
def test_planes_round_trip(ids):
    ids = np.array(ids, np.uint32)
    assert np.array_equal(T.from_planes(T.to_planes(ids), len(ids)), ids)
    blocks = T.to_planes(ids, 64)
    assert len(blocks) == -(-len(ids) // 64)
    for first, stop in [(0, 1), (63, 65), (100, 100), (64, 128), (130, 10**6)]:
        read = [b if first // 64 <= k < -(-stop // 64) else None for k, b in enumerate(blocks)]     # the others are not looked at
        assert np.array_equal(T.from_planes(read, len(ids), 64, first, stop), ids[first:stop])


def test_token_file(spark, docs, tmp_path, monkeypatch):
    T.write_token_file(docs, str(tmp_path / "t"))
    got = T.read_token_file(spark, str(tmp_path / "t"), keep_ids=True).collect()
    rows = docs.select("doc_id", "text").collect()
    expected = {(r.doc_id, np.append(x, np.uint32(0)).astype("<u4").tobytes()) for r, x in zip(rows, library_ids([r.text for r in rows]))}
    assert len(got) == len(rows) and {(r.doc_id, bytes(r.ids)) for r in got} == expected
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in rows)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens for r in got)


def test_reading_a_stretch_of_ids(spark, docs, tmp_path):
    path = str(tmp_path / "t")
    T.write_token_file(docs, path, block=64, chunk_ids=200)
    whole = b"".join(bytes(r.ids) for r in T.read_token_file(spark, path, keep_ids=True).orderBy("start").collect())
    n = len(whole) // 4
    for first, stop in [(0, n), (1, 2), (n // 3, n // 2), (n - 5, n + 100), (n, n + 1), (7, 7)]:
        got = T.read_token_ids(spark, path, first, stop).orderBy("start").collect()
        assert b"".join(bytes(r.ids) for r in got) == whole[4 * first:4 * stop]
        assert all(r.n_ids * 4 == len(r.ids) for r in got)
    index = spark.read.parquet(f"{path}/index").collect()
    chunks = {(r.part, r.chunk): r.planes for r in spark.read.parquet(f"{path}/chunks").collect()}
    assert len(chunks) > len({part for part, _ in chunks}) and not T.read_token_ids(spark, path, 7, 7).collect()
    assert all([[len(p) for p in b] for b in chunks[r.part, r.chunk]] == r.plane_bytes for r in index)
    with pytest.raises(ValueError):
        T.write_token_file(docs, path, block=100)


def test_token_file_of_no_documents(spark, docs, tmp_path):
    T.write_token_file(docs.limit(0), str(tmp_path / "t"))
    assert T.read_token_file(spark, str(tmp_path / "t")).count() == 0


@pytest.mark.parametrize("n,most,pieces", [(1, 1024, [1]), (1320, 1024, [1024, 256, 32, 8]), (2048, 1024, [1024, 1024]), (7, 4, [4, 2, 1])])
def test_piece_lengths(n, most, pieces):
    assert P.piece_lengths(n, most) == pieces


def test_packing(spark, docs):
    got = P.pack_documents(docs.drop("ids", "start"), keep_ids=True, max_length=64).collect()
    rows = docs.select("doc_id", "text").collect()
    whole = sorted((r.doc_id, np.append(x, np.uint32(0)).astype("<u4").tobytes()) for r, x in zip(rows, library_ids([r.text for r in rows])))
    pieces = {}
    for r in got:
        assert r.length & (r.length - 1) == 0 and r.offset == 0 and len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, bytes(r.ids)))
    assert sorted(r.sequence_id for r in got) == list(range(len(got)))
    lengths = [r.length for r in sorted(got, key=lambda r: r.sequence_id)]
    assert lengths == sorted(lengths, reverse=True)
    single = {d: x for d, x in whole if [w[0] for w in whole].count(d) == 1}
    for d, x in single.items():
        assert b"".join(p for _, p in sorted(pieces[d, len(x) // 4])) == x
    assert sum(r.length for r in got) == sum(len(x) for _, x in whole) // 4
    assert P.pack_documents(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        P.pack_documents(docs, max_length=1000)


def test_lexicon_round_trip(spark, docs):
    name = L.build_lexicon(docs, size=5)
    got = L.decode_documents(L.encode_documents(docs, name)).collect()
    rows = docs.select("doc_id", "text").collect()
    expected = sorted((r.doc_id, x.tobytes(), r.text or "") for r, x in zip(rows, library_ids([r.text for r in rows])))
    assert sorted((r.doc_id, bytes(r.ids), r.text) for r in got) == expected
    empty = docs.limit(0)
    assert L.encode_documents(empty, L.build_lexicon(empty)).count() == 0


def test_queries_on_the_small_table(spark):
    from pyspark.sql import functions as F
    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/documents.parquet").orderBy("doc_id").collect()
    ids = library_ids([r.text for r in rows])
    ended = [np.append(x, np.uint32(0)).astype("<u4") for x in ids]
    start = np.cumsum([0] + [len(x) for x in ended])[:-1].tolist()
    got = sorted(map(tuple, T.op5_token_file(spark, d).collect()))
    assert got == [(r.doc_id, s, len(x), zlib.crc32(x.tobytes())) for r, s, x in zip(rows, start, ended)]
    bpe = {r.doc_id: r for r in L.op10_bpe(spark, d).collect()}
    for r, x in zip(rows, ids):
        b = bpe[r.doc_id]
        assert (b.n_tokens, b.ids_sha256) == (len(x), hashlib.sha256(x.tobytes()).hexdigest())
        assert b.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    packed = P.op9_packing(spark, d)
    by_doc = {r.doc_id: x for r, x in zip(rows, ended)}
    for p in packed.collect():
        assert zlib.crc32(by_doc[p.doc_id][p.start:p.start + p.length].tobytes()) == p.ids_crc32
    sums = packed.agg(F.sum("length")).first()[0]
    assert sums == sum(map(len, ended))
