"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The words of all texts are counted, the ``LEXICON_WORDS`` most frequent are
compiled into a minimal acyclic automaton: states with equal futures are
shared, and the outputs along a word's arcs add up to its number, which
points to its ids. The automaton's arrays go to one file in the shared
folder; Spark hands it to the executors, whose workers map it into memory.
A task looks all distinct words of a batch up at once, arc by arc, and merges
the words the lexicon lacks exactly (lowest rank first, leftmost first).

Edge cases: a null or empty text has no ids and decodes to the empty text; a
special token's text in a document is that token, as the tokenizers library
has it; words of any length are merged with a heap; repeated rows are encoded
each; an empty table gives an empty lexicon and no rows; further columns are
ignored.
"""

from __future__ import annotations

import functools
import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.packing import TEXTS_PER_BATCH, text_slices
from orderlens.llm.shared import ship_code, shared_path, table, write_bytes, written
from orderlens.llm.wordbpe import (MAX_WORD, WordEncoder, Words, gathered, in_order, vocabulary_path, word_spans)

LEXICON_WORDS = 65_536
NO_RANK = np.int64(1 << 40)
DECODE_ROWS = 500
_COMBINE_WORDS = 200_000          # distinct words a task counts before it passes them on
_FIELDS = (("arc_key", "<i8"), ("arc_target", "<i4"), ("arc_output", "<i4"), ("final", "u1"),
           ("id_first", "<i8"), ("id_flat", "<u4"))


# --- the vocabulary file ---------------------------------------------------

@functools.cache
def _byte_chars() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in shown}
    for n, b in enumerate(b for b in range(256) if b not in set(shown)):
        table[chr(256 + n)] = b
    return table


class Vocabulary:
    """Byte ids, merges and the bytes of every id of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, chars = spec["model"]["vocab"], _byte_chars()
        self.byte_id = [0] * 256
        for c, b in chars.items():
            self.byte_id[b] = vocab[c]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        pairs = sorted((a << 32 | b, rank, made) for (a, b), (rank, made) in self.merges.items())
        self.pair_key, self.pair_rank, self.pair_made = (np.array(x, np.int64) for x in zip(*pairs))
        text = {i: bytes(chars[c] for c in t) for t, i in vocab.items()}
        text |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        size = max(text) + 1
        self.bytes_of = np.frombuffer(b"".join(text.get(i, b"") for i in range(size)), np.uint8)
        self.bytes_count = np.array([len(text.get(i, b"")) for i in range(size)], np.int64)
        self.bytes_first = np.cumsum(self.bytes_count) - self.bytes_count

    def ranks(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (NO_RANK: no merge) and the id that it makes."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        hit = self.pair_key[at] == key
        return np.where(hit, self.pair_rank[at], NO_RANK), self.pair_made[at]

    def merge_many(self, raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words' bytes one after the other -> (all ids, ids per word). In
        each step every word merges its pair of lowest rank, leftmost first."""
        first = np.cumsum(lengths) - lengths
        order, ids, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        byte_id, low = np.array(self.byte_id, np.int64), 0
        for width in (8, 16, 32, MAX_WORD):
            some = np.flatnonzero((lengths > low) & (lengths <= width))
            low = width
            for at in range(0, len(some), 8192):
                rows = some[at:at + 8192]
                got, n = self._merge_rows(byte_id, raw, first[rows], lengths[rows], width)
                order.append(rows)
                ids.append(got)
                counts.append(n)
        for i in np.flatnonzero(lengths > low).tolist():
            got = self.merge(raw[first[i]:first[i] + lengths[i]].tobytes())
            order.append(np.array([i]))
            ids.append(np.array(got, np.uint32))
            counts.append(np.array([len(got)], np.int64))
        return in_order(np.concatenate(order), np.concatenate(ids), np.concatenate(counts))

    def _merge_rows(self, byte_id, raw, first, lengths, width):
        n, spot = len(first), np.arange(width)
        alive = spot < lengths[:, None]
        ids = np.where(alive, byte_id[raw[np.minimum(first[:, None] + spot, len(raw) - 1)]], 0)
        ids = np.hstack((ids, np.zeros((n, 1), np.int64)))
        after = np.tile(spot + 1, (n, 1))
        before = np.tile(np.append(spot, width) - 1, (n, 1))
        rank, made = np.full((n, width), NO_RANK), np.zeros((n, width), np.int64)
        r, c = np.nonzero(alive & (spot + 1 < lengths[:, None]))
        rank[r, c], made[r, c] = self.ranks(ids[r, c], ids[r, c + 1])
        rows = np.arange(n)
        while len(rows):
            i = rank[rows].argmin(axis=1)
            go = rank[rows, i] < NO_RANK
            rows, i = rows[go], i[go]
            j = after[rows, i]
            ids[rows, i] = made[rows, i]
            alive[rows, j] = False
            rank[rows, j] = NO_RANK
            k = after[rows, j]
            after[rows, i] = k
            before[rows, k] = i
            rank[rows, i] = NO_RANK
            some = k < lengths[rows]
            r, a = rows[some], i[some]
            rank[r, a], made[r, a] = self.ranks(ids[r, a], ids[r, k[some]])
            p = before[rows, i]
            some = p >= 0
            r, a = rows[some], p[some]
            rank[r, a], made[r, a] = self.ranks(ids[r, a], ids[r, i[some]])
        return ids[:, :width][alive].astype(np.uint32), alive.sum(axis=1)

    def merge(self, word: bytes) -> list[int]:
        """Exact ids of one word of any length."""
        ids, ranks = [self.byte_id[b] for b in word], self.merges
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(ranks[p][0], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or (ids[i], ids[j]) != pair:
                continue
            ids[i] = ranks[pair][1]
            alive[j] = False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (ids[a], ids[b]) in ranks:
                    p = (ids[a], ids[b])
                    heapq.heappush(heap, (ranks[p][0], a, p))
        return [x for x, ok in zip(ids, alive) if ok]

    def decode(self, ids: np.ndarray) -> bytes:
        return gathered(self.bytes_of, self.bytes_first[ids], self.bytes_count[ids]).tobytes()


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


# --- the automaton ---------------------------------------------------------

def compile_lexicon(words: list[str], ids: list[list[int]]) -> dict[str, np.ndarray]:
    """Distinct words and their ids -> arrays of the minimal transducer.

    Words come in order of their code points; a state is closed and looked
    up among the closed ones as soon as no later word can pass it.
    """
    order = sorted(range(len(words)), key=lambda i: words[i])
    closed: dict[tuple, int] = {}
    arcs: list[tuple] = []            # of closed states: ((label, target), ...), final
    path: list[list] = [[[], False]]  # open states: [[label, target or None] ...], final

    def close(depth: int) -> None:
        while len(path) > depth:
            out, final = path.pop()
            key = (tuple(map(tuple, out)), final)
            if key not in closed:
                closed[key] = len(arcs)
                arcs.append(key)
            if path:
                path[-1][0][-1][1] = closed[key]

    before = ""
    for i in order:
        word, same = words[i], 0
        while same < min(len(word), len(before)) and word[same] == before[same]:
            same += 1
        close(same + 1)
        for c in word[same:]:
            path[-1][0].append([ord(c), None])
            path.append([[], False])
        path[-1][1] = True
        before = word
    close(0)
    root = len(arcs) - 1
    below = [0] * len(arcs)           # words through a state; targets close before sources
    key, target, output = [], [], []
    number = {root: 0} | {s: s + 1 for s in range(root)}
    rows = []
    for state, (out, final) in enumerate(arcs):
        n = int(final)
        for label, to in out:
            rows.append((number[state] << 21 | label, number[to], n))
            n += below[to]
        below[state] = n
    rows.sort()
    key, target, output = (list(x) for x in zip(*rows)) if rows else ([], [], [])
    final = np.zeros(len(arcs), np.uint8)
    for state, (_, f) in enumerate(arcs):
        final[number[state]] = f
    counts = np.array([len(ids[i]) for i in order], np.int64)
    flat = np.array([x for i in order for x in ids[i]], np.uint32)
    return {"arc_key": np.array(key, np.int64), "arc_target": np.array(target, np.int32),
            "arc_output": np.array(output, np.int32), "final": final,
            "id_first": np.append(0, np.cumsum(counts)), "id_flat": flat}


def to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    sizes = np.array([len(arrays[n]) for n, _ in _FIELDS], "<i8").tobytes()
    out = [sizes]
    for name, kind in _FIELDS:
        raw = arrays[name].astype(kind).tobytes()
        out.append(raw + b"\0" * (-len(raw) % 8))
    return b"".join(out)


def map_file(path: str) -> dict[str, np.ndarray]:
    """The arrays of a lexicon file, mapped into memory."""
    raw = np.memmap(path, np.uint8, "r")
    sizes, at, out = raw[:8 * len(_FIELDS)].view("<i8"), 8 * len(_FIELDS), {}
    for (name, kind), n in zip(_FIELDS, sizes.tolist()):
        width = np.dtype(kind).itemsize * n
        out[name] = raw[at:at + width].view(kind)
        at += width + -width % 8
    return out


def utf8(words: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of these words, one after the other, and their numbers."""
    if not len(which):
        return np.zeros(1, np.uint8), np.zeros(0, np.int64)
    raw = np.frombuffer(words.joined(which).encode(), np.uint8)
    points = gathered(words.points, words.starts[which], words.lengths[which])
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    sizes = np.add.reduceat(width, np.cumsum(words.lengths[which]) - words.lengths[which])
    return np.delete(raw, np.cumsum(sizes + 1) - 1), sizes


class LexiconResolver:
    """Ids of words: the lexicon's, or merged exactly."""

    def __init__(self, arrays: dict[str, np.ndarray], words: Vocabulary):
        self.arrays, self.vocabulary = arrays, words

    def numbers(self, words: Words) -> np.ndarray:
        """The lexicon's number of each word, or -1. All words step together."""
        a = self.arrays
        out = np.full(len(words), -1, np.int64)
        if not len(a["arc_key"]):
            return out
        live, state, total = np.arange(len(words)), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        step = 0
        while len(live):
            done = words.lengths[live] == step
            ended = live[done]
            ok = a["final"][state[done]] == 1
            out[ended[ok]] = total[done][ok]
            live, state, total = live[~done], state[~done], total[~done]
            key = state << 21 | words.points[words.starts[live] + step].astype(np.int64)
            spot = np.minimum(np.searchsorted(a["arc_key"], key), len(a["arc_key"]) - 1)
            ok = a["arc_key"][spot] == key
            live, spot = live[ok], spot[ok]
            state, total = a["arc_target"][spot].astype(np.int64), total[ok] + a["arc_output"][spot]
            step += 1
        return out

    def __call__(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        a, number = self.arrays, self.numbers(words)
        known, unseen = np.flatnonzero(number >= 0), np.flatnonzero(number < 0)
        first = a["id_first"][number[known]]
        count = a["id_first"][number[known] + 1] - first
        merged, sizes = self.vocabulary.merge_many(*utf8(words, unseen))
        ids = np.concatenate((gathered(np.asarray(a["id_flat"]), first, count), merged)).astype(np.uint32)
        counts = np.concatenate((count, sizes))
        return in_order(np.concatenate((known, unseen)), ids, counts)


# --- Spark -----------------------------------------------------------------

def word_counts(docs: DataFrame) -> DataFrame:
    """docs (text) -> word, n: the words of all texts, counted within tasks
    first. Words over MAX_WORD characters are left to the exact merges."""
    def count(batches):
        seen: dict[str, int] = {}
        for b in batches:
            for words, n in word_spans(b.column(0).to_pylist()):
                for i, k in enumerate(n.tolist()):
                    w = words.text(i)
                    seen[w] = seen.get(w, 0) + k
                if len(seen) > _COMBINE_WORDS:
                    yield pa.record_batch([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                          names=["word", "n"])
                    seen = {}
        yield pa.record_batch([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                              names=["word", "n"])

    return (docs.select(F.col("text").cast("string")).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def build_lexicon(docs: DataFrame, path: str | None = None, size: int = LEXICON_WORDS) -> str:
    """Compile the most frequent words of docs (text), ``size`` at most, and
    register the file with Spark. Returns its name for encode_documents.

    Words are ranked by sixteenths of powers of two of their count, so that
    the driver sees a table of a thousand levels at most, and then the words
    of the levels that fit."""
    spark = docs.sparkSession
    ship_code(spark)
    counts = written(word_counts(docs).withColumn("level", F.floor(F.log2("n") * 16).cast("int")), "words")
    least, held = 0, 0
    for r in counts.groupBy("level").count().orderBy(F.desc("level")).collect():
        held += r["count"]
        if held > size:
            least = r["level"] + 1
            break
    words = [r.word for r in counts.filter(F.col("level") >= least).select("word").collect()]
    v = vocabulary(path or vocabulary_path())
    raw = to_bytes(compile_lexicon(words, [v.merge(w.encode()) for w in words]))
    uri = f"{shared_path(spark, 'lexicon')}.bin"
    write_bytes(spark, uri, raw)
    spark.sparkContext.addFile(uri)
    return uri.rpartition("/")[2]


@functools.lru_cache(maxsize=1)       # a worker that goes on to another lexicon drops the last one
def _encoder(path: str, lexicon: str) -> WordEncoder:
    return WordEncoder(path, LexiconResolver(map_file(SparkFiles.get(lexicon)), vocabulary(path)))


def encode_documents(docs: DataFrame, lexicon: str, path: str | None = None, decode: bool = False) -> DataFrame:
    """docs (doc_id, text) -> doc_id, ids (little-endian unsigned 32-bit) and,
    with ``decode``, the text that the ids stand for: beside the encoding, as a
    pass of its own would hold a second Python worker for each task."""
    path = path or vocabulary_path()

    def encode(batches):
        words, v = _encoder(path, lexicon), vocabulary(path)
        for b in batches:
            doc_ids, texts = b.column(0), b.column(1)
            for a, z in text_slices(texts, TEXTS_PER_BATCH):
                ids, counts = words.encode(texts.slice(a, z - a).to_pylist())
                stop = np.cumsum(counts)
                offsets = np.append(0, stop * 4).astype(np.int32)
                columns = [doc_ids.slice(a, z - a), pa.Array.from_buffers(
                    pa.binary(), z - a, [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u4", copy=False))])]
                if decode:
                    columns.append(pa.array([v.decode(ids[e - n:e]).decode("utf-8", "replace")
                                             for e, n in zip(stop.tolist(), counts.tolist())], pa.string()))
                yield pa.record_batch(columns, names=["doc_id", "ids", "text"][:len(columns)])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(encode, "doc_id long, ids binary" + (", text string" if decode else "")))


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """encode_documents's rows -> doc_id, ids, text."""
    path = path or vocabulary_path()

    def decode(batches):
        v = vocabulary(path)
        for b in batches:
            for at in range(0, b.num_rows, DECODE_ROWS):
                part = b.slice(at, DECODE_ROWS)
                texts = [v.decode(np.frombuffer(x.as_py() or b"", "<u4")).decode("utf-8", "replace") for x in part.column(1)]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.mapInArrow(decode, "doc_id long, ids binary, text string")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return (encode_documents(docs, build_lexicon(docs), decode=True)
            .select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                    F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2(F.encode("text", "utf-8"), 256).alias("decoded_sha256")))
