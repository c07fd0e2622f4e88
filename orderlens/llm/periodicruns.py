"""Runs of words that repeat periodically, found by suffix trees.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal) and a length of at least ``max(min_length, 2 q)`` that neither
neighbouring word extends. Every run is found, and every found run is one:

1. Words that no run can hold are left out. A run of length L has L - q >= half
   its length equal pairs (i, i + q), so that each of its words lies in a
   stretch of ``min_length // 2`` words that occurs twice in the document; what
   is between such stretches becomes one symbol that occurs nowhere else. Equal
   hashes of different stretches only keep more words.
2. Ukkonen's algorithm builds the suffix tree of what is left and of its
   reversal. The Euler tour of a tree, kept where it passes from leaf to leaf,
   and a sparse table of its least depths give the lowest common ancestor of
   two leaves, so the common extension of two places, in constant time.
3. Each place is the start of one longest Lyndon word for either order of the
   symbols (up to the next smaller suffix, whose ranks the tour has). Every run
   holds such a root; roots are extended both ways, and those whose extensions
   reach a period are runs.

Documents are worked on in Arrow batches, a task holds the words of
``TEXTS_PER_BATCH`` characters or of one longer document at a time. Trees take
about 500 bytes for each word that step 1 keeps.

Edge cases: a null, empty or blank text has no words, no runs and an empty
collapsed text; repeated rows each give a row; rows with a null id keep it; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.packing import text_slices
from orderlens.llm.shared import ship_code, table

MIN_LENGTH = 12
TEXTS_PER_BATCH = 1_000_000       # characters of text whose words a task holds at once
WORDS = r"[^\x20\x09-\x0D]+"

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def suffix_tree(s: list[int], sigma: int) -> tuple[dict[int, int], list[int], list[int]]:
    """Ukkonen's tree of ``s``, whose last symbol occurs once: edges
    (node * sigma + symbol -> node) and each node's label s[start:stop], which
    ends at len(s) for leaves. Node 0 is the root."""
    n = len(s)
    edges: dict[int, int] = {}
    start, stop, link = [0], [0], [0]
    node = at = matched = pending = 0        # the active point, and suffixes not yet in the tree
    for i, c in enumerate(s):
        pending += 1
        split_before = 0
        while pending:
            if not matched:
                at = i
            key = node * sigma + s[at]
            child = edges.get(key)
            if child is None:
                edges[key] = len(start)
                start.append(i)
                stop.append(n)
                link.append(0)
                if split_before:
                    link[split_before] = node
                    split_before = 0
            else:
                first = start[child]
                size = stop[child] - first
                if matched >= size:
                    node = child
                    at += size
                    matched -= size
                    continue
                if s[first + matched] == c:
                    matched += 1
                    if split_before:
                        link[split_before] = node
                    break
                inner = len(start)
                edges[key] = inner
                start += (first, i)
                stop += (first + matched, n)
                link += (0, 0)
                start[child] = first + matched
                edges[inner * sigma + c] = inner + 1
                edges[inner * sigma + s[first + matched]] = child
                if split_before:
                    link[split_before] = inner
                split_before = inner
            pending -= 1
            if node:
                node = link[node]
            elif matched:
                matched -= 1
                at = i - pending + 1
    return edges, start, stop


class SuffixTree:
    """The tree's leaves in tour order, and constant-time common extensions."""

    def __init__(self, s: list[int], sigma: int):
        """s: symbols from 1 to sigma - 1, with 0 as the last."""
        self.n = len(s)
        edges, start, stop = suffix_tree(s, sigma)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        kids = np.fromiter(edges.values(), np.int64, len(edges))
        order = np.argsort(keys)
        keys, kids = keys[order], kids[order]
        self.above = np.zeros(len(start), np.int64)
        self.above[kids] = keys // sigma
        self.size = (np.array(stop, np.int64) - np.array(start, np.int64)).tolist()
        self.leaf = (np.array(stop, np.int64) == self.n).tolist()
        bounds = np.searchsorted(keys, np.arange(len(start) + 1, dtype=np.int64) * sigma).tolist()
        kids = kids.tolist()
        self.kids = [kids[a:z] for a, z in zip(bounds, bounds[1:])]       # in order of their first symbols
        self.ends_here = np.zeros(len(start), bool)                       # a leaf by the last symbol
        self.ends_here[np.array(kids)[keys % sigma == 0]] = True
        self.places, self.leaves, least = self._tour()
        self.rank = self._ranked(self.places)
        self.tables = [least]
        step = 1
        while 2 * step <= len(least):
            last = self.tables[-1]
            self.tables.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def _ranked(self, places: np.ndarray) -> np.ndarray:
        rank = np.empty(self.n, np.int64)
        rank[places] = np.arange(self.n)
        return rank

    def _tour(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and node of each suffix in order, and the depth of the lowest
        common ancestor of each leaf and the one before it: the least depth
        between them on the tour."""
        kids, size, leaf, above, n = self.kids, self.size, self.leaf, self.above.tolist(), self.n
        depth = [0] * len(size)
        first = [False] * len(size)
        for below in kids:
            if below:
                first[below[0]] = True
        places, leaves, least, lowest = [], [], [], 0
        stack = kids[0][::-1]
        while stack:
            v = stack.pop()
            up = depth[above[v]]
            if not first[v]:
                lowest = up
            if leaf[v]:
                places.append(n - up - size[v])
                leaves.append(v)
                least.append(lowest)
            else:
                depth[v] = up + size[v]
                stack += kids[v][::-1]
        return np.array(places), np.array(leaves), np.array(least, np.int32)

    def reversed_rank(self) -> np.ndarray:
        """Ranks for the opposite order of the symbols, a prefix still before
        what it starts."""
        kids, leaf, ends, nodes = self.kids, self.leaf, self.ends_here.tolist(), []
        stack = [0]
        while stack:
            v = stack.pop()
            if leaf[v]:
                nodes.append(v)
            elif ends[kids[v][0]]:
                stack += kids[v][1:]
                stack.append(kids[v][0])
            else:
                stack += kids[v]
        place = np.zeros(len(leaf), np.int64)
        place[self.leaves] = self.places
        return self._ranked(place[np.array(nodes)])

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at i and j (i <> j)."""
        a, z = self.rank[i], self.rank[j]
        a, z = np.minimum(a, z) + 1, np.maximum(a, z) + 1
        level = np.frexp((z - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            here = level == k
            out[here] = np.minimum(self.tables[k][a[here]], self.tables[k][z[here] - (1 << int(k))])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each suffix the start of the next one that is smaller: the end of
    the longest Lyndon word that starts there."""
    r = rank.tolist()
    after = [0] * len(r)
    for i in range(len(r) - 2, -1, -1):
        j, own = i + 1, r[i]
        while r[j] > own:
            j = after[j]
        after[i] = j
    return np.array(after[:-1], np.int64)


def runs_of(s: list[int], min_length: int) -> np.ndarray:
    """All runs of a sequence of symbols >= 1: rows (start, length, period) by
    start, then period."""
    n = len(s)
    if n < max(min_length, 2):
        return np.empty((0, 3), np.int64)
    sigma = max(s) + 1
    forth = SuffixTree([*s, 0], sigma)
    place = np.arange(n)
    starts = np.concatenate([place, place])
    after = np.concatenate([next_smaller(forth.rank), next_smaller(forth.reversed_rank())])
    period = after - starts
    near = np.flatnonzero(2 * period <= n)
    starts, after, period = starts[near], after[near], period[near]
    right = forth.extension(starts, after)
    del forth
    back = SuffixTree([*s[::-1], 0], sigma)
    left = back.extension(n - starts, n - after)
    length = left + period + right
    good = (left + right >= period) & (length >= np.maximum(min_length, 2 * period))
    return np.unique(np.stack([starts[good] - left[good], length[good], period[good]], 1), axis=0)


def repeated_stretches(hashes: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal stretches [start, stop) of words that lie in ``width`` words
    which occur twice."""
    n = len(hashes) - width + 1
    if n < 2:
        return []
    gram = np.zeros(n, np.uint64)
    for k in range(width):
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + hashes[k:n + k]
    order = np.argsort(gram, kind="stable")
    same = gram[order][1:] == gram[order][:-1]
    if not same.any():
        return []
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, np.flatnonzero(twice), 1)
    np.add.at(change, np.flatnonzero(twice) + width, -1)
    inside = np.concatenate([[False], np.cumsum(change)[:-1] > 0, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def runs_of_texts(texts: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[np.ndarray]:
    """Runs of each list of words. The stretches that may hold runs form one
    sequence, each followed by a symbol of its own."""
    symbols: dict[bytes, int] = {}
    joined: list[int] = []
    at: list[tuple[int, int, int]] = []           # start in the sequence, text, start in the text
    width = max(min_length // 2, 1)
    for k, words in enumerate(texts):
        if len(words) < min_length:
            continue
        for a, z in repeated_stretches(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64), width):
            if z - a >= min_length:
                at.append((len(joined), k, a))
                joined += [symbols.setdefault(w, len(symbols) + 1) for w in words[a:z]]
                joined.append(0)
    if not at:
        return [np.empty((0, 3), np.int64)] * len(texts)
    whole = np.array(joined, np.int64)
    cuts = np.flatnonzero(whole == 0)
    whole[cuts] = len(symbols) + 1 + np.arange(len(cuts))
    found = runs_of(whole.tolist(), min_length)
    first, text, start = np.array(at, np.int64).T
    piece = np.searchsorted(first, found[:, 0], side="right") - 1
    out = []
    owner = text[piece]
    rows = np.stack([found[:, 0] - first[piece] + start[piece], found[:, 1], found[:, 2]], 1)
    for k in range(len(texts)):
        a, z = np.searchsorted(owner, [k, k + 1])
        own = rows[a:z]
        out.append(own[np.lexsort((own[:, 2], own[:, 0]))])
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()])


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_words, runs (start, length, period of
    each, by start, then period, in words from 0) and collapsed: the words,
    joined by single spaces, without those that a run holds after its first
    ``period`` words."""
    if min_length < 2:
        raise ValueError("min_length must be 2 or more")
    ship_code(docs.sparkSession)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches):
        for b in batches:
            for a, z in text_slices(b.column(1), TEXTS_PER_BATCH):
                ids = b.column(0).slice(a, z - a)
                # bytes.split() cuts at ASCII white space, which is what ends a word here
                texts = [(t or b"").split() for t in b.column(1).slice(a, z - a).cast(pa.binary()).to_pylist()]
                runs = runs_of_texts(texts, min_length)
                each = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
                flat = np.concatenate(runs) if runs else np.empty((0, 3), np.int64)
                fields = [pa.array(flat[:, c]) for c in range(3)]
                yield pa.record_batch([
                    ids, pa.array([len(t) for t in texts], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(each, pa.int32()), pa.StructArray.from_arrays(
                        fields, fields=list(run_type.value_type))),
                    pa.array([collapsed(t, r) for t, r in zip(texts, runs)], pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        work, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def with_planted_runs(text: Column, doc_id: Column) -> Column:
    """The query's texts: with h = crc32 of the decimal id and g = h div 10,
    every tenth document (by h) repeats p words from word a = g mod n to its
    end, p = 1 + (n - a) div (3 + g mod 8). Null ids are left as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    n = F.size(words).cast("long")
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    part = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(part, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
    new = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")
    return F.when((F.pmod(h, F.lit(10)) == 0) & text.rlike(WORDS), new).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document of ``documents`` with planted repeats: their
    number, the longest (ties: smallest start, then period), and digests of
    all runs and of the collapsed text."""
    docs = table(spark, sf_dir, "documents")
    text, doc_id = F.col("text").cast("string"), F.col("doc_id").cast("long")
    found = periodic_runs(docs.select(doc_id.alias("doc_id"), with_planted_runs(text, doc_id).alias("text")))
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast(
        "string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"),
                        F.when(F.size("runs") > 0, best).alias("best"),
                        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), (-F.col("best.l")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * -best.l div best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")
