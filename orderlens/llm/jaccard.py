"""N-gram Jaccard join by universe partitioning.

A document is its set of distinct word 5-grams, as 64-bit hashes. Two sets of
sizes s <= t with Jaccard 0.8 or more differ in (s + t) / 9 elements at most.
Sizes are cut into bands; for pairs whose smaller set is in a band, the
universe of hashes is cut into more segments than elements may differ, so that
some segment holds the same elements in both. A set is indexed by the
signatures of its non-empty segments, in its own band's cut and, if its
partners may be small enough, in the next lower band's.

1. Sets that are equal form one class; classes go on.
2. Signatures meet in hash buckets of bounded size. A signature that more than
   ``GROUP`` classes share is too dear to compare all with all and is left
   out. Two classes become a candidate if they share as many of the others
   as they must: the non-empty segments of either, less the elements that
   may differ, less its left-out ones. A class is settled if that is one or
   more.
3. Unsettled classes are matched among themselves with one-deletion
   neighbourhoods: each indexes its segments and its segments less one
   element, and asks for more than it needs, the cheapest (smallest) first; a
   segment that may be met with one element missing on either side counts
   twice. What it asks for beyond its need is, halved, the least number of
   answers that a similar class gives. Pairs that differ in more cells of the
   universe than similar sets may are not given.
4. What that leaves (mostly sets of widely shared elements) is matched among
   itself by the elements that are rarest there.

Every pair is verified exactly; pairs that verified links connect already
need no verification, as the result is components. Nothing is dropped.

Edge cases: null and empty texts, and texts without words, have no shingles
and are linked with nothing; texts of one to four words are one shingle;
repeated rows get a row each; rows with a null doc_id are in no component;
texts of any length are read whole; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm.components import components
from orderlens.llm.shared import ship_code, table, written
from orderlens.llm.wordbpe import gathered, word_keys

WORDS = 5
GROUP = 32
PAIRS = 4096
BUCKET_SIGNATURES = 300_000
BUCKET_DELETIONS = 1_000_000
CELLS = 512
COMMON = 100_000
BAND_RATIO = 1.75
_TEXT_BYTES = 4_000_000
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit mix, so that sums of mixed values tell sets apart."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# --- shingle sets ----------------------------------------------------------

def _sets(raw: np.ndarray, ends: np.ndarray, words: int) -> list[np.ndarray]:
    """Texts' bytes, each followed by a space, and where they end -> sorted
    distinct shingle hashes of each."""
    text = _LOWER[raw]
    space = _SPACES[text]
    edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1)))
    starts, stops = edge[::2], edge[1::2]
    out: list[np.ndarray] = []
    with np.errstate(over="ignore"):
        h = _mix(word_keys(text, starts, stops - starts))
        bounds = np.concatenate(([0], np.searchsorted(starts, ends)))
        n = max(0, len(h) - words + 1)
        grams = np.zeros(n, np.uint64)
        for k in range(words):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n]
        grams = _mix(grams)
        for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if z - a >= words:
                out.append(np.unique(grams[a:z - words + 1]))
            elif z > a:
                one = np.uint64(z - a)
                for x in h[a:z]:
                    one = one * np.uint64(0x9E3779B97F4A7C15) + x
                out.append(_mix(np.array([one ^ np.uint64(0x5555)])))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(texts: list[str | None], words: int = WORDS):
    """Texts -> their sets, a few megabytes of text at a time."""
    part, held = [], 0

    def flush():
        raw = np.frombuffer(b" ".join(part) + b" ", np.uint8)
        return _sets(raw, np.cumsum([len(p) + 1 for p in part]), words)

    for t in texts:
        part.append((t or "").encode())
        held += len(part[-1])
        if held > _TEXT_BYTES:
            yield from flush()
            part, held = [], 0
    if part:
        yield from flush()


def content(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set: a key of 62 bits and the rest."""
    d = hashlib.blake2b(s.astype("<u8").tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little") >> 2, int.from_bytes(d[8:], "little", signed=True)


# --- segments --------------------------------------------------------------

def _edges() -> np.ndarray:
    edges, x = [1], 1.0
    while edges[-1] < 1 << 40:
        x *= BAND_RATIO
        edges.append(max(edges[-1] + 1, int(np.ceil(x))))
    return np.array(edges, np.int64)


EDGES = _edges()
SEGMENTS = np.array([int(((z - 1) // 4 + 1) * 1.12) + 2 for z in EDGES[1:]], np.int64)


def roles(n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sizes -> [(which rows, band, signatures needed)] for a set's own band,
    and for the next lower one where partners reach down to it."""
    band = np.searchsorted(EDGES, n, side="right") - 1
    own = (n + n * 5 // 4) // 9 + 1
    low = EDGES[band] - 1
    down = np.flatnonzero((100 * low >= 80 * n) & (low > 0))
    return [(np.arange(len(n)), band, own), (down, band[down] - 1, (n[down] + low[down]) // 9 + 1)]


class Segments:
    """The segments of many sets, one after the other."""

    def __init__(self, flat: np.ndarray, count: np.ndarray, band: np.ndarray):
        self.set = np.repeat(np.arange(len(count)), count)
        with np.errstate(over="ignore"):
            m = SEGMENTS[band].astype(np.uint64)[self.set]
            self.of = ((flat >> np.uint64(32)) * m) >> np.uint64(32)
            first = np.ones(len(flat), bool)
            first[1:] = (self.of[1:] != self.of[:-1]) | (self.set[1:] != self.set[:-1])
            self.first = np.flatnonzero(first)
            self.size = np.diff(np.append(self.first, len(flat)))
            self.owner = self.set[self.first]
            self.element = _mix(flat ^ np.uint64(0xA5A5A5A5A5A5A5A5))
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.element)))
            self.sum = sums[self.first + self.size] - sums[self.first]
            self.place = _mix(band.astype(np.uint64)[self.owner] << np.uint64(40) | self.of[self.first])
            self.signature = _mix(self.sum + self.place)


def _bucketed(sig: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return ((sig >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), (sig & np.uint64(0xFFFFFFFF)).astype(np.uint32)


_ROWS = "bucket int, kind int, x binary, y binary"
# What the buckets give: STAR and PAIR: classes a and b share c signatures
# (STAR: a is the first of a group), NEAR: c left-out ones; SHARED: class a has
# the left-out signature b; LEFT: class a is not settled; SPARE: class a has b
# non-empty segments more than it needs, of c.
_OUT = "kind int, a long, b long, c long"
STAR, PAIR, NEAR, SHARED, LEFT, SPARE = 1, 2, 3, 4, 5, 6


def _row_batch(rows: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                           names=["bucket", "kind", "x", "y"])


def _scatter(sig: np.ndarray, d: np.ndarray, kind: int, buckets: int) -> list[tuple[int, int, bytes, bytes]]:
    """(signature, class) pairs -> a row for each bucket."""
    bucket, low = _bucketed(sig, buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, low, d = bucket[order], low[order], d[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    return [(int(bucket[a]), kind, low[a:z].tobytes(), d[a:z].tobytes())
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)]) if z > a]


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(keys)))


# Rows on the way to the buckets: signatures of classes (x: low 32 bits, y:
# class << 1 | lower band), the same where the task has found the signature
# shared by many, links, shared signatures, and how many signatures more than
# needed a class has.
# CELL: classes, and the size and cells of each.
SIGN, MANY, LINK, HELD, MORE, UNSETTLED, CELL = 0, 1, 2, 3, 4, 5, 6


def signature_rows(docs: DataFrame, buckets: int, words: int, group: int) -> DataFrame:
    """(text) -> rows for the buckets, combined per batch: classes met twice
    in a batch are sent once, and of a signature that more than ``group``
    classes of the batch share only one row is sent on."""
    def make(batches):
        for b in batches:
            flat, count, keys, seen = [], [], [], set()
            for s in shingle_sets(b.column(0).to_pylist(), words):
                if len(s):
                    key = content(s)[0]
                    if key not in seen:
                        seen.add(key)
                        flat.append(s)
                        count.append(len(s))
                        keys.append(key)
            if not keys:
                continue
            for a, z in _parts(count):
                yield _row_batch(rows_of(flat[a:z], np.array(count[a:z]), np.array(keys[a:z], np.int64)))

    def rows_of(flat, count, keys):
        flat = np.concatenate(flat)
        first = np.cumsum(count) - count
        sig, d, who, spare = [], [], [], []
        for lower, (which, band, need) in enumerate(roles(count)):
            if len(which):
                seg = Segments(gathered(flat, first[which], count[which]), count[which], band)
                sig.append(seg.signature)
                d.append(keys[which][seg.owner] << 1 | lower)
                who.append(keys[which] << 1 | lower)
                full = np.bincount(seg.owner, minlength=len(which))
                spare.append(np.stack((full - need, full), 1))
        sig, d = np.concatenate(sig), np.concatenate(d)
        order = np.lexsort((d, sig))
        sig, d = sig[order], d[order]
        at, size = _runs(sig)
        many = np.repeat(size > group, size)
        rows = _scatter(sig[~many], d[~many], SIGN, buckets)
        rows.append((int(keys[0] % buckets), MORE, np.concatenate(who).tobytes(), np.concatenate(spare).astype("<i8").tobytes()))
        if many.any():
            head = np.repeat(at, size)
            rest = many & (np.arange(len(sig)) != head)
            rows += _scatter(sig[at[size > group]], d[at[size > group]], MANY, buckets)
            bucket, low = _bucketed(sig[many], buckets)
            here = int(bucket[0])
            rows.append((here, HELD, d[many].tobytes(), (bucket << 32 | low).tobytes()))
            rows.append((here, LINK, d[head[rest]].tobytes(), d[rest].tobytes()))
        return rows

    return docs.select(F.col("text").cast("string")).mapInArrow(make, _ROWS)


def _parts(count: list[int], most: int = 1_500_000) -> list[tuple[int, int]]:
    """Cut rows of these sizes into parts of bounded total."""
    cuts = np.flatnonzero(np.diff(np.cumsum(count) // most)) + 1
    return [(a, z) for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(count)]) if z > a]


def _found(kinds: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    parts = [(np.full(len(a), k, np.int32), *(x.astype(np.int64) for x in (a, b, c))) for k, a, b, c in kinds if len(a)]
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int32), *[np.zeros(0, np.int64)] * 3]
    return pa.table(columns, names=["kind", "a", "b", "c"])


def _counted(kind: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple]:
    """Pairs, the smaller first, of different classes, and how often each
    occurs. Pairs met in both classes' lower band only are left out: one of
    two similar sets is in its own band."""
    if not parts:
        return []
    a, b = (np.concatenate(x) for x in zip(*parts))
    pairs = np.stack((np.minimum(a, b), np.maximum(a, b)), 1)
    pairs = pairs[((a >> 1) != (b >> 1)) & ((a & b & 1) == 0)]
    if not len(pairs):
        return []
    pairs, n = np.unique(pairs, axis=0, return_counts=True)
    return [(kind, pairs[:, 0], pairs[:, 1], n)]


def _table_rows(t: pa.Table):
    for bucket, kind, x, y in zip(*(t.column(c).to_pylist() for c in ("bucket", "kind", "x", "y"))):
        yield bucket, kind, x, y


def meet(group: int):
    """The work of one bucket of signatures."""
    def work(t: pa.Table) -> pa.Table:
        sig, d, flag, links, held, more = [], [], [], [], [], []
        bucket = 0
        for bucket, kind, x, y in _table_rows(t):
            if kind == MORE:
                more.append((np.frombuffer(x, np.int64), np.frombuffer(y, np.int64).reshape(-1, 2)))
            elif kind in (SIGN, MANY):
                sig.append(np.frombuffer(x, np.uint32))
                d.append(np.frombuffer(y, np.int64))
                flag.append(np.full(len(sig[-1]), kind == MANY))
            else:
                (held if kind == HELD else links).append((np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)))
        out = [(SHARED, *h, h[0]) for h in held] + [(SPARE, d, m[:, 0], m[:, 1]) for d, m in more]
        near, star, other = list(links), [], []
        if sig:
            sig, d, flag = np.concatenate(sig), np.concatenate(d), np.concatenate(flag)
            order = np.lexsort((~flag, d, sig))
            sig, d, flag = sig[order], d[order], flag[order]
            new = np.ones(len(sig), bool)
            new[1:] = (sig[1:] != sig[:-1]) | (d[1:] != d[:-1])
            # A class may come flagged from one batch and plain from another.
            sig, d, flag = sig[new], d[new], flag[new]
            at, size = _runs(sig)
            big = (np.add.reduceat(flag, at) > 0) | (size > group)
            for s in np.unique(size[~big & (size > 1)]).tolist():
                rows = d[at[~big & (size == s)][:, None] + np.arange(s)]
                i, j = np.triu_indices(s, 1)
                star.append((rows[:, i[i == 0]].ravel(), rows[:, j[i == 0]].ravel()))
                if s > 2:
                    other.append((rows[:, i[i > 0]].ravel(), rows[:, j[i > 0]].ravel()))
            if big.any():
                inside = np.repeat(big, size)
                head = np.repeat(at, size)
                near.append((d[head[inside]], d[inside]))
                out.append((SHARED, d[inside], np.int64(bucket) << 32 | sig[inside].astype(np.int64), d[inside]))
        return _found(out + _counted(STAR, star) + _counted(PAIR, other) + _counted(NEAR, near))

    return work


# --- one-deletion neighbourhoods -------------------------------------------

def cells(s: np.ndarray) -> np.ndarray:
    """The universe cut into ``CELLS`` cells, and of each whether a set has an
    odd number of its elements: as many words of 64 bits as hold them. An
    element in one of two sets only changes one cell, so that sets differ in at
    least as many elements as cells."""
    odd = np.bincount((_mix(s ^ np.uint64(0x3C3C3C3C3C3C3C3C)) % np.uint64(CELLS)).astype(np.int64), minlength=CELLS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def may_link(n: np.ndarray, cell: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the pairs (x, y) of sets with these sizes and cells may differ
    in so few elements as similar sets do; similar ones always may."""
    differ = np.maximum(np.bitwise_count(cell[x] ^ cell[y]).sum(axis=1, dtype=np.int64), np.abs(n[x] - n[y]))
    return 9 * differ <= n[x] + n[y]


def deletion_rows(sets: DataFrame, signature_buckets: int, buckets: int) -> DataFrame:
    """(dk, sh, shared, c), shared as of so many buckets of signatures -> rows
    for the buckets from the classes whose other
    signatures are too few: SIGN rows with y = class << 1 | asks, component c,
    a CELL row for the classes of a bucket, and LEFT rows for classes that
    cannot be settled this way."""
    step = np.uint64(0x1357), np.uint64(0x2468)

    def make(batches):
        for b in batches:
            rows, sig, d, keys, cell = [], [], [], [], []
            for key, sh, shared, c in zip(*(b.column(i).to_pylist() for i in range(4))):
                s = np.frombuffer(sh, "<u8")
                shared = np.array(shared, np.int64)
                n = np.array([len(s)])
                answers = []
                for which, band, need in roles(n):
                    if not len(which):
                        continue
                    seg = Segments(s, n, band)
                    bucket, low = _bucketed(seg.signature, signature_buckets)
                    free = ~np.isin(bucket << 32 | low, shared)
                    short = int(need[0]) - int(free.sum())
                    if short <= 0:
                        continue
                    with np.errstate(over="ignore"):
                        exact = _mix(seg.signature ^ step[0])
                        over = seg.size > 1
                        less = np.repeat(seg.sum + seg.place, seg.size) - seg.element
                        less = less[np.repeat(over, seg.size)]
                        sig += [exact, _mix(_mix(less) ^ step[1])]                       # what it offers
                        d.append(np.tile((key << 1, c), (len(exact) + len(less), 1)))
                        twice = np.flatnonzero(free & over)
                        twice = twice[np.argsort(seg.size[twice], kind="stable")][:short + int(need[0]) // 2]
                        answers.append((len(twice) - short + 2) // 2 if len(twice) >= short else 0)
                        chosen = np.isin(np.arange(len(exact)), twice)
                        gone = less[np.repeat(chosen[over], seg.size[over])]
                        asks = [exact[free], _mix(seg.signature[chosen] ^ step[1]), _mix(_mix(gone) ^ step[0])]
                        sig += asks
                        d.append(np.tile((key << 1 | 1, c), (sum(map(len, asks)), 1)))
                if answers:
                    keys.append(key)
                    cell.append(np.concatenate((n, cells(s).view(np.int64))))
                    rows.append((key % buckets, MORE if min(answers) else UNSETTLED, np.array([key]).tobytes(), np.array([min(answers)]).tobytes()))
            if sig:
                sig, d = np.concatenate(sig), np.concatenate(d)
                rows += _scatter(sig, d, SIGN, buckets)
                keys, cell = np.array(keys), np.stack(cell)
                order = np.argsort(keys)
                keys, cell = keys[order], cell[order]
                there = np.unique(_bucketed(sig, buckets)[0] * len(keys) + np.searchsorted(keys, d[:, 0] >> 1))
                at, size = _runs(there // len(keys))
                for a, z in zip(at.tolist(), (at + size).tolist()):
                    i = there[a:z] % len(keys)
                    rows.append((int(there[a] // len(keys)), CELL, keys[i].tobytes(), cell[i].tobytes()))
            yield _row_batch(rows)

    return sets.mapInArrow(make, _ROWS)


def meet_deletions(pairs: int):
    """The work of one bucket of offers and requests. Pairs that differ in too
    many cells to be similar are not given."""
    def work(t: pa.Table) -> pa.Table:
        sig, d, left, more, keys, cell = [], [], [], [np.zeros((0, 2), np.int64)], [], []
        for _, kind, x, y in _table_rows(t):
            if kind == SIGN:
                sig.append(np.frombuffer(x, np.uint32))
                d.append(np.frombuffer(y, np.int64))
            elif kind == CELL:
                keys.append(np.frombuffer(x, np.int64))
                cell.append(np.frombuffer(y, np.int64).reshape(len(keys[-1]), -1))
            elif kind == MORE:
                more.append(np.stack((np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)), 1))
            else:
                left.append(np.frombuffer(x, np.int64))
        other = []
        if sig:
            sig, d = np.concatenate(sig), np.concatenate(d).reshape(-1, 2)
            order = np.lexsort((d[:, 0], sig))
            sig, d, c = sig[order], d[order, 0], d[order, 1]
            new = np.ones(len(sig), bool)
            new[1:] = (sig[1:] != sig[:-1]) | (d[1:] != d[:-1])
            sig, d, c = sig[new], d[new], c[new]
            keys, first = np.unique(np.concatenate(keys), return_index=True)
            cell = np.concatenate(cell)[first]
            n, cell, own = cell[:, 0], np.ascontiguousarray(cell[:, 1:]).view(np.uint64), np.searchsorted(keys, d >> 1)
            at, size = _runs(sig)
            asks = np.add.reduceat(d & 1, at)
            mixed = np.minimum.reduceat(c, at) != np.maximum.reduceat(c, at)       # not of one component yet
            for i in np.flatnonzero((asks > 0) & (asks < size) & mixed).tolist():
                run, of = d[at[i]:at[i] + size[i]], c[at[i]:at[i] + size[i]]
                ask, offer = np.flatnonzero(run & 1), np.flatnonzero((run & 1) == 0)
                of_ask, n_ask = np.unique(of[ask], return_counts=True)
                of_offer, n_offer = np.unique(of[offer], return_counts=True)
                _, i1, i2 = np.intersect1d(of_ask, of_offer, return_indices=True)
                if len(ask) * len(offer) - int((n_ask[i1] * n_offer[i2]).sum()) > pairs:
                    left.append(run[ask] >> 1)
                else:
                    x, y = np.nonzero(of[ask][:, None] != of[offer][None, :])
                    may = may_link(n, cell, own[at[i] + ask[x]], own[at[i] + offer[y]])
                    other.append((run[ask[x[may]]] & ~1, run[offer[y[may]]]))
        gone = np.unique(np.concatenate(left)) if left else np.zeros(0, np.int64)
        more = np.concatenate(more)
        return _found([(LEFT, gone, gone, gone), (SPARE, more[:, 0], more[:, 1], more[:, 1]), *_counted(PAIR, other)])

    return work


# --- Spark -----------------------------------------------------------------

def described(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, text) -> doc_id, text_hash, n, dk, dr: size and content of the
    set."""
    def make(batches):
        for b in batches:
            sets = [(len(s), *content(s)) for s in shingle_sets(b.column(1).to_pylist(), words)]
            yield pa.record_batch([b.column(0), b.column(2), *(pa.array([s[i] for s in sets], pa.int64()) for i in range(3))],
                                  names=["doc_id", "text_hash", "n", "dk", "dr"])

    text = F.col("text").cast("string")
    return (docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text))
            .mapInArrow(make, "doc_id long, text_hash long, n long, dk long, dr long"))


def sets_of(docs: DataFrame, classes: DataFrame, keys: DataFrame, words: int) -> DataFrame:
    """The sets of these classes (dk): dk, dr, rep, n, sh."""
    wanted = classes.join(keys, "dk").select("dk", "dr", "rep")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = rows.join(wanted, rows["doc_id"] == wanted["rep"]).select("dk", "dr", "rep", "text")

    def make(batches):
        for b in batches:
            sets = list(shingle_sets(b.column(3).to_pylist(), words))
            same = [content(s) == (k, r) for s, k, r in zip(sets, b.column(0).to_pylist(), b.column(1).to_pylist())]
            out = [b.column(i) for i in range(3)]
            out += [pa.array([len(s) for s in sets], pa.int64()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())]
            yield pa.record_batch(out, names=["dk", "dr", "rep", "n", "sh"]).filter(pa.array(same))

    # Two rows with one doc_id and equal text would give a set twice.
    return (joined.mapInArrow(make, "dk long, dr long, rep long, n long, sh binary")
            .dropDuplicates(["dk", "dr"]))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of classes (a, b) -> links (a, b) of their first documents."""
    one = sets.select(F.col("dk").alias("a"), F.col("rep").alias("ra"), F.col("n").alias("na"), F.col("sh").alias("sa"))
    two = sets.select(F.col("dk").alias("b"), F.col("rep").alias("rb"), F.col("n").alias("nb"), F.col("sh").alias("sb"))
    both = (pairs.select("a", "b").join(one, "a").join(two, "b")
            .filter("100 * least(na, nb) >= 80 * greatest(na, nb)").select("ra", "rb", "sa", "sb"))

    def check(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                same = len(x) + len(y) - len(np.unique(np.concatenate((x, y))))
                keep.append(100 * same >= 80 * (len(x) + len(y) - same))
            yield pa.record_batch([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(check, "a long, b long")


def rare_pairs(left: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of classes (a, b) of different components among ``left`` (dk)
    that share one of their rarest elements there (as many as may be missing,
    and one more) so early that what follows may be enough.

    The order: elements that one component alone has there (no such pair
    shares them), then the others, the rarest first. The commonest, fewer than
    ``COMMON``, are known to every task, so that of a set only those that may
    still be among its rarest are moved."""
    def elements(batches):
        for b in batches:
            sets_ = [np.frombuffer(x, "<i8") for x in b.column(2).to_pylist()]
            if sets_:
                of = pa.array(np.repeat(np.arange(len(sets_)), [len(s) for s in sets_]))
                yield pa.record_batch([b.column(0).take(of), b.column(1).take(of), pa.array(np.concatenate(sets_))], names=["dk", "c", "e"])

    own = sets.join(left, "dk").join(labels, "dk", "left").select("dk", F.coalesce("c", "rep").alias("c"), "n", "sh")
    often = written(own.select("dk", "c", "sh").mapInArrow(elements, "dk long, c long, e long").groupBy("e")
                    .agg(F.count("*").alias("f"), F.min("dk").alias("dk"), (F.min("c") < F.max("c")).alias("mixed")), "often")
    # A class with more elements of its own than a similar one may lack is done with.
    alone = often.filter("f = 1").groupBy("dk").agg(F.count("*").alias("u"))
    some = own.join(alone, "dk", "left").withColumn("u", F.coalesce("u", F.lit(0).cast("long"))).filter("u <= n div 5")
    bound = max(1, (often.agg(F.sum("f")).first()[0] or 0) // COMMON)
    known = often.sparkSession.sparkContext.broadcast(_ranked(often.filter(F.col("f") > bound).select("e", "f", "mixed").toArrow()))
    rows = written(some.select("dk", "c", "n", "u", "sh").mapInArrow(lambda batches: _early(batches, *known.value), _EARLY), "elements")
    less = rows.filter("h < 0").join(often.filter(F.col("f").between(2, bound)).select("e", "f", "mixed"), "e")
    more = rows.filter("h >= 0").withColumns({"f": F.lit(0).cast("long"), "mixed": F.lit(True)})
    rank = F.row_number().over(Window.partitionBy("dk").orderBy("mixed", "h", "f", "e"))
    marked = written(less.unionByName(more).withColumn("r", F.col("u") + rank)
                     .filter("r <= n div 5 + 1 AND mixed").select("dk", "c", "n", "r", "e"), "prefix")
    # Elements that meet in one component only are done with.
    mixed = written(marked.groupBy("e").agg(F.min("c").alias("c1"), F.max("c").alias("c2")).filter("c1 < c2").select("e"), "mixed")
    # Of the first element that two share, the rest of either holds all others:
    # so many that the other one has ``most`` elements at most. The smaller one
    # looks among the sizes from its own to that.
    there = written(marked.join(mixed, "e").withColumn("most", F.expr("9 * (1 + n - r) div 4 - n")), "there")
    small = (there.filter("most >= n").withColumn("size", F.explode(F.sequence(_size_band("n"), _size_band("most"))))
             .select("e", "size", F.col("dk").alias("a"), "c", "n", "most"))
    large = there.select("e", _size_band("n").alias("size"), F.col("dk").alias("b"), F.col("c").alias("c2"),
                         F.col("n").alias("n2"), F.col("most").alias("most2"))
    return (small.join(large, ["e", "size"])
            .filter("c <> c2 AND n2 <= most AND n <= most2 AND (n < n2 OR n = n2 AND a < b)")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


_EARLY = "dk long, c long, n long, u long, e long, h long"


def _ranked(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(e, f, mixed) -> elements in ascending order, and of each whether it is
    mixed and its place by frequency."""
    e, f, mixed = (t.column(c).to_numpy() for c in ("e", "f", "mixed"))
    place = np.empty(len(e), np.int64)
    place[np.lexsort((e, f))] = np.arange(len(e))
    order = np.argsort(e)
    return e[order], mixed[order].astype(bool), place[order]


def _early(batches, common: np.ndarray, mixed: np.ndarray, place: np.ndarray):
    """Sets (dk, c, n, u, sh) -> the elements that may be among their rarest:
    those not common (h = -1), and as many mixed common ones (h: their place) as
    fit behind the ``u`` elements that are a component's own, common ones now
    included."""
    for b in batches:
        out = []
        for dk, c, n, u, sh in zip(*(b.column(i).to_pylist() for i in range(5))):
            s = np.frombuffer(sh, "<i8")
            at = np.minimum(np.searchsorted(common, s), max(0, len(common) - 1))
            known = common[at] == s if len(common) else np.zeros(len(s), bool)
            u += int((~mixed[at[known]]).sum())
            if u > n // 5:
                continue
            h = np.full(len(s), -1)
            h[known] = np.where(mixed[at[known]], place[at[known]], -2)
            late = np.sort(h[h >= 0])[n // 5 + 1 - u:]
            keep = (h == -1) | ((h >= 0) & (h < late[0] if len(late) else h >= 0))
            out.append((s[keep], h[keep], (dk, c, n, u)))
        if out:
            count = [len(s) for s, _, _ in out]
            head = np.repeat(np.array([x for _, _, x in out], np.int64), count, axis=0)
            columns = [*head.T, np.concatenate([s for s, _, _ in out]), np.concatenate([h for _, h, _ in out])]
            yield pa.record_batch([pa.array(x, pa.int64()) for x in columns], names=["dk", "c", "n", "u", "e", "h"])


def _size_band(n: str) -> Column:
    """Sizes in bands some 4 % wide, so that few sizes meet at one element."""
    return F.floor(F.log(F.col(n).cast("double")) * 25).cast("int")


def jaccard_components(docs: DataFrame, words: int = WORDS, group: int = GROUP, pairs: int = PAIRS) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_shingles, component_id, text_hash."""
    ship_code(docs.sparkSession)
    members = written(described(docs, words), "members")
    real = members.filter("n > 0 AND doc_id IS NOT NULL")
    classes = written(real.groupBy("dk", "dr", "n").agg(F.min("doc_id").alias("rep")), "classes")
    size = classes.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, int(size * 0.5) // BUCKET_SIGNATURES + 1)

    found = written(signature_rows(docs.filter("doc_id IS NOT NULL"), buckets, words, group)
                    .groupBy("bucket").applyInArrow(meet(group), _OUT), "found")
    shared = found.filter(F.col("kind") == SHARED).groupBy("a").agg(F.collect_set("b").alias("shared"))   # a set's own
    # What a class must share with a similar one, of the signatures not left out.
    must = written(found.filter(F.col("kind") == SPARE).groupBy("a").agg(F.min("b").alias("spare"), F.max("c").alias("full"))
                   .join(shared, "a", "left").withColumn("must", F.col("spare") + 1 - F.greatest(F.size("shared"), F.lit(0)))
                   .withColumn("shared", F.when(F.col("must") < 1, F.col("shared"))), "must")
    pairs_met = found.filter(F.col("kind") <= NEAR).withColumn("near", F.col("kind") == NEAR).groupBy("a", "b", "near").agg(
        F.min("kind").alias("kind"), F.sum("c").alias("c"))
    one, two = (must.select(F.col("a").alias(k), F.col("must").alias(f"must_{k}"), F.col("full").alias(f"full_{k}")) for k in "ab")
    # Left-out signatures prove nothing, but classes that share a fifth of all
    # are likely links, and links found early save later work.
    enough = F.when(F.col("near"), 5 * F.col("c") >= F.least("full_a", "full_b")).otherwise(
        F.col("c") >= F.greatest("must_a", "must_b"))
    candidates = written(pairs_met.join(one, "a").join(two, "b").filter(enough)
                         .groupBy(F.shiftright("a", 1).alias("a"), F.shiftright("b", 1).alias("b"))
                         .agg(F.min(F.when(F.col("near"), F.lit(STAR)).otherwise(F.col("kind"))).alias("kind")), "candidates")
    shared = written(must.filter("must < 1").groupBy(F.shiftright("a", 1).alias("dk"))
                     .agg(F.flatten(F.collect_list("shared")).alias("shared")), "shared")
    keys = (candidates.select(F.explode(F.array("a", "b")).alias("dk")).unionByName(shared.select("dk"))).distinct()
    sets = written(sets_of(docs, classes, keys, words), "sets")

    # Classes whose keys agree by chance are compared too (key for key they would be one class).
    twins = classes.groupBy("dk").agg(F.count("*").alias("k")).filter("k > 1")
    if not twins.isEmpty():
        sets = written(sets.unionByName(sets_of(docs, classes, twins.select("dk"), words)).dropDuplicates(["dk", "dr"]), "sets")
        candidates = written(candidates.unionByName(twins.select(F.col("dk").alias("a"), F.col("dk").alias("b"), F.lit(PAIR).alias("kind"))), "candidates")

    links = written(verified(candidates.filter(F.col("kind") == STAR), sets), "links")
    label = _labels(links, sets)
    links = links.unionByName(written(verified(_across(candidates.filter(F.col("kind") == PAIR), label), sets), "links"))

    if not shared.isEmpty():
        label = _labels(links, sets)
        asking = (sets.join(shared, "dk").join(label, "dk", "left")
                  .select("dk", "sh", "shared", F.coalesce("c", "rep").alias("c")))
        asked = asking.agg(F.sum(F.octet_length("sh"))).first()[0] or 0         # 8 bytes an element, some 5 signatures
        near = written(deletion_rows(asking, buckets, asked * 5 // 8 // BUCKET_DELETIONS + 1).groupBy("bucket").applyInArrow(meet_deletions(pairs), _OUT), "near")
        left = written(near.filter(F.col("kind") == LEFT).select(F.col("a").alias("dk")).distinct(), "left")
        # Answers that a settled class must get, and that an unsettled one may.
        least = (near.filter(F.col("kind") == SPARE).groupBy(F.col("a").alias("dk")).agg(F.min("b").alias("must"))
                 .join(left, "dk", "left_anti"))
        one, two = (least.select(F.col("dk").alias(k), F.col("must").alias(f"must_{k}")) for k in "ab")
        more = (near.filter(F.col("kind") == PAIR)
                .groupBy(F.shiftright("a", 1).alias("a"), F.shiftright("b", 1).alias("b")).agg(F.sum("c").alias("c"))
                .join(one, "a", "left").join(two, "b", "left")
                .filter(F.col("c") >= F.coalesce("must_a", F.lit(0)) + F.coalesce("must_b", F.lit(0))).select("a", "b"))
        links = written(links.unionByName(verified(more, sets)), "links")
        if not left.isEmpty():
            links = links.unionByName(written(verified(rare_pairs(left, sets, _labels(links, sets)), sets), "links"))

    part = components(links)
    by_class = written(classes.join(part, classes["rep"] == part["node"], "left")
                       .select("dk", "dr", "n", F.coalesce("component", "rep").alias("component_id")), "by_class")
    rows = members.join(by_class, ["dk", "dr", "n"], "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"),
                       F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"), "text_hash")


def _labels(links: DataFrame, sets: DataFrame) -> DataFrame:
    """Components so far, by class: dk, c (classes without links are absent)."""
    part = components(links)
    return written(sets.join(part, sets["rep"] == part["node"]).select("dk", F.col("component").alias("c")).dropDuplicates(["dk"]), "labels")


def _across(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs (a, b) that no links connect yet."""
    one, two = label.select(F.col("dk").alias("a"), F.col("c").alias("c1")), label.select(F.col("dk").alias("b"), F.col("c").alias("c2"))
    return (pairs.select("a", "b").join(one, "a", "left").join(two, "b", "left")
            .filter("c1 IS NULL OR c2 IS NULL OR c1 <> c2").select("a", "b"))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).drop("text_hash")


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(list_slice(w, i, i + 4), ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM w WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), same AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM same JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(reach.b) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id
GROUP BY d.doc_id, n.n
"""
