"""Byte-level BPE of whole texts, one vocabulary word at a time.

The tokenizer splits a text into words (a leading space, then letters,
digits or other signs; contractions; white space) and merges inside a word
only. Words repeat, so a task splits whole batches of texts with numpy,
hashes the words, and asks for the ids of words it has not met yet. Where
the ids of a new word come from is the caller's choice (``resolve``):
the tokenizers library itself (``LibraryResolver``), or the lexicon of
``lexicon.py``.

Documents that hold a special token's text, or a code point that this
Python's Unicode tables do not assign, are given to the library whole.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable, Iterable

import numpy as np

VOCABULARY = "byte_bpe_50k.json"
SPECIAL = "<|endoftext|>"
# Classes of code points.
OTHER, LETTER, NUMBER, SPACE, END, UNSURE = range(6)
_END_CHAR = 0x110000
_CHUNK_CHARS = 2_000_000
# Words longer than this are encoded on their own: the hash below is only
# relied on for short words.
MAX_WORD = 64
MAX_CACHED_WORDS = 600_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@functools.cache
def library(path: str):
    """The tokenizers library on one vocabulary file, without truncation
    or padding, and on this task's own thread."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@functools.cache
def _classes() -> np.ndarray:
    table = np.zeros(_END_CHAR + 1, np.uint8)
    for c in range(_END_CHAR):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L":
            table[c] = LETTER
        elif kind[0] == "N":
            table[c] = NUMBER
        elif kind in ("Cn", "Cs"):
            table[c] = UNSURE
        if chr(c).isspace() and not 0x1C <= c <= 0x1F:
            table[c] = SPACE
    table[_END_CHAR] = END
    return table


@functools.cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.full(size, base, np.uint64)
        up[0] = 1
        down = np.full(size, inverse, np.uint64)
        down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def word_starts(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """True where a word starts. ``points``: code points of texts, each
    followed by the end mark."""
    start = np.empty(len(points), bool)
    start[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=start[1:])
    start |= kinds == END
    # White space before something else: its last character stands alone, or
    # goes with what follows if it is a plain space.
    last = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] != SPACE) & (kinds[1:] != END))
    start[last] = True
    start[last[points[last] == 0x20] + 1] = False
    # Contractions: an apostrophe that starts a word, then certain letters.
    apo = np.flatnonzero((points == 0x27) & start)
    if len(apo):
        padded = np.append(points, [_END_CHAR, _END_CHAR])
        a, b = padded[apo + 1], padded[apo + 2]
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
        two = ((a == 0x72) & (b == 0x65)) | ((a == 0x76) & (b == 0x65)) | ((a == 0x6C) & (b == 0x6C))
        hit = one | two
        start[apo[hit] + 1] = False
        start[apo[hit] + np.where(one[hit], 2, 3)] = True
    return start


def word_keys(points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of words (sums of powers along the array, so that equal
    words have equal hashes wherever they stand)."""
    up, down = _powers(max(1 << 21, 1 << int(len(points)).bit_length()))
    with np.errstate(over="ignore"):
        mixed = points.astype(np.uint64)
        mixed += np.uint64(0x51ED27)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        mixed *= up[:len(points)]
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(mixed, out=sums[1:])
        keys = sums[starts + lengths] - sums[starts]
        keys *= down[starts]
        keys ^= lengths.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    return keys


class Words:
    """Words as slices of an array of code points."""

    def __init__(self, points: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.points, self.starts, self.lengths = points, starts, lengths

    def __len__(self) -> int:
        return len(self.starts)

    def text(self, i: int) -> str:
        return self.points[self.starts[i]:self.starts[i] + self.lengths[i]].tobytes().decode("utf-32-le")

    def joined(self, which: np.ndarray) -> str:
        """These words in one string, each followed by a line end."""
        sizes = self.lengths[which] + 1
        upto = np.cumsum(sizes)
        spot = np.repeat(self.starts[which] - (upto - sizes), sizes) + np.arange(upto[-1])
        spot[upto - 1] = 0
        out = self.points[spot]
        out[upto - 1] = 0x0A
        return out.tobytes().decode("utf-32-le")


class LibraryResolver:
    """Ids of words by the tokenizers library: (all ids, ids per word).

    Words are joined by line ends, so that one call encodes many; words of
    white space are encoded one by one.
    """

    def __init__(self, path: str):
        self.tokenizer = library(path)
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids

    def alone(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        last = _classes()[words.points[words.starts + words.lengths - 1]]
        space = (last == SPACE) if len(self.line_end) == 1 else np.ones(len(words), bool)
        order, ids, counts = [], [], []
        plain = np.flatnonzero(~space)
        for at in range(0, len(plain), 8192):
            part = plain[at:at + 8192]
            got = np.array(self.tokenizer.encode_batch_fast(
                [words.joined(part)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(got == self.line_end[0])
            assert len(ends) == len(part)
            order.append(part)
            ids.append(np.delete(got, ends))
            counts.append(np.diff(np.append(-1, ends)) - 1)
        if space.any():
            part = np.flatnonzero(space)
            got = self.alone([words.text(i) for i in part.tolist()])
            order.append(part)
            ids.extend(got)
            counts.append(np.array([len(x) for x in got], np.int64))
        return in_order(np.concatenate(order), np.concatenate(ids), np.concatenate(counts))


def in_order(order: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ids that stand for the words ``order`` -> rows of words 0, 1, ..."""
    first = np.cumsum(counts) - counts
    back = np.argsort(order, kind="stable")
    return gathered(ids, first[back], counts[back]), counts[back]


def gathered(flat: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The slices flat[first:first + count], one after the other."""
    upto = np.cumsum(count)
    total = int(upto[-1]) if len(upto) else 0
    return flat[np.repeat(first - (upto - count), count) + np.arange(total)]


class WordEncoder:
    """encode(texts) -> (ids of all texts as one uint32 array, ids per text).

    Keeps the ids of up to MAX_CACHED_WORDS words, then starts afresh: the
    cache bounds memory and changes no result.
    """

    def __init__(self, path: str, resolve: Callable[[Words], tuple[np.ndarray, np.ndarray]] | None = None):
        self.path = path
        self.resolve = resolve or LibraryResolver(path)
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)          # sorted
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _store(self, ids: np.ndarray) -> int:
        at = self.used
        while at + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.flat[at:at + len(ids)] = ids
        self.used += len(ids)
        return at

    def _chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        end = (_END_CHAR).to_bytes(4, "little")
        points = np.frombuffer(b"".join(x for t in texts for x in (t.encode("utf-32-le"), end)), np.uint32)
        kinds = _classes()[points]
        bounds = np.flatnonzero(kinds == END)
        odd = set(np.searchsorted(bounds, np.flatnonzero(kinds == UNSURE)).tolist())
        odd |= {i for i, t in enumerate(texts) if SPECIAL in t}
        if odd:
            whole = {i: np.array(e.ids, np.uint32) for i, e in zip(sorted(odd), library(self.path).encode_batch_fast(
                [texts[i] for i in sorted(odd)], add_special_tokens=False))}
            ids, counts = self._chunk([("" if i in odd else t) for i, t in enumerate(texts)])
            parts = [whole.get(i, p) for i, p in enumerate(np.split(ids, np.cumsum(counts)[:-1]))]
            return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        starts = np.flatnonzero(word_starts(points, kinds))
        lengths = np.diff(np.append(starts, len(points)))
        real = kinds[starts] != END
        words, lengths = starts[real], lengths[real]
        keys = word_keys(points, words, lengths)
        long = lengths > MAX_WORD
        keys[long] = np.arange(int(long.sum()), dtype=np.uint64)      # of their own, never kept
        distinct, at, which = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > MAX_CACHED_WORDS:
            self._clear()
        keep = ~long[at]
        spot = np.searchsorted(self.keys, distinct)
        hit = np.zeros(len(distinct), bool)
        inside = spot < len(self.keys)
        hit[inside] = self.keys[spot[inside]] == distinct[inside]
        hit &= keep
        first, count = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        first[hit], count[hit] = self.first[spot[hit]], self.count[spot[hit]]
        new = np.flatnonzero(~hit)
        flat = self.flat
        if len(new):
            ids, counts = self.resolve(Words(points, words[at[new]], lengths[at[new]]))
            base = self._store(ids)
            flat = self.flat
            first[new], count[new] = base + np.cumsum(counts) - counts, counts
            kept = new[keep[new]]
            self.keys = np.concatenate((self.keys, distinct[kept]))
            order = np.argsort(self.keys, kind="stable")
            self.keys = self.keys[order]
            self.first = np.concatenate((self.first, first[kept]))[order]
            self.count = np.concatenate((self.count, count[kept]))[order]
        size = count[which]
        ids = gathered(flat, first[which], size)
        before = np.concatenate(([0], np.cumsum(size)))[np.searchsorted(words, bounds)]
        if self.used > 16 * MAX_CACHED_WORDS:
            self._clear()
        return ids, np.diff(np.concatenate(([0], before)))

    def encode(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Texts (null: empty) -> all ids in a row, and the number per text."""
        ids, counts, part, held = [], [], [], 0

        def flush():
            a, b = self._chunk(part)
            ids.append(a)
            counts.append(b)

        for t in texts:
            t = t or ""
            part.append(t)
            held += len(t) + 1
            if held >= _CHUNK_CHARS:
                flush()
                part, held = [], 0
        if part:
            flush()
        if not counts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate(ids), np.concatenate(counts)


@functools.cache
def encoder(path: str) -> WordEncoder:
    """One per Python worker."""
    return WordEncoder(path)


def word_spans(texts: Iterable[str | None]):
    """Texts -> (distinct words of up to MAX_WORD characters, how often each
    occurs), one pair per chunk of texts."""
    part, held = [], 0

    def chunk():
        end = (_END_CHAR).to_bytes(4, "little")
        points = np.frombuffer(b"".join(x for t in part for x in (t.encode("utf-32-le"), end)), np.uint32)
        kinds = _classes()[points]
        starts = np.flatnonzero(word_starts(points, kinds))
        lengths = np.diff(np.append(starts, len(points)))
        real = (kinds[starts] != END) & (lengths <= MAX_WORD)
        starts, lengths = starts[real], lengths[real]
        _, at, n = np.unique(word_keys(points, starts, lengths), return_index=True, return_counts=True)
        return Words(points, starts[at], lengths[at]), n

    for t in texts:
        t = t or ""
        part.append(t)
        held += len(t) + 1
        if held >= _CHUNK_CHARS:
            yield chunk()
            part, held = [], 0
    if part:
        yield chunk()
