"""Secret scans: fixed patterns and a battery of randomness tests.

The patterns are assignments of a secret to a name, access keys and long hex
strings. Beside them, tokens whose alphabet is that of an encoding (hex, base32,
base36, base64, UUID) get a battery of tests: chi-squared uniformity of the
alphabet, too few runs of its classes (capitals, small letters, digits), and
lag-1 serial correlation, which also finds alternation. Their p-values, combined by Fisher's method, are the token's score,
which is high if its symbols look random.

The hypothesis is "patterned", so that what is bounded is the share of patterned
tokens among those reported. The null model of an encoding: the class of a
symbol stays the same with probability ``STAY`` and otherwise changes to another
class of the encoding; a letter is drawn by its frequency in English, a digit
evenly; a token has all classes that the encoding asks for. ``null_levels``
draws ``DRAWS`` tokens of that model with a fixed seed; a token's p-value is the
share of them that score as high as it does. Tokens of equal encoding and
similar length (``BANDS`` a doubling) are one family, compared with null tokens
of the band's least length; in each family the Benjamini-Hochberg step-up at
``ALPHA`` finds the tokens reported as ``random``. No length of ``MIN_ASSIGN`` or
more is ruled out: the shorter a family's tokens are, the more null tokens score
as high, and the fewer are found. Scores are rounded to a grid of eighths
of powers of two, so that a family is a small table of counts, whatever the
input. Patterned tokens that change class more often than the model's are not
covered by the bound.

Two passes over the texts: the first gathers the families' counts, the second
finds the spans (and blanks them out, in ``redacted``). Nothing is joined to
the texts.

Edge cases: a null or empty text has no spans; texts of any length are
scanned whole; repeated rows are scanned each; an empty table gives no rows;
further columns are ignored by ``secret_spans`` and kept by ``redacted``.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.shared import ship_code, table

# The patterns, and the least length of a match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_ASSIGN = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
MIN_ACCESS = 16
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "random")

TOKEN = re.compile(r"[A-Za-z0-9+/_-]{%d,}" % MIN_ASSIGN)
_BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_VALUES = {"hex": np.full(128, -1), "base32": np.full(128, -1), "base36": np.full(128, -1), "base64": np.full(128, -1)}
for _name, _letters in (("hex", "0123456789abcdef"), ("hex", "0123456789ABCDEF"),
                        ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), ("base32", "abcdefghijklmnopqrstuvwxyz234567"),
                        ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"), ("base36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("base64", _BASE64), ("base64", _BASE64[:-2] + "-_")):
    for _i, _c in enumerate(_letters):
        _VALUES[_name][ord(_c)] = _i
_VALUES["uuid"] = _VALUES["hex"]
_SIZE = {"hex": 16, "uuid": 16, "base32": 32, "base36": 36, "base64": 64}
UUID = re.compile("[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
# Letters of English text, per ten thousand, a to z.
LETTERS = (817, 149, 278, 425, 1270, 223, 202, 609, 697, 15, 77, 403, 241, 675, 751, 193, 10, 599, 633, 906, 276, 98, 236, 15, 197, 7)
# The classes of each encoding's values, in order: (kind of symbol, how many).
_CLASSES = {"hex": (("digit", 10), ("letter", 6)), "uuid": (("digit", 10), ("letter", 6)), "base32": (("letter", 26), ("digit", 6)),
            "base36": (("digit", 10), ("letter", 26)), "base64": (("letter", 26), ("letter", 26), ("digit", 10), ("sign", 2))}
ALPHA = 0.05
BANDS = 2
STAY = 0.85
DRAWS = 8192
LONGEST_NULL = 256      # longer families are compared with null tokens of this length
GRID = 8
TOP_LEVEL = 60 * GRID


def encoding(token: str) -> str | None:
    """The encoding whose alphabet and mix of signs the token has."""
    lower, upper, digit = (bool(re.search(p, token)) for p in ("[a-z]", "[A-Z]", "[0-9]"))
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", token):
        return "hex" if digit and (lower or upper) else None
    if UUID.fullmatch(token):
        return "uuid"
    if re.fullmatch("[A-Z2-7]+|[a-z2-7]+", token):
        return "base32" if digit else None
    if re.fullmatch("[A-Z0-9]+|[a-z0-9]+", token):
        return "base36" if digit and (lower or upper) else None
    return "base64" if lower and upper and digit else None


_erfc = np.vectorize(math.erfc, otypes=[float])


def _two_sided(z: np.ndarray) -> np.ndarray:
    return _erfc(np.abs(z) / math.sqrt(2))


def battery(v: np.ndarray, kind: str) -> np.ndarray:
    """Chi-squared, runs and serial correlation of each row of symbol values,
    combined by Fisher's method."""
    size = _SIZE[kind]
    m, n = v.shape
    counts = np.bincount((np.arange(m)[:, None] * size + v).ravel(), minlength=m * size).reshape(m, size)
    chi = size / n * (counts.astype(float) ** 2).sum(1) - n
    free = size - 1
    p_chi = _erfc(((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free)) / math.sqrt(2)) / 2
    many = [k for _, k in _CLASSES[kind]]
    of = np.repeat(np.arange(len(many)), many)[v]
    share = np.array(many) / size
    change = float((share * (1 - share)).sum())
    both = float((share * (1 - share) ** 2).sum())      # a change before and after a symbol
    var = (n - 1) * change * (1 - change) + 2 * max(n - 2, 0) * (both - change ** 2)
    p_runs = _erfc(((n - 1) * change - (of[:, 1:] != of[:, :-1]).sum(1)) / math.sqrt(2 * var)) / 2
    d = v - v.mean(1, keepdims=True)
    spread = (d * d).sum(1)
    p_serial = np.where(spread > 0, _two_sided((d[:, 1:] * d[:, :-1]).sum(1) / np.maximum(spread, 1e-9) * math.sqrt(n)), 2.0 ** -min(n, 1000))
    x = -sum(np.log(np.maximum(p, 1e-300)) for p in (p_chi, p_runs, p_serial))
    return np.minimum(1.0, np.exp(-x) * (1 + x + x * x / 2))


def p_value(token: str, kind: str) -> float:
    """The battery's value of a token."""
    if kind == "uuid":          # without the digits of version and variant
        token = token.replace("-", "")
        token = token[:12] + token[13:16] + token[17:]
    return float(battery(_VALUES[kind][np.frombuffer(token.encode(), np.uint8)][None], kind)[0])


def null_tokens(kind: str, n: int, draws: int, rng: np.random.Generator) -> np.ndarray:
    """Tokens of the null model, a row of symbol values each: those of
    ``draws`` that have all classes the encoding asks for."""
    classes = [(what, k) for what, k in _CLASSES[kind] if what != "sign"]
    first = np.cumsum([0] + [k for _, k in classes])
    of = np.empty((draws, n), np.int64)
    of[:, 0] = rng.integers(len(classes), size=draws)
    for i in range(1, n):
        step = rng.integers(1, len(classes), size=draws)
        of[:, i] = np.where(rng.random(draws) < STAY, of[:, i - 1], (of[:, i - 1] + step) % len(classes))
    v = np.empty((draws, n), np.int64)
    for c, (what, k) in enumerate(classes):
        weight = np.array(LETTERS[:k], float) if what == "letter" else np.ones(k)
        here = of == c
        v[here] = first[c] + rng.choice(k, size=int(here.sum()), p=weight / weight.sum())
    return v[np.all([(of == c).any(1) for c in range(len(classes))], axis=0)]


@lru_cache(maxsize=None)
def null_levels(name: str) -> tuple[float, ...]:
    """For a family: the p-value of each level, the share of null tokens that
    score as high (at this level or a smaller one)."""
    kind, band = name.split("/")
    n = 30 if kind == "uuid" else min(LONGEST_NULL, math.ceil(2 ** (int(band) / BANDS)))
    drawn = null_tokens(kind, n, DRAWS, np.random.default_rng([n, _SIZE[kind]]))
    levels = np.array([level(p) for p in battery(drawn, kind)] if len(drawn) else [], np.int64)
    return tuple((1 + np.cumsum(np.bincount(levels, minlength=TOP_LEVEL + 1))) / (1 + len(drawn)))


def family(token: str, kind: str) -> str:
    return f"{kind}/{int(BANDS * math.log2(len(token)))}"


def level(p: float) -> int:
    """Scores on the grid, rounded up: p <= 2 ** (-level / GRID)."""
    return TOP_LEVEL if p <= 0 else max(0, min(TOP_LEVEL, math.floor(-math.log2(p) * GRID)))


def candidates(text: str) -> list[tuple[int, int, str, int]]:
    """Tokens with an encoding: start, end, family, level."""
    out = []
    for m in TOKEN.finditer(text):
        kind = None if m[0].isalpha() else encoding(m[0])
        if kind:
            out.append((m.start(), m.end(), family(m[0], kind), level(p_value(m[0], kind))))
    return out


def step_up(counts: list[tuple[str, int, int]], alpha: float = ALPHA) -> dict[str, int]:
    """(family, level, count) rows -> the greatest level of each family that
    is found not patterned (absent: none is)."""
    by: dict[str, dict[int, int]] = {}
    for name, at, n in counts:
        by.setdefault(name, {})[at] = n
    out = {}
    for name, levels in by.items():
        total, seen, p = sum(levels.values()), 0, null_levels(name)
        for at in sorted(levels):
            seen += levels[at]
            if p[at] <= alpha * seen / total:
                out[name] = at
    return out


def spans(text: str, limits: dict[str, int]) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) by start, then kind as listed."""
    out = []
    low = text.lower()
    if any(name in low for name in ASSIGN_NAMES):
        out += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    out += [(3, a, z) for a, z, name, at in candidates(text) if at <= limits.get(name, -1)]
    return [(KINDS[k], a, z) for k, a, z in sorted(out, key=lambda s: (s[1], s[0], s[2]))]


def random_limits(docs: DataFrame) -> dict[str, int]:
    """The step-up's limits from all texts. Families are few (five encodings
    and two for each doubling of the length) and so are levels: the counts
    that reach the driver are bounded."""
    def count(batches):
        for b in batches:
            rows = [(name, at) for t in b.column(0).to_pylist() if t for _, _, name, at in candidates(t)]
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())],
                                  names=["family", "level"])

    ship_code(docs.sparkSession)
    rows = (docs.select(F.col("text").cast("string")).mapInArrow(count, "family string, level int")
            .groupBy("family", "level").count().collect())
    return step_up([(r["family"], r["level"], r["count"]) for r in rows])


def secret_spans(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, spans array<struct<kind, start, end>>."""
    limits = random_limits(docs)

    def find(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            found = [[dict(zip(("kind", "start", "end"), s)) for s in spans(t, limits)] if t else [] for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(found, kind)], names=["doc_id", "spans"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(find, "doc_id long, spans array<struct<kind: string, start: long, end: long>>"))


MASK = "[SECRET]"


def masked(text: str, limits: dict[str, int]) -> str:
    """The text with each run of overlapping spans replaced by MASK."""
    out, at = [], 0
    found = [(a, z) for _, a, z in spans(text, limits)]
    for i, (a, z) in enumerate(found):
        if z <= at:
            continue
        if a >= at:
            out += [text[at:a], MASK]
        at = z
    return "".join(out) + text[at:] if out else text


def redacted(docs: DataFrame) -> DataFrame:
    """docs with its own columns; secrets in ``text`` are masked, and a
    column n_chars follows the new text."""
    limits = random_limits(docs)
    names = docs.columns
    text, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else -1

    def mask(batches):
        for b in batches:
            old = b.column(text).to_pylist()
            new = [t and masked(t, limits) for t in old]
            columns = list(b.columns)
            columns[text] = pa.array(new, b.schema.types[text])
            if chars >= 0:
                was = columns[chars].to_pylist()
                columns[chars] = pa.array([len(n) if n != o else w for n, o, w in zip(new, old, was)], b.schema.types[chars])
            yield pa.record_batch(columns, names=b.schema.names)

    return docs.mapInArrow(mask, docs.schema)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"))

    def joined(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
