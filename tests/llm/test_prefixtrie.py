"""The prefix trie against a brute force that lists every prefix."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from orderlens.llm import prefixtrie as T

SCHEMA = "conv_id long, turn long, role string, text string, conv string, depth string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) if children[node] else 1
        saved[node] = sum(saved[k] for k in children[node]) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
        ends = ",".join(str(c) for c in sorted(c for c in members[node] if whole[c] == node))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(children[node]),
                    leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, tmp_path, rows, parts=3):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    df.repartition(parts).write.parquet(str(tmp_path / "conversations.parquet"))
    got = T.op11_prefix_trie(spark, str(tmp_path))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, got.collect()), key=str)


def test_random_conversations(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "PIECE", 20)
    rng = random.Random(4)
    rows = []
    for c in [*range(0, 40), *range(95, 130), *range(300, 310), -7, -100, -103, 777]:
        for turn in range(rng.choice([1, 2, 3, 6, 9])):
            rows.append((c, turn * 2 if turn else rng.choice([None, -1]), rng.choice(["user", "bot", None]), rng.choice(["a", "ü😀", "", None])))
    rows += [(900 + i, t, "user", "same" + str(t)) for i in range(60) for t in range(7)]      # one large group
    rows += [(None, 1, "user", "x"), (None, None, None, None)]
    assert run(spark, tmp_path, rows) == brute(rows)


def test_long_chains(spark, tmp_path):
    """A conversation of 700 turns, one that leaves it half-way, one that ends inside it."""
    long = [(107, t, "user", f"t{t % 13}") for t in range(700)]
    rows = long + [(207, *r[1:]) for r in long[:350]] + [(207, t, "bot", "other") for t in range(350, 600)] + [(307, *r[1:]) for r in long[:100]]
    assert run(spark, tmp_path, rows) == brute(rows)


def test_ties_and_repeated_rows(spark, tmp_path):
    """Equal turns are ordered alike in every conversation."""
    rows = [(c, 1, "user", t) for c in (101, 102) for t in ("b", "a", "a", None)] + [(101, None, None, None)] * 2
    got = run(spark, tmp_path, rows)
    left = [n - zlib.crc32(str(c).encode()) % 6 for c, n in ((101, 6), (102, 4))]      # there is no conversation 100
    assert got[0][:2] == (101, 0) and max(r[1] for r in got) == max(left)
    again = tmp_path / "again"
    again.mkdir()
    assert run(spark, again, rows[::-1], 5) == got


def test_turnless_and_empty(spark, tmp_path):
    """Ids whose h is beyond their turns, without a base conversation."""
    rows = [(c, 0, "u", "x") for c in range(101, 200)]
    got = run(spark, tmp_path, rows)
    assert got == brute(rows) and [r[3] for r in got if r[1] == 0] == [99] and sum(r[1] > 0 for r in got) == 1
    empty = tmp_path / "empty"
    empty.mkdir()
    assert run(spark, empty, []) == []


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_subtree_totals(spark, kind):
    rng = random.Random(kind)
    parent = {0: None} | {i: {"chain": i - 1, "star": 0, "random": rng.randrange(i)}[kind] for i in range(1, 120)}
    depth = {0: 0}
    for i in range(1, 120):
        depth[i] = depth[parent[i]] + 1
    total, leaves, kids = dict.fromkeys(parent, 0), dict.fromkeys(parent, 0), dict.fromkeys(parent, 0)
    for i in range(119, -1, -1):
        total[i] += i + 1
        leaves[i] += not kids[i]
        if i:
            total[parent[i]] += total[i]
            leaves[parent[i]] += leaves[i]
            kids[parent[i]] += 1
    df = spark.createDataFrame([(i, depth[i], parent[i]) for i in parent], "conv_id long, depth long, parent_conv_id long")
    got = T.subtree_totals(df, {"total": T.F.col("conv_id") + 1}, {"leaves": T.F.lit(1)})
    assert sorted(map(tuple, got.select("conv_id", "depth", "n_children", "total", "leaves").collect())) == [
        (i, depth[i], kids[i], total[i], leaves[i]) for i in sorted(parent)]
