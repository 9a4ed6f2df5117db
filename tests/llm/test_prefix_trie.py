"""The prefix trie against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from marketlake.llm import prefix_trie as trie

CONV = "conv_id long, turn long, role string, text string"


def in_order(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            out[conv].append((turn, role or "", text or ""))
    for turns in out.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.sha256(
            f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()))
    return {c: [t[1:] for t in turns] for c, turns in out.items()}


def rebuilt(rows):
    given = in_order(rows)
    heads = {c: zlib.crc32(str(c).encode()) % 6 for c in given}
    return {c: given.get(c - c % 100, [])[:heads[c]] + turns[heads[c]:] for c, turns in given.items()}


def brute(paths):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(paths.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(members[node]) - 1) * len(node[-1][1]) if node else 0
    return sorted((
        members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), children[n], leaves[n], saved[n],
        hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()) for n in members)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def same(got, want):
    key = lambda r: (r[1], r[0], r[7])
    assert sorted(got, key=key) == sorted(want, key=key)


def conversations(seed, n):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        for t in range(rng.choice([1, 1, 2, 3, 5, 8, 12])):
            out.append((c * rng.choice([1, 1, 1, 7]), rng.choice([t, t, t, None]), rng.choice(["user", "assistant", "", None]),
                        rng.choice(["a", "bb", "", None, "é漢"])))
    return out + [(None, 0, "user", "lost"), (250, 0, "user", "x" * 50_000)]


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 60, "shard_turns": 40}])
def test_rebuilt_trie_equals_brute_force(spark, sizes):
    rows = conversations(1, 260)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], CONV + ", depth int, mark string")
    same([tuple(r) for r in trie.rebuilt_trie(df, **sizes).collect()], brute(rebuilt(rows)))


def test_long_and_equal_conversations_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(trie, "SEGMENT", 8)
    rng = random.Random(2)
    long = [("user", rng.choice("ab")) for _ in range(120)]
    rows = []
    for c in range(40):  # a third of all rows in copies of one path, and paths that leave it anywhere
        turns = long[: rng.randrange(len(long))] if c % 3 else long[:90]
        turns = turns + [("assistant", rng.choice("abc")) for _ in range(rng.randrange(20) if c % 3 else 0)]
        rows += [(c, t, *turn) for t, turn in enumerate(turns)]
    df = spark.createDataFrame(rows, CONV)
    same([tuple(r) for r in trie.prefix_trie(df, shard_turns=200).collect()], brute(in_order(rows)))


def test_empty_table_and_turnless_conversations(spark):
    df = spark.createDataFrame([(101, 0, "user", "gone")], CONV)
    assert zlib.crc32(b"101") % 6 > 0  # its own first turns go, and there is no conversation 100
    nothing = [(101, 0, None, 1, 0, 1, 0, hashlib.sha256(b"101").hexdigest())]
    assert rows_of(trie.rebuilt_trie(df)) == nothing
    assert trie.rebuilt_trie(df.limit(0)).count() == 0
    assert trie.prefix_trie(df).count() == 2


def test_tree_is_balanced_by_medians():
    n = 1000
    assert sorted(trie.medians_first(n)) == list(range(n))
    tree = trie.TernaryTree()
    for i in trie.medians_first(n):
        tree.path([i], i)
    height, todo = 0, [(tree.below[0], 1)]
    while todo:
        node, level = todo.pop()
        if node >= 0:
            height = max(height, level)
            todo += [(tree.low[node], level + 1), (tree.high[node], level + 1)]
    assert height <= 10
