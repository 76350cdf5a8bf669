"""Operator 12 against listing all prefixes, and its double arrays against sets of prefixes."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from panelmill.llm import tries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _brute(rows: list[tuple]) -> list[tuple]:
    original: dict[int, list] = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            original[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    original = {c: [x[1:] for x in sorted(v, key=lambda x: x[0])] for c, v in original.items()}
    made = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = tuple(original.get(c - c % 5, [])[:h] + own[h:])
    members = collections.defaultdict(list)
    for c, path in made.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = collections.defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    out, sums = [], {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[x] for x in children[node]]
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        sums[node] = (sum(x[0] for x in below) if below else 1, saved + sum(x[1] for x in below))
        ends = ",".join(map(str, sorted(c for c in members[node] if len(made[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), parent, len(members[node]), len(children[node]), *sums[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def _rows(found) -> list[tuple]:
    assert found.columns == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=repr)


def _conversations(seed: int) -> list[tuple]:
    r = random.Random(seed)
    texts = ["hello", "héllo wörld", "", "what is this?", "fine", None]
    rows = []
    for c in range(60):
        rows += [(c, t, r.choice(["user", "assistant", None]), "first" if t == 0 and c % 3 else r.choice(texts)) for t in range(r.choice([1, 2, 3, 5, 8, 12]))]
    rows += [(100 + 5 * k, t, "user", f"same {t}") for k in range(12) for t in range(10)]  # copies
    rows += [(203, t, "user", "deep") for t in range(120)] + [(208, t, "user", "deep") for t in range(150)]
    rows += [(301, None, "user", "before all"), (301, 0, "user", "x"), (301, -4, "user", "y"), (None, 0, "user", "nobody's"), (-7, 0, "user", "negative"), (-10, 0, "user", "base"), (-10, 1, "user", "base two")]
    rows += [(c, 0, "user", "alone") for c in range(400, 430)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("segment", "shard", "parts"), [(1024, 300_000, None), (4, 50, 5), (3, 20, 9)])
def test_every_node(spark, segment, shard, parts):
    rows = _conversations(segment)
    table = spark.createDataFrame([(*x, 1, "x") for x in rows], "conv_id long, turn long, role string, text string, depth int, conv string").repartition(4)
    assert _rows(tries.trie(table, segment, shard, parts)) == _brute(rows)


def test_repeated_rows_are_turns(spark):
    rows = [(5, 1, "user", "twice")] * 40 + [(6, 1, "user", "twice")] * 40
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert _rows(tries.trie(table, 4, 10, 3)) == _brute(rows)


def test_turnless_conversations(spark):
    c = next(c for c in range(1, 10_000, 5) if zlib.crc32(str(c).encode()) % 9 > 2)  # its base isn't there, its turns are all in the head
    rows = [(c, 0, "user", "gone"), (c, 1, "user", "gone too")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert _rows(tries.trie(table)) == _brute(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_no_conversations(spark):
    assert tries.trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_double_arrays():
    r = np.random.default_rng(3)
    for letters, count in ((3, 200), (50, 400), (2000, 500)):
        n = r.integers(0, 9, count)
        symbols = r.integers(0, letters, int(n.sum()))
        trie, dense = tries.DoubleArray.of(n, symbols)
        slots = trie.slots(n, dense)
        start = np.cumsum(n) - n
        paths = {}
        for i in range(count):
            for d in range(n[i]):
                assert paths.setdefault(int(slots[start[i] + d]), tuple(symbols[start[i] : start[i] + d + 1])) == tuple(symbols[start[i] : start[i] + d + 1])
        assert len(paths) == len(set(paths.values()))
        assert (trie.step(np.zeros(2, np.int64), np.array([10**9, -5])) == -1).all()
