"""Operator 11 against counting all windows, and its suffix arrays against sorting."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest

from panelmill.llm import suffixes


def _brute(texts: list[tuple], window: int) -> collections.Counter:
    raw = [(i, (t or "").encode()) for i, t in texts]
    n = collections.Counter(t[p : p + window] for _, t in raw for p in range(len(t) - window + 1))
    out: collections.Counter = collections.Counter()
    for i, t in raw:
        gone = [False] * len(t)
        end = 0
        for p in range(len(t) - window + 1):
            if n[t[p : p + window]] > 1:
                for k in range(max(p, end), p + window):
                    gone[k] = True
                end = p + window
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i, len(t), sum(gone), spans, bytes(c for c, g in zip(t, gone) if not g)] += 1
    return out


def _rows(found) -> collections.Counter:
    return collections.Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found.collect())


def _texts() -> list[tuple]:
    r = random.Random(3)
    word = lambda n: " ".join(r.choice(["ka", "lo", "mié", "nu", "pess", "te", "vi", "woxé"]) + str(r.randint(0, 99)) for _ in range(n))
    passage = word(30)
    texts: list[tuple] = [(1, None), (2, ""), (3, "short"), (4, "a" * 300), (5, "ab" * 100)]
    texts += [(10 + k, word(40 + 5 * k)) for k in range(10)]
    texts += [(30 + k, word(3 + k % 5) + passage + word(2 + k % 7)) for k in range(60)]  # a passage that many share
    texts += [(100, texts[8][1]), (101, (texts[9][1] or "") + " tail"), (102, passage + word(5) + passage)]
    texts += [(40, word(50)), (40, word(50)), (50, texts[7][1]), (50, texts[7][1]), (None, word(50)), (None, None), (None, texts[12][1])]
    texts += [(200, "z" * 3000), (201, word(2000))]
    return texts


@pytest.mark.parametrize(("window", "anchor", "shard"), [(40, 8, 1 << 20), (40, 8, 700), (25, 20, 3000)])
def test_all_repeats_are_found(spark, window, anchor, shard):
    texts = _texts()
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in texts], "doc_id long, text string, lo int, n int, pick string").repartition(3)
    assert _rows(suffixes.remove_repeats(docs, window, anchor, shard)) == _brute(texts, window)


def test_a_pick_of_many_shards_is_merged(spark, monkeypatch):
    """Each text shares a passage with one other text only by its place at the passage's edge, so shards must be merged to see it."""
    r = random.Random(4)
    passage = "".join(r.choice("abcdefgh") for _ in range(60))
    sides = ["".join(r.choice("abcdefgh") for _ in range(30)) for _ in range(150)]
    texts = [(k, sides[r.randrange(150)] + passage + sides[r.randrange(150)]) for k in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for shard in (1 << 20, 1500):
        assert _rows(suffixes.remove_repeats(docs, 40, 10, shard)) == _brute(texts, 40)


def test_suffix_arrays_and_common_prefixes():
    r = np.random.default_rng(0)
    for n, letters, depth in ((2000, 2, 40), (5000, 3, 17), (300, 1, 50), (20000, 4, 400), (1, 1, 30)):
        data = r.integers(97, 97 + letters, n).astype(np.uint8)
        data[n // 2 : n // 2 + n // 4] = data[: n // 4]
        order = suffixes.suffix_array(data, depth)
        raw = data.tobytes() + b"\0" * depth
        first = [raw[i : i + depth] for i in order.tolist()]
        assert sorted(order.tolist()) == list(range(n)) and first == sorted(first)
        shared = [next((k for k in range(depth) if a[k] != b[k]), depth) for a, b in zip(first, first[1:])]
        assert suffixes.common_prefixes(data, order, depth, lanes=64).tolist() == [0, *shared]


def test_large_arrays_are_sorted_alike(monkeypatch):
    data = np.random.default_rng(1).integers(97, 99, 3000).astype(np.uint8)
    small = suffixes.suffix_array(data, 64)
    monkeypatch.setattr(suffixes, "_PLACE", np.uint64(5))
    assert suffixes.suffix_array(data, 64).tolist() == small.tolist()


def test_runs_are_merged_by_binary_search():
    r = np.random.default_rng(2)
    runs = []
    for _ in range(7):
        f = np.unique(r.integers(0, 300, 60))
        x = np.zeros(len(f), suffixes.RUN)
        x["f1"] = f
        runs.append(x)
    n = collections.Counter(f for x in runs for f in x["f1"].tolist())
    for x, found in zip(runs, suffixes.merged(runs)):
        assert found.tolist() == [n[f] > 1 for f in x["f1"].tolist()]


def test_query_columns_and_long_texts(spark, tmp_path):
    r = random.Random(5)
    long = "".join(r.choice("abcdefghij ") for _ in range(2_500_000))
    texts = [(1, long), (2, "x" + long[1_000_000:1_000_900] + "y"), (3, None), (4, long[:399]), (5, long[2_000_000:2_000_400])]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = suffixes.op11_suffix_dedup(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    rows = {r["doc_id"]: r for r in found.collect()}
    assert {k: (v["n_removed"], v["n_spans"]) for k, v in rows.items()} == {1: (1300, 2), 2: (900, 1), 3: (0, 0), 4: (0, 0), 5: (400, 1)}
    assert rows[1]["kept_sha256"] == hashlib.sha256((long[:1_000_000] + long[1_000_900:2_000_000] + long[2_000_400:]).encode()).hexdigest()
    assert rows[2]["kept_sha256"] == hashlib.sha256(b"xy").hexdigest()


def test_nothing(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
