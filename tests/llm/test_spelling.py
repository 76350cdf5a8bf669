"""Operator 13 against comparing all pairs of words."""

from __future__ import annotations

import collections
import random
import re
import zlib

import pytest

from panelmill.llm import spelling


def _near(a: str, b: str) -> bool:
    if a == b:
        return False
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    x, y = a[n:], b[n:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:]


def _brute(words: dict[str, int]) -> dict[str, tuple]:
    form, out = {}, {}
    for w, n in words.items():
        near = [x for x in words if _near(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
        out[w] = (n, form[w], len(near), words[form[w]] if form[w] else None)

    def root(w: str) -> str:
        while form[w]:
            w = form[w]
        return w

    return {w: (n, f, root(w), k, m) for w, (n, f, k, m) in out.items()}


def _rows(found) -> dict[str, tuple]:
    rows = found.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["n"], r["form"], r["root"], r["n_near"], r["form_n"]) for r in rows}


def _brute_counts(texts: list[tuple], plant: int) -> dict[str, int]:
    n: collections.Counter = collections.Counter()
    for doc_id, text in texts:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % plant == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += len(w) >= 5
    return {w: k for w, k in n.items() if k >= 3}


@pytest.mark.parametrize("block_words", [20_000, 23])
def test_all_near_words_are_found(spark, block_words):
    r = random.Random(7)
    words = sorted({"".join(r.choice("abé") for _ in range(r.randint(5, 8))) for _ in range(350)})
    counts = {w: r.choice([3, 3, 4, 6, 8, 12, 30]) for w in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert _rows(spelling.variants(table, block_words)) == _brute(counts)


def test_a_frequent_half_is_split_over_blocks(spark):
    r = random.Random(8)
    counts = {"aaaaaa" + "".join(r.choice("abcde") for _ in range(6)): r.randint(3, 40) for _ in range(300)}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert _rows(spelling.variants(table, 20)) == _brute(counts)


def test_words_of_texts(spark, tmp_path):
    r = random.Random(9)
    base = ["Étion", "Threat", "threats", "treats", "houses", "hou÷ses", "abcde", "Àbcde", "ab1cdefgh", "word_words", "naïve"]
    texts = [(k, " ".join(r.choice(base) for _ in range(60))) for k in range(40)]
    texts += [(None, "Threat threat THREAT"), (None, None), (50, None), (51, ""), (52, "\n \t"), (3, texts[3][1]), (3, texts[3][1]), (60, "houses " * 300_000), (61, "x" * 200_000)]
    rows = [(i, t, "en", "s", 1, 2, "x") for i, t in texts]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long, word int, form string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = spelling.op13_spelling_variants(spark, str(tmp_path))
    assert found.columns == ["word", "n", "form", "root", "n_near", "form_n"]
    assert _rows(found) == _brute(_brute_counts(texts, spelling.PLANT))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert {r["word"]: r["n"] for r in spelling.vocabulary(docs, plant=5).collect()} == _brute_counts(texts, 5)


def test_no_words(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.vocabulary(docs)).collect() == []


def test_long_chains_of_forms(spark):
    words = {"a" * (5 + k): 3 * 2**k for k in range(12)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    found = _rows(spelling.variants(table))
    assert {r[2] for r in found.values()} == {"a" * 16}


def test_skipped_blocks_hold_nothing_near():
    r = random.Random(10)
    for _ in range(2000):
        a, b = ("".join(r.choice("ab") for _ in range(r.randint(5, 8))) for _ in range(2))
        if _near(a, b):
            assert all(spelling.within_one(b[:k], a) for k in range(len(b) + 1))
