"""Operator 13: spelling variants, by dynamic programming over the sorted vocabulary.

1. Words are counted over all whole texts: maximal runs of letters, lower-cased (A to Z only), with a planted deletion where ``PLANT``
   divides a checksum of document and run. Tasks add up their own counts first, so a frequent word is one row for each task.
2. The vocabulary is sorted twice, forwards and by reversed words, and cut into blocks of neighbours. Two words one edit apart
   share all but one character, so either the first or the last half of one of them is where the edit isn't. A word asks,
   forwards, only the blocks where words with its own first half stand, and backwards those with its last half; of these a block
   whose common prefix is more than one edit away is skipped. Frequent halves span several blocks and are split by that.
3. Each block scans its sorted list for all its askers at once. Neighbours' longest common prefixes cut the list into ranges that share
   a prefix; the banded row of the edit matrix (three cells) of a prefix is computed once for its range and extended
   character by character for the ranges within it. A range whose row exceeds one edit everywhere is skipped with all its words.
4. Each word's near words are counted and its best one kept; forms are followed by pointer doubling, as counts at least double.

Nulls: a null text has no words; a null doc_id counts as an empty text in the checksum. Repeated rows count each time. Ties of
counts go to the word that is smallest in code-point order. Very long texts are read in slices of whole documents; no word is cut.
Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.text import slices, texts
from panelmill.session import spent, written

PLANT = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
BLOCK_WORDS = 20_000
HELD_WORDS = 200_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
FAR = 9


def _counts(docs: DataFrame, plant: int) -> DataFrame:
    """(word, n): what each task has counted."""

    def rows(held: Counter) -> pa.RecordBatch:
        return pa.record_batch([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for b in slices(batches, "text"):
            for doc_id, text in zip(b.column(0).to_pylist(), texts(b.column(1))):
                start = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id)
                start = zlib.crc32(b":", start)
                for w, n in Counter(_RUN.findall(text.lower().decode("utf-8", "replace"))).items():
                    h = zlib.crc32(w.encode(), start)
                    if h % plant == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1 :]
                    if len(w) >= LEAST_LENGTH:
                        held[w] += n
            if len(held) > HELD_WORDS:
                yield rows(held)
                held.clear()
        yield rows(held)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "word string, n long")


def vocabulary(docs: DataFrame, plant: int = PLANT, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words that occur ``least`` times or more."""
    return _counts(docs, plant).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def head(length: int) -> int:
    """How many first characters a word shares with those near words that it asks for forwards; the rest it asks for backwards."""
    return (length - 1) // 2


class Sorted:
    """A sorted list of words as code points, with the common prefixes of neighbours."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.size = np.array([len(w) for w in words], dtype=np.int64)
        self.width = int(self.size.max(initial=0))
        self.codes = _codes(words, self.width + 1)
        same = self.codes[1:] == self.codes[:-1]
        lcp = np.where(same.all(axis=1), self.width, same.argmin(axis=1)) if len(words) > 1 else np.zeros(0, np.int64)
        self.lcp = np.concatenate([[-1], np.minimum(lcp, np.minimum(self.size[1:], self.size[:-1]))])
        self.breaks = [np.flatnonzero(self.lcp == d) for d in range(self.width + 1)]

    def near(self, asked: list[str], heads: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(asker, word) of all pairs exactly one edit apart that share the asker's first ``heads`` characters."""
        out_q, out_w = [], []
        size = np.array([len(w) for w in asked], dtype=np.int64)
        codes = _codes(asked, max(int(size.max(initial=0)), self.width) + 3)
        heads_ = np.array(heads, dtype=np.int64)
        first = [bisect_left(self.words, w[:h]) for w, h in zip(asked, heads)]
        last = [bisect_right(self.words, w[:h] + "\U0010ffff") for w, h in zip(asked, heads)]
        first, last = np.array(first, dtype=np.int64), np.array(last, dtype=np.int64)
        for d in np.unique(heads_[last > first]).tolist():
            q = np.flatnonzero((heads_ == d) & (last > first))
            lo, hi = first[q], last[q]
            row = np.tile(np.array([1, 0, 1], dtype=np.int64), (len(q), 1))
            depth = d
            while len(q):
                # Words that end here: their distance stands in the asker's last column.
                ends = self.size[lo] == depth
                column = size[q] - depth + 1
                hit = ends & (column >= 0) & (column <= 2)
                hit[hit] = row[hit, column[hit]] == 1
                out_q.append(q[hit])
                out_w.append(lo[hit])
                if depth >= self.width:
                    break
                # Ranges that share one character more.
                at = self.breaks[depth]
                a, b = np.searchsorted(at, lo + 1), np.searchsorted(at, hi)
                n = b - a + 1
                src = np.repeat(np.arange(len(q)), n)
                nth = np.arange(len(src)) - np.repeat(np.cumsum(n) - n, n)
                start = np.where(nth == 0, lo[src], at[np.minimum(np.repeat(a, n) + nth - 1, len(at) - 1)] if len(at) else lo[src])
                end = np.append(start[1:], 0)
                final = nth == np.repeat(n, n) - 1
                end[final] = hi
                longer = self.size[start] > depth  # a word that ends here is its range's first
                start, end, src = start[longer], end[longer], src[longer]
                char, who, old = self.codes[start, depth], q[src], row[src]
                differs = [codes[who, depth + k - 1] != char if depth + k else np.ones(len(who), bool) for k in range(3)]
                new = np.empty_like(old)
                new[:, 0] = np.minimum(old[:, 0] + differs[0], old[:, 1] + 1)
                new[:, 1] = np.minimum(np.minimum(old[:, 1] + differs[1], old[:, 2] + 1), new[:, 0] + 1)
                new[:, 2] = np.minimum(old[:, 2] + differs[2], new[:, 1] + 1)
                if depth == 0:
                    new[:, 0] = 1
                alive = new.min(axis=1) <= 1
                q, lo, hi, row = who[alive], start[alive], end[alive], new[alive]
                depth += 1
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *out_q]), np.concatenate([none, *out_w])


def _codes(words: list[str], width: int) -> np.ndarray:
    """Code points of each word in ``width`` columns, 0 behind its end."""
    if not words:
        return np.zeros((0, width), dtype=np.uint32)
    return np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(len(words), width)


def within_one(prefix: str, word: str) -> bool:
    """Whether some continuation of ``prefix`` is at most one edit from ``word``: its banded row has a cell of at most 1."""
    row = [FAR, 0, 1]
    for i, c in enumerate(prefix):
        at = lambda j: word[j] if 0 <= j < len(word) else None
        a = min(row[0] + (at(i - 1) != c), row[1] + 1)
        b = min(row[1] + (at(i) != c), row[2] + 1, a + 1)
        row = [a, b, min(row[2] + (at(i + 1) != c), b + 1)]
        if min(row) > 1:
            return False
    return True


def asked_blocks(word: str, h: int, edges: list[str], last: list[str]) -> list[int]:
    """The blocks (first words ``edges``, last words ``last``) that may hold words near ``word`` with its first ``h`` characters."""
    prefix = word[:h]
    out = []
    for k in range(max(0, bisect_right(edges, prefix) - 1), bisect_right(edges, prefix + "\U0010ffff")):
        if last[k] < prefix:
            continue
        a, b = edges[k], last[k]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        if within_one(a[:n], word):
            out.append(k)
    return out


def _direction(words: DataFrame, backwards: bool, n_words: int, block_words: int, length: int) -> DataFrame:
    """(word, n_near, form_n, form) for each word and block with near words in this direction; each pair comes in one direction."""
    turned = F.reverse("word") if backwards else F.col("word")
    parts = max(1, math.ceil(n_words / block_words))
    part = words.select(turned.alias("key"), "n").repartitionByRange(parts, "key").withColumn("block", F.spark_partition_id())
    part = written(part, "spelling-blocks")
    # Two words a block: as many rows as the vocabulary has blocks.
    edges = sorted((r["lo"], r["hi"], r["block"]) for r in part.groupBy("block").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).collect())
    lo, hi, ids = [list(x) for x in zip(*edges)] if edges else ([], [], [])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for word in b.column(0).to_pylist():
                h = head(len(word))
                rows += [(ids[k], word) for k in asked_blocks(word, len(word) - h if backwards else h, lo, hi)]
            columns = list(zip(*rows)) if rows else [(), ()]
            yield pa.record_batch([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.string())], names=["block", "key"])

    def scan(members: pa.Table, askers: pa.Table) -> pa.Table:
        order = sorted(zip(members.column("key").to_pylist(), members.column("n").to_pylist()))
        block = Sorted([w for w, _ in order])
        count = np.array([n for _, n in order], dtype=np.int64)
        asked = askers.column("key").to_pylist()
        heads = [head(len(w)) for w in asked]
        q, w = block.near(asked, [len(x) - h for x, h in zip(asked, heads)] if backwards else heads) if asked and order else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        if backwards and len(q):  # pairs that share the first half were found forwards
            keep = [block.words[j][::-1][: heads[i]] != asked[i][::-1][: heads[i]] for i, j in zip(q.tolist(), w.tolist())]
            q, w = q[keep], w[keep]
        names = block.words if not backwards else [x[::-1] for x in block.words]
        rank = np.zeros(len(names), dtype=np.int64)
        rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
        order = np.lexsort((rank[w], -count[w], q))
        q, w = q[order], w[order]
        top = np.flatnonzero(np.diff(q, prepend=-1))
        times = np.diff(np.append(top, len(q)))
        word = [asked[i][::-1] if backwards else asked[i] for i in q[top].tolist()]
        return pa.table([pa.array(word, pa.string()), pa.array(times, pa.int64()), pa.array(count[w[top]], pa.int64()), pa.array([names[j] for j in w[top].tolist()], pa.string())], names=["word", "n_near", "form_n", "form"])

    askers = words.select(turned.alias("key")).mapInArrow(ask, "block int, key string")
    tasks = max(1, min(parts, 2 * length))
    left, right = part.repartition(tasks, "block").groupBy("block"), askers.repartition(tasks, "block").groupBy("block")
    found = written(left.cogroup(right).applyInArrow(scan, "word string, n_near long, form_n long, form string"), "spelling-near")
    spent(part)
    return found


def followed(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by pointer doubling; forms is (word, form) without cycles."""
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        then = written(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        spent(now)
        now = then.select("word", "root")
        now.written_path = then.written_path
        if then.where("moved").isEmpty():
            return now


def variants(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, n, form, root, n_near, form_n of each word of a vocabulary (word, n) of distinct words."""
    spark = words.sparkSession
    words = written(words.select("word", F.col("n").cast("long")), "spelling-words")
    n_words = words.count()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = [_direction(words, backwards, n_words, block_words, tasks) for backwards in (False, True)]
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    near = found[0].union(found[1]).groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    good = -F.col("best.less") >= 2 * F.col("n")
    joined = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, F.col("best.form")).alias("form"), F.when(good, -F.col("best.less")).alias("form_n"))
    joined = written(joined, "spelling-forms")
    spent(words, *found)
    roots = followed(joined.where("form IS NOT NULL"))
    return joined.join(roots, "word", "left").select("word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n")


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return variants(vocabulary(spark.read.parquet(f"{sf_dir}/documents.parquet")))
