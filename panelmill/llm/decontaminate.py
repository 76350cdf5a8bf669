"""Operator 3: benchmark decontamination by rare n-gram seeds and Smith-Waterman alignment.

Seeds are gapped bigrams: an item's word with the next or the next but one (lower-cased words, punctuation ignored); documents
give the same pairs, so a seed holds over one changed, missing or added word. No alignment from ``THRESHOLD`` up is missed:

* An alignment of m matches and e errors scores 2m - e. From a share t of an n-word item's perfect score 2n on, e is at most
  2(m - tn). Fewer than e / 2 of the m - 1 steps between matches can hold two errors or more, so at least tn - 1 steps hold one
  at most, and each of those is a seed that both texts have.
* So any tn - 1 - c of the item's seed places can go, and c of them still hit. Those that most items of the block share go; the
  rare ones left are joined with the documents. c hits of an item (``HITS``, or all that it must have) must stand as close
  together as an alignment can be long, 2n (1 - t) errors included.
* A passage is what an alignment through such a hit can reach. One that has fewer than tn of the item's words can't get there
  and isn't aligned; the others are, word by word (Smith-Waterman, linear gaps).

The score is the best local alignment over a perfect one. For t = 0.5 results are those of aligning each item with each whole
document. Items of one or two words have no such seeds: they count where they stand whole (score 1).

The pass over the documents is map-only. The benchmark is a table of hashed words; blocks of about ``BLOCK_WORDS`` of its words
go to the driver and to the tasks one after another. A larger benchmark takes more passes, never a larger block.

Nulls: a null text is an empty one and matches nothing; items with a null id or without words are left out; a null doc_id is
searched like any other. Repeated items and repeated documents are each reported; of equal alignments the one that ends first.
Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.text import gram_hashes, mix, slices, texts, word_hashes
from panelmill.session import written

THRESHOLD = 0.5
HITS = 4
BLOCK_WORDS = 2_000_000
MATCH, MISMATCH, GAP = 2, -1, -1

_WORD = re.compile(r"\w+")


def words_of(text: bytes) -> list[bytes]:
    found = _WORD.findall(text.decode("utf-8", "replace").lower())
    return "\n".join(found).encode().split(b"\n") if found else []


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int]:
    """The best local alignment score, and the passage position after its last word, the first of equal ones."""
    steps = np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1, dtype=np.int64)
    best, end = 0, 0
    for w in item:
        now = np.maximum(row + GAP, 0)
        now[1:] = np.maximum(now[1:], row[:-1] + np.where(passage == w, MATCH, MISMATCH))
        # gaps along the passage: the best start to the left, less the way from it
        row = np.maximum.accumulate(now - GAP * steps) + GAP * steps
        at = int(row.argmax())
        if row[at] > best or (row[at] == best and at < end):
            best, end = int(row[at]), at
    return best, end


def _pairs(h: np.ndarray, apart: int) -> np.ndarray:
    """Seeds of each word with the one ``apart`` places on: equal words give equal seeds at either distance."""
    with np.errstate(over="ignore"):
        return mix(h[: len(h) - apart] * np.uint64(0x9E3779B97F4A7C15) + h[apart:])


class Seeds:
    """The rare seeds of a block of items, and the items' words as hashes."""

    def __init__(self, ids: list[int], words: list[np.ndarray], threshold: float) -> None:
        self.ids, self.words, self.threshold = ids, words, threshold
        self.n = np.array([len(w) for w in words], dtype=np.int64)
        self.slack = np.floor(2 * self.n * (1 - threshold) + 1e-9).astype(np.int64)
        must = np.maximum(1, np.ceil(threshold * self.n - 1 - 1e-9)).astype(np.int64)
        self.hits = np.minimum(must, HITS)
        h = np.concatenate([np.zeros(0, np.uint64), *words])
        item = np.repeat(np.arange(len(words)), self.n)
        at = np.arange(len(h)) - np.repeat(np.cumsum(self.n) - self.n, self.n)
        long = self.n[item] > 2
        rows = [np.flatnonzero(long & (at + d < self.n[item])) for d in (1, 2)]
        key, place = np.concatenate([_pairs(h, d)[r] for d, r in zip((1, 2), rows)]), np.concatenate(rows)
        _, back, times = np.unique(key, return_inverse=True, return_counts=True)
        shared = np.zeros(len(h), dtype=np.int64)
        np.maximum.at(shared, place, times[back])
        # in each item the places whose seeds most items share come last; as many of those go as may
        order = np.lexsort((at, shared, item))
        rank = np.zeros(len(h), dtype=np.int64)
        rank[order] = np.arange(len(h)) - np.repeat(np.cumsum(self.n) - self.n, self.n)
        # the last word starts no seed; its rank counts, with no seed shared it comes first
        rare = rank < (self.n - (must - self.hits))[item]
        keep = rare[place]
        order = np.argsort(key[keep], kind="stable")
        self.key, self.owner, self.at = key[keep][order], item[place][keep][order], at[place][keep][order]
        self.short = {}
        for size in (1, 2):
            which = np.flatnonzero(self.n == size)
            keys = np.array([gram_hashes(words[k], size)[0] for k in which.tolist()], dtype=np.uint64)
            order = np.argsort(keys, kind="stable")
            self.short[size] = (keys[order], which[order])

    @staticmethod
    def _join(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in wanted, row of the sorted keys) of all equal pairs."""
        if not len(keys) or not len(wanted):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = np.searchsorted(keys, wanted)
        found = np.flatnonzero(keys[np.minimum(first, len(keys) - 1)] == wanted)
        first = first[found]
        times = np.searchsorted(keys, wanted[found], "right") - first
        return np.repeat(found, times), np.arange(times.sum()) + np.repeat(first - np.cumsum(times) + times, times)

    def passages(self, h: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, start, end) of the passages that can hold an alignment; ``h`` are the words of all documents."""
        owners, starts, docs, places = [], [], [], []
        for d in (1, 2):
            inside = np.flatnonzero(doc[: max(0, len(h) - d)] == doc[d:]) if len(h) > d else np.zeros(0, np.int64)
            at, row = self._join(self.key, _pairs(h, d)[inside] if len(inside) else h[:0])
            owners.append(self.owner[row])
            starts.append(inside[at] - self.at[row])
            places.append(inside[at])
            docs.append(doc[inside[at]])
        owner, start, place, docs = map(np.concatenate, (owners, starts, places, docs))
        if not len(owner):
            return
        order = np.lexsort((start, place, owner, docs))
        owner, start, place, docs = owner[order], start[order], place[order], docs[order]
        # one hit for each word of the document and place of the item: a pair may be a seed at both distances
        same = np.zeros(len(owner), dtype=bool)
        same[1:] = (np.diff(docs) == 0) & (np.diff(owner) == 0) & (np.diff(place) == 0) & (np.diff(start) == 0)
        owner, start, place, docs = owner[~same], start[~same], place[~same], docs[~same]
        last = np.arange(len(owner)) + self.hits[owner] - 1
        ok = last < len(owner)
        to = np.minimum(last, len(owner) - 1)
        ok &= (docs[to] == docs) & (owner[to] == owner) & (place[to] - place < self.n[owner] + self.slack[owner])
        # a hit counts if it is one of those that stand together
        reach = np.zeros(len(owner) + 1, dtype=np.int64)
        np.add.at(reach, np.flatnonzero(ok), 1)
        np.add.at(reach, last[ok] + 1, -1)
        near = np.cumsum(reach[:-1]) > 0
        owner, start, docs = owner[near], start[near], docs[near]
        if not len(owner):
            return
        edge = np.searchsorted(doc, np.arange(int(doc[-1]) + 2))
        lo, hi = np.maximum(start - self.slack[owner], edge[docs]), np.minimum(start + self.n[owner] + self.slack[owner], edge[docs + 1])
        order = np.lexsort((lo, owner, docs))
        held: tuple[int, int, int, int] | None = None
        for d, k, a, b in [*zip(docs[order].tolist(), owner[order].tolist(), lo[order].tolist(), hi[order].tolist()), (-1, -1, 0, 0)]:
            if held and held[:2] == (d, k) and a <= held[3]:
                held = (d, k, held[2], max(b, held[3]))
                continue
            if held and np.isin(self.words[held[1]], h[held[2] : held[3]]).sum() >= self.threshold * self.n[held[1]]:
                yield held
            held = (d, k, a, b)

    def search(self, h: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int, float, int, int]]:
        """(document, item, score, start, end) of the items from the threshold up, in words of all documents together."""
        spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for d, k, lo, hi in self.passages(h, doc):
            spans.setdefault((d, k), []).append((lo, hi))
        for (d, k), parts in spans.items():
            item = self.words[k]
            best, end, lo = min(((-s, lo + e, lo) for lo, hi in parts for s, e in (align(item, h[lo:hi]),)))
            score = -best / (MATCH * len(item))
            if score >= self.threshold:
                yield d, k, score, end - align(item[::-1], h[lo:end][::-1])[1], end
        for size, (keys, which) in self.short.items():
            inside = np.flatnonzero(doc[: len(h) - size + 1] == doc[size - 1 :]) if len(h) >= size else np.zeros(0, np.int64)
            at, row = self._join(keys, gram_hashes(h, size)[inside])
            first: dict[tuple[int, int], int] = {}
            for j, k in zip(inside[at].tolist(), which[row].tolist()):
                first.setdefault((int(doc[j]), k), j)
            for (d, k), j in first.items():
                yield d, k, 1.0, j, j + size


def _blocks(benchmark: DataFrame, threshold: float, block_words: int) -> Iterator[Seeds]:
    """The benchmark's seeds, about ``block_words`` words at a time (or one longer item)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [word_hashes(words_of(t)) for t in texts(b.column(1))]
            yield pa.record_batch([b.column(0), pa.array(map(len, words), pa.int64()), pa.array([w.tobytes() for w in words], pa.binary())], names=["item_id", "n", "words"])

    rows = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("long"), "text")
    items = written(rows.mapInArrow(hashed, "item_id long, n long, words binary").where("n > 0"), "benchmark-words")
    total = items.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n = math.ceil(total / block_words)
    for k in range(n):
        block = items.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(n)) == k).orderBy("item_id", "words").toArrow()
        if block.num_rows:
            yield Seeds(block.column("item_id").to_pylist(), [np.frombuffer(w, dtype=np.uint64) for w in block.column("words").to_pylist()], threshold)


def _words(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all texts one after another, the text of each, and where each text starts."""
    words = [words_of(t) for t in raw]
    n = np.array([len(w) for w in words], dtype=np.int64)
    return word_hashes([w for each in words for w in each]), np.repeat(np.arange(len(raw)), n), np.cumsum(n) - n


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, score, start, end): the item's best alignment in the document, in words of the document."""
    schema = "doc_id long, item_id long, score double, start long, end long"
    docs = docs.select(F.col("doc_id").cast("long"), "text")

    def found(seeds: Seeds) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, "text"):
                h, doc, at = _words(texts(b.column(1)))
                rows = list(seeds.search(h, doc))
                d, k, score, start, end = (list(c) for c in zip(*rows)) if rows else ([],) * 5
                first = at[d] if d else np.zeros(0, np.int64)
                columns = [b.column(0).take(pa.array(d, pa.int64())), pa.array([seeds.ids[i] for i in k], pa.int64()), pa.array(score, pa.float64())]
                columns += [pa.array(np.array(x, dtype=np.int64) - first) for x in (start, end)]
                yield pa.record_batch(columns, names=["doc_id", "item_id", "score", "start", "end"])

        return docs.mapInArrow(run, schema)

    out = None
    for seeds in _blocks(benchmark, threshold, block_words):
        # A second block: what the first has found is written, so that its seeds can go.
        out = found(seeds) if out is None else written(out, "contaminated").union(found(seeds))
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, with all columns: each row is judged by its own text, whatever its doc_id."""
    columns = docs.columns

    def kept(docs: DataFrame, seeds: Seeds) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, "text"):
                h, doc, _ = _words(texts(b.column(columns.index("text"))))
                clean = np.ones(b.num_rows, dtype=bool)
                clean[[d for d, *_ in seeds.search(h, doc)]] = False
                yield b.filter(pa.array(clean))

        return docs.mapInArrow(run, docs.schema)

    out = None
    for seeds in _blocks(benchmark, threshold, block_words):
        out = kept(docs if out is None else written(out, "decontaminated"), seeds)
    return docs if out is None else out


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return contaminated(read("documents"), read("benchmark"))
