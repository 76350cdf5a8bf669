"""Operator 10: language-model scoring by a Katz bigram model.

Counts are Good-Turing discounted up to ``K``; what the discounts free goes to a context's unseen words in proportion to
their unigram probability, by weights that make each distribution sum to 1 exactly. Unigrams give their freed mass to one
unknown word. Probabilities are evaluated by recursion: the bigram if its count is known, else the context's weight times
the unigram, else the unknown word. Every context with a training bigram has its weight; weights stay in tables by key part.

Counting covers all documents and moves n-grams, not texts:

1. Documents are packed in blocks of a few MB (compressed lower-cased words), written once.
2. Each block asks for the counts of its distinct words and word pairs: for each part of the key space one sorted run of
   64-bit keys, with the block's own training counts.
3. Each part adds up the training counts of its keys and answers every run with the totals, as a table partitioned by part. Of the
   blocks that hold a pair, one is named its owner. A hot word is one key in each run, so no part is large; counts of
   counts are summed over the parts.
4. Blocks with their answers sum, for the pairs they own, each context's discounted and unigram mass, and ask for the weights of
   all their contexts: for each part one sorted run of keys with these masses. Each part adds up and answers every run.
5. Blocks with their counts and weights score their documents.

Nulls: a null text is an empty one: one token, the end. A null doc_id is scored and is in training. Rows with equal doc_id
are scored one by one. Without training documents every token is unknown and has probability 1. Empty tables give no rows.
Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.text import gram_hashes, slices, texts, word_hashes
from panelmill.session import written

FOLDS, HELD = 7, 2
K = 5
BLOCK_BYTES = 8 << 20
PART_BYTES = 12 << 20
BLOCKS_A_TASK = 2
END = b"\n"


def _blocks(docs: DataFrame, folds: int, held: int, block_bytes: int) -> DataFrame:
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == held, F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        lines, ids, held_out, tokens, size = [], [], [], 0, 0

        def block() -> pa.RecordBatch:
            data = pack.compress(b"\n".join(lines))
            columns = [pa.array([uuid.uuid4().int >> 65]), pa.array([ids], pa.list_(pa.int64())), pa.array([held_out], pa.list_(pa.bool_()))]
            return pa.record_batch([*columns, pa.array([tokens], pa.int64()), pa.array([data], pa.binary())], names=["block", "doc_ids", "held_out", "tokens", "words"])

        # A block is filled from batch after batch, whatever their size; no block exceeds ``block_bytes`` but for one longer text.
        for b in slices(batches, "text", block_bytes):
            for doc_id, out, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), texts(b.column(1))):
                if lines and size + len(t) > block_bytes:
                    yield block()
                    lines, ids, held_out, tokens, size = [], [], [], 0, 0
                words = t.lower().split()
                lines.append(b" ".join(words))
                ids.append(doc_id)
                held_out.append(out)
                tokens, size = tokens + len(words) + 1, size + len(t)
        if lines:
            yield block()

    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumn("held_out", held_out).select("doc_id", "text", "held_out")
    return rows.mapInArrow(run, "block long, doc_ids array<long>, held_out array<boolean>, tokens long, words binary")


@dataclass
class Block:
    """The tokens of a block: each word and, from the second token of a document on, the pair it ends."""

    doc_ids: list
    held_out: np.ndarray
    n: np.ndarray  # tokens of each document
    word: np.ndarray  # hash of each token
    paired: np.ndarray  # tokens that have a word before them
    pair: np.ndarray  # hash of each such pair

    @classmethod
    def of(cls, doc_ids: list, held_out: list, data: bytes) -> Block:
        tokens, n = [], []
        for line in zstandard.ZstdDecompressor().decompress(data).split(b"\n"):
            words = line.split()
            words.append(END)
            tokens += words
            n.append(len(words))
        n = np.array(n, dtype=np.int64)
        h = word_hashes(tokens)
        first = np.zeros(len(tokens), dtype=bool)
        first[np.cumsum(n) - n] = True
        paired = np.flatnonzero(~first)
        return cls(doc_ids, np.array(held_out, dtype=bool), n, h, paired, gram_hashes(h, 2, 7)[paired - 1] if len(h) > 1 else h[:0])

    def train(self) -> np.ndarray:
        return np.repeat(~self.held_out, self.n)


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _cuts(keys: np.ndarray, parts: int) -> list[tuple[int, int, int]]:
    """(part, first, end) of the parts that sorted keys fall in. A part without a key costs nothing, so a block's rows and work
    are bounded by its keys, however many parts there are."""
    part, lo = np.unique(_part(keys, parts), return_index=True)
    return list(zip(part.tolist(), lo.tolist(), [*lo[1:].tolist(), len(keys)]))


def _requests(blocks: DataFrame, parts: int) -> DataFrame:
    """(part, block, keys, times): for each block and part one run of sorted keys; words in parts 0.., pairs in parts ``parts``.."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            for block, doc_ids, held_out, data in zip(*(b.column(k).to_pylist() for k in range(4))):
                x = Block.of(doc_ids, held_out, data)
                train = x.train()
                rows = []
                for order, h, t in ((0, x.word, train), (1, x.pair, train[x.paired])):
                    keys, back = np.unique(h, return_inverse=True)
                    times = np.bincount(back, weights=t, minlength=len(keys)).astype(np.uint32)
                    rows += [(order * parts + p, block, keys[lo:hi].tobytes(), pack.compress(times[lo:hi].tobytes())) for p, lo, hi in _cuts(keys, parts)]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["part", "block", "keys", "times"])

    return blocks.select("block", "doc_ids", "held_out", "words").mapInArrow(run, "part long, block long, keys binary, times binary")


def _answers(requests: DataFrame, parts: int, k: int) -> DataFrame:
    """(part, block, counts, owned, stats): the totals of each run's keys, and one row without a block for each part's counts of counts."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        pack, unpack = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        runs = [np.frombuffer(x, dtype=np.uint64) for x in table.column("keys").to_pylist()]
        times = np.concatenate([np.frombuffer(unpack.decompress(x), dtype=np.uint32) for x in table.column("times").to_pylist()])
        keys, first, back = np.unique(np.concatenate(runs), return_index=True, return_inverse=True)
        total = np.bincount(back, weights=times, minlength=len(keys)).astype(np.int64)
        owner = np.zeros(len(back), dtype=bool)
        owner[first] = True
        end = np.cumsum([len(x) for x in runs])
        part = key[0].as_py()
        found = total[back].astype(np.uint64)
        cut = [(e - len(x), e) for x, e in zip(runs, end.tolist())]
        low = np.bincount(total[total <= k + 1], minlength=k + 2)[: k + 2]
        stats = [int(total.sum()), int((total > 0).sum()), *low[1:].tolist()]
        n = len(runs)
        return pa.table(
            {
                "part": pa.array([part] * (n + 1), pa.int64()),
                "block": pa.array([*table.column("block").to_pylist(), None], pa.int64()),
                "counts": pa.array([*[pack.compress(found[a:b].tobytes()) for a, b in cut], None], pa.binary()),
                "owned": pa.array([*[pack.compress(np.packbits(owner[a:b]).tobytes()) if part >= parts else None for a, b in cut], None], pa.binary()),
                "stats": pa.array([*[None] * n, stats], pa.list_(pa.int64())),
            }
        )

    return requests.groupBy("part").applyInArrow(run, "part long, block long, counts binary, owned binary, stats array<long>")


def discounts(times: list[int], k: int = K) -> np.ndarray:
    """Good-Turing discount of each count 0 to k (times[r - 1]: number of n-grams with count r, r = 1 to k + 1).

    Where the counts of counts don't allow them (none, or a ratio outside 0 to 1) a count loses half of one instead.
    """
    out = np.ones(k + 1)
    n1, last = times[0], times[k]
    common = (k + 1) * last / n1 if n1 else 1.0
    for r in range(1, k + 1):
        d = ((r + 1) * times[r] / (r * times[r - 1]) - common) / (1 - common) if times[r - 1] and common < 1 else 0.0
        out[r] = d if 0 < d < 1 else 1 - 0.5 / r
    return out


@dataclass
class Model:
    n: int  # training tokens
    v: int  # distinct ones
    word_discount: np.ndarray
    pair_discount: np.ndarray
    unknown: float

    @classmethod
    def of(cls, stats: dict[tuple[int, int], int], k: int) -> Model:
        words = [stats.get((0, i), 0) for i in range(k + 3)]
        pairs = [stats.get((1, i), 0) for i in range(k + 3)]
        d = discounts(words[2:], k)
        n = words[0]
        freed = sum(times * r * (1 - d[r]) for r, times in enumerate(words[2 : 2 + k], 1))
        return cls(n, words[1], d, discounts(pairs[2:], k), freed / n if n else 1.0)

    @staticmethod
    def discounted(count: np.ndarray, d: np.ndarray) -> np.ndarray:
        return count * d[np.where(count < len(d), count, 0)]

    def unigram(self, count: np.ndarray) -> np.ndarray:
        if not self.n:
            return np.ones(len(count))
        return np.where(count > 0, self.discounted(count, self.word_discount) / self.n, self.unknown)


def _counts(block: Block, answers: pa.Table, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The training count of each token's word and of each paired token's pair; the pairs (by place) that the block owns."""
    unpack = zstandard.ZstdDecompressor()
    rows = sorted(zip(*(answers.column(c).to_pylist() for c in ("part", "counts", "owned"))))
    read = lambda x, kind: np.frombuffer(unpack.decompress(x), dtype=kind)
    words = np.concatenate([np.zeros(0, np.uint64), *[read(c, np.uint64) for p, c, _ in rows if p < parts]]).astype(np.int64)
    pairs = [(read(c, np.uint64), read(o, np.uint8)) for p, c, o in rows if p >= parts]
    _, back = np.unique(block.word, return_inverse=True)
    _, at, pair_back = np.unique(block.pair, return_index=True, return_inverse=True)
    counts = np.concatenate([np.zeros(0, np.uint64), *[c for c, _ in pairs]]).astype(np.int64)
    owned = np.concatenate([np.zeros(0, bool), *[np.unpackbits(o, count=len(c)).astype(bool) for c, o in pairs]])
    return words[back], counts[pair_back], at[owned & (counts > 0)]


def _joined(blocks: DataFrame, answers: DataFrame, tasks: int, run, schema: str) -> DataFrame:
    """Each block with its answers; ``tasks`` follows from the number of blocks, so a task holds a few blocks whatever the input."""
    left = blocks.select("block", "doc_ids", "held_out", "words").repartition(tasks, "block").groupBy("block")
    right = answers.repartition(tasks, "block").groupBy("block")

    def each(a: pa.Table, b: pa.Table) -> pa.Table:
        block = Block.of(a.column("doc_ids")[0].as_py(), a.column("held_out")[0].as_py(), a.column("words")[0].as_py())
        return run(block, b)

    return left.cogroup(right).applyInArrow(each, schema)


def _contexts(block: Block, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys of the block's contexts that training has; the paired tokens (by place) that have one, and which it is."""
    use = np.flatnonzero(words[block.paired - 1] > 0)
    keys, back = np.unique(block.word[block.paired[use] - 1], return_inverse=True)
    return keys, use, back


def _weights(masses: DataFrame) -> DataFrame:
    """(part, block, weights): the backoff weight of each run's contexts."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        pack, unpack = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        runs = [np.frombuffer(x, dtype=np.uint64) for x in table.column("keys").to_pylist()]
        keys, back = np.unique(np.concatenate(runs), return_inverse=True)
        total = lambda c: np.bincount(back, weights=np.concatenate([np.frombuffer(unpack.decompress(x)) for x in table.column(c).to_pylist()]), minlength=len(keys))
        found = (np.maximum(1 - total("seen"), 1e-12) / np.maximum(1 - total("below"), 1e-12))[back]
        cut = np.split(found, np.cumsum([len(x) for x in runs])[:-1])
        return pa.table({"part": pa.array([key[0].as_py()] * len(runs), pa.int64()), "block": table.column("block"), "weights": pa.array([pack.compress(x.tobytes()) for x in cut], pa.binary())})

    return masses.groupBy("part").applyInArrow(run, "part long, block long, weights binary")


def score(docs: DataFrame, folds: int = FOLDS, held: int = HELD, k: int = K, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each document."""
    blocks = written(_blocks(docs, folds, held, block_bytes), "katz-blocks")
    tokens, n_blocks = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.count("*")).first()
    parts = max(1, round(tokens * 8 / part_bytes))
    tasks = max(1, n_blocks // BLOCKS_A_TASK)
    answers = written(_answers(_requests(blocks, parts).repartition(parts, "part"), parts, k), "katz-counts")
    sums = answers.where("block IS NULL").select((F.col("part") >= parts).cast("int").alias("order"), F.posexplode("stats").alias("at", "n"))
    model = Model.of({(r[0], r[1]): r[2] for r in sums.groupBy("order", "at").agg(F.sum("n")).collect()}, k)

    counts = answers.where("block IS NOT NULL").select("block", "part", "counts", "owned")

    def masses(block: Block, got: pa.Table) -> pa.Table:
        pack = zstandard.ZstdCompressor(level=1)
        words, pairs, own = _counts(block, got, parts)
        keys, use, back = _contexts(block, words)
        mine = np.isin(use, own)
        token = block.paired[use[mine]]
        seen = np.bincount(back[mine], weights=model.discounted(pairs[use[mine]], model.pair_discount) / words[token - 1], minlength=len(keys))
        below = np.bincount(back[mine], weights=model.unigram(words[token]), minlength=len(keys))
        rows = [(p, got.column("block")[0].as_py(), keys[a:b].tobytes(), *(pack.compress(x[a:b].tobytes()) for x in (seen, below))) for p, a, b in _cuts(keys, parts)]
        columns = list(zip(*rows)) if rows else [()] * 5
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["part", "block", "keys", "seen", "below"])

    asked = _joined(blocks, counts, tasks, masses, "part long, block long, keys binary, seen binary, below binary")
    weights = written(_weights(asked.repartition(parts, "part")), "katz-weights")

    def scores(block: Block, got: pa.Table) -> pa.Table:
        weighed = np.array([x is not None for x in got.column("weights").to_pylist()])
        words, pairs, _ = _counts(block, got.filter(pa.array(~weighed)), parts)
        p = model.unigram(words)
        _, use, back = _contexts(block, words)
        runs = sorted(zip(*(got.filter(pa.array(weighed)).column(c).to_pylist() for c in ("part", "weights"))))
        each = np.concatenate([np.zeros(0), *[np.frombuffer(zstandard.ZstdDecompressor().decompress(x)) for _, x in runs]])
        token, pairs = block.paired[use], pairs[use]
        p[token] = np.where(pairs > 0, model.discounted(pairs, model.pair_discount) / words[token - 1], each[back] * p[token])
        start = np.cumsum(block.n) - block.n
        add = lambda x: np.add.reduceat(x, start)
        return pa.table(
            {
                "doc_id": pa.array(block.doc_ids, pa.int64()),
                "held_out": pa.array(block.held_out),
                "n_tokens": pa.array(block.n),
                "n_known": pa.array(add((words > 0).astype(np.int64))),
                "train_tokens": pa.array(np.full(len(start), model.n, dtype=np.int64)),
                "base_score": pa.array(add(np.log10((words + 1) / (model.n + model.v + 1)))),
                "score": pa.array(add(np.log10(p))),
            }
        )

    none = F.lit(None).cast("binary")
    both = counts.withColumn("weights", none).unionByName(weights.select("block", "part", none.alias("counts"), none.alias("owned"), "weights"))
    return _joined(blocks, both, tasks, scores, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op10_katz(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
