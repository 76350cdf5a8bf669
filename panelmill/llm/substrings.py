"""Operator 7: removal of repeated word windows, by repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document. A word goes if a window that covers it has a word sequence
that also starts earlier (smaller doc_id, or same document and earlier start).

1. Every window picks the least hash among its ``ANCHOR``-word phrases; equal windows pick equal phrases, and about one
   phrase in six is picked, so only these are counted over the corpus. Phrases picked once can't lie in a repeat.
2. For the phrases picked more than once, the windows that picked them are hashed (96 bits) and grouped: the first place
   of each recurring window is a minimum, which is pre-aggregated, so a passage that a third of all documents share
   costs no more than another. This confirms the recurring passages: runs of windows whose first places run along. A document
   whose whole word sequence a smaller doc_id has is such a passage too; it is confirmed by its digest, not window by window.
3. Passages are cut out of the documents of their first places, in pieces of at most ``PIECE`` windows, each once, and go to
   the shards whose documents may hold them. A shard is a few MB of documents, dealt out by hash: a passage that very many
   documents share is one row in each shard.
4. Each shard compiles an Aho-Corasick automaton over the word ids of its passages, and all documents are streamed through
   the automaton of their shard. Only its hits remove words: exact words that also start at the passage's first place. An
   automaton holds no more words than its shard's documents.

Hashes only choose what is compared; a collision can't remove a word that isn't repeated. Each step is a written table; one that no
later step reads is deleted.

Nulls: a null text is an empty one (nothing removed, digest of the empty string). A null doc_id has no place in the
order: such rows are returned whole and remove nothing. Rows with equal doc_id are one document, whatever their texts: a place
is a doc_id and a position, so a window goes from each of them if it also starts at a smaller place. Each row is returned.
Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.text import gram_hashes, slices, texts, word_hashes
from panelmill.session import spent, written

WINDOW = 20
ANCHOR = 10
PIECE = 256
SHARD_BYTES = 4 << 20
#: Text that a Python worker has as words at once (or one longer text).
SLICE_BYTES = 1 << 20
#: Shards of a streaming task at least; with very many shards a task has more, so that tasks stay within so many times the session's partitions.
SHARDS_A_TASK, TASKS = 4, 4


class Slice:
    """The words of all documents of a record batch, one after another."""

    def __init__(self, raw: list[bytes]) -> None:
        each = [t.split() for t in raw]
        self.n = np.array([len(w) for w in each], dtype=np.int64)
        self.words = [w for words in each for w in words]
        self.hashes = word_hashes(self.words)
        self.start = np.cumsum(self.n) - self.n
        self.doc = np.repeat(np.arange(len(raw)), self.n)

    def windows(self, window: int) -> np.ndarray:
        """The first words of all windows that lie within one document."""
        last = len(self.words) - window
        if last < 0:
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero(self.doc[: last + 1] == self.doc[window - 1 :])


def picks(grams: np.ndarray, span: int) -> np.ndarray:
    """Where the least of each ``span`` neighbours is, the leftmost of equal ones, by doubling."""
    out, width = np.arange(len(grams)), 1
    least = lambda a, b: np.where(grams[a] <= grams[b], a, b)
    while 2 * width <= span:
        out = least(out[:-width], out[width:])
        width *= 2
    n = len(grams) - span + 1
    return least(out[:n], out[span - width : span - width + n])


def anchors(part: Slice, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(phrase hash, document, first window, number of windows) for each run of windows that picked the same phrase."""
    at = part.windows(window)
    if not len(at):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    grams = gram_hashes(part.hashes, anchor)
    picked = picks(grams, window - anchor + 1)[at]
    doc = part.doc[at]
    first = np.concatenate([[0], np.flatnonzero((np.diff(picked) != 0) | (np.diff(doc) != 0)) + 1])
    return grams[picked[first]].view(np.int64), doc[first], at[first] - part.start[doc[first]], np.diff(np.concatenate([first, [len(picked)]]))


def _places(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """A row for each picked phrase of each document: where its windows start, whether the document picked it more than
    once, and a 128-bit digest of the document's words (whole, check)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE_BYTES):
            part = Slice(texts(b.column(2)))
            phrase, doc, lo, n = anchors(part, window, anchor)
            digests = np.zeros((b.num_rows, 2), dtype=np.int64)
            for k in np.unique(doc).tolist():
                words = part.words[part.start[k] : part.start[k] + part.n[k]]
                digests[k] = np.frombuffer(xxhash.xxh3_128_digest(b" ".join(words)), dtype="<i8")
            order = np.lexsort((phrase, doc))
            same = (np.diff(phrase[order]) == 0) & (np.diff(doc[order]) == 0)
            again = np.zeros(len(phrase), dtype=bool)
            again[order[1:][same]] = True
            columns = [pa.array(phrase), *(pa.array(digests[doc, k]) for k in (0, 1)), *(b.column(k).take(pa.array(doc)) for k in (0, 1)), pa.array(lo.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(again)]
            yield pa.record_batch(columns, names=["phrase", "whole", "check", "doc_id", "version", "lo", "n", "again"])

    return docs.mapInArrow(run, "phrase long, whole long, check long, doc_id long, version long, lo int, n int, again boolean")


def _windows(marked: DataFrame, window: int) -> DataFrame:
    """Two kinds of rows: hashes of the windows in the marked ranges, and the words that these windows (or all windows, where
    the document is ``full``) cover, in pieces that end at every ``PIECE``-th window."""
    names = ["a", "b", "doc_id", "version", "pos", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE_BYTES):
            part = Slice(texts(b.column(2)))
            last = part.n - window
            lo, n = (c.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (b.column(3), b.column(4)))
            doc = np.repeat(np.arange(b.num_rows), [len(x or []) for x in b.column(3).to_pylist()])
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            doc = np.repeat(doc, n)
            inside = at <= last[doc]
            first = np.unique(part.start[doc[inside]] + at[inside])
            a, c = (gram_hashes(part.hashes, window, salt)[first] for salt in (1, 2))
            doc = part.doc[first]
            hashes = [pa.array(a.view(np.int64)), pa.array((c >> np.uint64(32)).astype(np.uint32).view(np.int32))]
            place = [*(b.column(k).take(pa.array(doc)) for k in (0, 1)), pa.array((first - part.start[doc]).astype(np.int32))]
            yield pa.record_batch([*hashes, *place, pa.nulls(len(first), pa.string())], names=names)
            full = np.flatnonzero(np.array([bool(x) for x in b.column(5).to_pylist()]) & (last >= 0))
            if len(full):
                first = np.unique(np.concatenate([first, *(np.arange(part.start[k], part.start[k] + last[k] + 1) for k in full.tolist())]))
            doc = part.doc[first]
            pos = first - part.start[doc]
            edge = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(pos // PIECE) != 0), [True]])) if len(first) else np.zeros(1, np.int64)
            head = edge[:-1]
            words = [b" ".join(part.words[i : j + window]) for i, j in zip(first[head].tolist(), first[edge[1:] - 1].tolist())]
            place = [*(b.column(k).take(pa.array(doc[head])) for k in (0, 1)), pa.array(pos[head].astype(np.int32))]
            yield pa.record_batch([pa.nulls(len(head), pa.int64()), pa.nulls(len(head), pa.int32()), *place, pa.array(words, pa.binary()).cast(pa.string())], names=names)

    return marked.mapInArrow(run, "a long, b int, doc_id long, version long, pos int, words string")


def _runs(later: DataFrame) -> DataFrame:
    """(shard, first_doc, first_pos, n): the runs of windows that each document has in the order of their first places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pos, doc, at = (b.column(k).flatten().to_numpy(zero_copy_only=False) for k in (1, 2, 3))
            row = np.repeat(np.arange(b.num_rows), np.diff(b.column(1).offsets.to_numpy()))
            order = np.lexsort((pos, row))
            pos, doc, at, row = pos[order], doc[order], at[order], row[order]
            new = np.ones(len(pos), dtype=bool)
            new[1:] = (np.diff(row) != 0) | (np.diff(pos) != 1) | (np.diff(doc) != 0) | (np.diff(at) != 1) | (at[1:] % PIECE == 0)
            head = np.flatnonzero(new)
            n = np.diff(np.concatenate([head, [len(pos)]]))
            yield pa.record_batch([b.column(0).take(pa.array(row[head])), pa.array(doc[head]), pa.array(at[head]), pa.array(n, pa.int32())], names=["shard", "first_doc", "first_pos", "n"])

    return later.mapInArrow(run, "shard int, first_doc long, first_pos int, n int")


def _cut(wanted: DataFrame, window: int) -> DataFrame:
    """(first_doc, first_pos, n, text): the words of the wanted runs of windows of each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, lo, text, runs in zip(*(b.column(k).to_pylist() for k in range(4))):
                words = text.split(" ")
                for r in runs:
                    at = r["first_pos"] - lo
                    if 0 <= at and at + r["n"] + window - 1 <= len(words):
                        rows.append((doc, r["first_pos"], r["n"], " ".join(words[at : at + r["n"] + window - 1])))
            columns = list(zip(*rows)) if rows else [()] * 4
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.string()))], names=["first_doc", "first_pos", "n", "text"])

    return wanted.mapInArrow(run, "first_doc long, first_pos int, n int, text string")


def _versions(docs: DataFrame, shards: int) -> DataFrame:
    """Documents with the key of their text and their shard; rows with equal doc_id and different texts are dealt out apart."""
    keyed = docs.withColumn("version", F.xxhash64("text"))
    return keyed.withColumn("shard", F.pmod(F.xxhash64("doc_id", "version", F.lit(7)), F.lit(shards)).cast("int"))


def passages(docs: DataFrame, window: int, anchor: int, shards: int) -> DataFrame:
    """(shard, first_doc, first_pos, text): the confirmed passages that documents of each shard may hold, with the words of their
    first places; the documents have doc_id, text, version and shard."""
    docs = docs.where("doc_id IS NOT NULL").select("doc_id", "version", "text")
    shard = F.pmod(F.xxhash64("doc_id", "version", F.lit(7)), F.lit(shards)).cast("int").alias("shard")
    places = written(_places(docs, window, anchor), "repeats-places")
    whole = places.groupBy("doc_id", "version", "whole", "check").agg(F.max(F.col("lo") + F.col("n")).alias("windows"))
    firsts = whole.groupBy("whole", "check").agg(F.min("doc_id").alias("original"), F.max("doc_id").alias("last")).where("original < last")
    # Written first, as below: a join of two read tables can split the rows of one key.
    firsts, whole = written(firsts, "repeats-originals"), written(whole, "repeats-documents")
    copies = written(whole.join(firsts, ["whole", "check"]).where("doc_id > original").select("doc_id", "version", "original", "windows"), "repeats-copies")
    originals = whole.join(firsts, ["whole", "check"]).where("doc_id = original").select("doc_id", "version", F.lit(True).alias("full"))
    # A phrase recurs if documents with different words picked it, or one document twice.
    hot = places.groupBy("phrase").agg(F.min("whole").alias("one"), F.max("whole").alias("other"), F.max("again").alias("again"))
    hot = written(hot.where("one <> other OR again").select("phrase"), "repeats-phrases")
    ranges = places.select("phrase", "doc_id", "version", "lo", "n").join(hot, "phrase", "left_semi")
    ranges = ranges.groupBy("doc_id", "version").agg(F.collect_list("lo").alias("lo"), F.collect_list("n").alias("n")).join(copies, ["doc_id", "version"], "left_anti")
    none = F.array().cast("array<int>")
    marks = written(ranges.join(originals, ["doc_id", "version"], "full_outer").withColumns({"lo": F.coalesce("lo", none), "n": F.coalesce("n", none)}), "repeats-ranges")
    spent(places, hot, firsts, whole)
    found = written(_windows(docs.join(marks, ["doc_id", "version"]).select("doc_id", "version", "text", "lo", "n", "full"), window), "repeats-windows")
    spent(marks)
    windows = found.where("words IS NULL").select("a", "b", "doc_id", "version", "pos")
    place = F.struct("doc_id", "pos")
    earliest = windows.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    # Written first: the join then deals both sides out anew, and a window that very many documents share can be split.
    earliest = written(earliest.select("a", "b", "first"), "repeats-earliest")
    later = windows.join(earliest, ["a", "b"]).where("struct(doc_id, pos) <> first").groupBy("doc_id", "version").agg(
        F.collect_list("pos").alias("pos"), F.collect_list("first.doc_id").alias("first_doc"), F.collect_list("first.pos").alias("first_pos")
    )
    copied = copies.select(shard, F.col("original").alias("first_doc"), "windows", F.explode(F.sequence(F.lit(0), F.col("windows") - 1, F.lit(PIECE))).alias("first_pos"))
    copied = copied.select("shard", "first_doc", "first_pos", F.least(F.lit(PIECE), F.col("windows") - F.col("first_pos")).alias("n"))
    wanted = written(_runs(later.select(shard, "pos", "first_doc", "first_pos")).unionByName(copied).distinct(), "repeats-wanted")
    spent(earliest, copies)
    block = lambda c: F.floor(F.col(c) / PIECE).alias("block")
    runs = wanted.select("first_doc", "first_pos", "n").distinct().groupBy("first_doc", block("first_pos")).agg(F.collect_list(F.struct("first_pos", "n")).alias("runs"))
    pieces = found.where("words IS NOT NULL").select(F.col("doc_id").alias("first_doc"), block("pos"), "pos", "words")
    cut = written(_cut(runs.join(pieces, ["first_doc", "block"]).select("first_doc", "pos", "words", "runs"), window).distinct(), "repeats-words")
    spent(found)
    out = written(wanted.join(cut, ["first_doc", "first_pos", "n"]).select("shard", "first_doc", "first_pos", "text"), "repeats")
    spent(wanted, cut)
    return out


class Automaton:
    """The passages of a shard, and where documents have them."""

    def __init__(self, passages: list[tuple[int, int, bytes]]) -> None:
        self.ids: dict[bytes, int] = {}
        self.found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        least: dict[bytes, tuple[int, int]] = {}
        for doc, pos, text in passages:
            least[text] = min((doc, pos), least.get(text, (doc, pos)))
        ids = self.ids
        for text, first in least.items():
            key = tuple([ids.setdefault(w, len(ids) + 1) for w in text.split(b" ")])
            self.found.add_word(key, (len(key), first))
        if least:
            self.found.make_automaton()

    def kept(self, doc_id: int | None, words: list[bytes]) -> list[bytes] | None:
        """The words that stay, None if all do."""
        if doc_id is None or not len(self.found):
            return None
        known = self.ids.get
        spans = [(end - size + 1, end + 1) for end, (size, first) in self.found.iter(tuple([known(w, 0) for w in words])) if first < (doc_id, end - size + 1)]
        if not spans:
            return None
        keep = np.ones(len(words), dtype=bool)
        for lo, hi in spans:
            keep[lo:hi] = False
        return [w for w, k in zip(words, keep.tolist()) if k]


def stream(docs: DataFrame, passages: DataFrame, shards: int, kind: str = "int") -> DataFrame:
    """All documents (doc_id, text, shard, rest) through the automata of their shards' passages, shard after shard, one automaton at a time."""
    tasks = max(1, min(shards // SHARDS_A_TASK, TASKS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    each = passages.select("shard", F.lit(0).alias("document"), F.col("first_doc").alias("doc_id"), F.col("first_pos").alias("pos"), "text", F.lit(None).cast(kind).alias("rest"))
    each = each.unionByName(docs.select("shard", F.lit(1).alias("document"), "doc_id", F.lit(None).cast("int").alias("pos"), "text", "rest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, automaton = None, [], None
        for b in slices(batches, "text", SLICE_BYTES):
            n_words, n_removed, kept, rows = [], [], [], []
            for k, (s, document, doc_id, pos, t) in enumerate(zip(*(b.column(i).to_pylist() for i in range(4)), texts(b.column(4)))):
                if s != shard:
                    shard, held, automaton = s, [], None
                if not document:
                    held.append((doc_id, pos, t))
                    continue
                if automaton is None:
                    automaton, held = Automaton(held), []
                words = t.split()
                left = automaton.kept(doc_id, words)
                rows.append(k)
                n_words.append(len(words))
                n_removed.append(0 if left is None else len(words) - len(left))
                kept.append(t if left is None else b" ".join(left))
            at = pa.array(rows, pa.int64())
            yield pa.record_batch([b.column(2).take(at), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), b.column(5).take(at)], names=["doc_id", "n_words", "n_removed", "text", "rest"])

    return each.repartition(tasks, "shard").sortWithinPartitions("shard", "document").mapInArrow(run, f"doc_id long, n_words long, n_removed long, text string, rest {kind}")


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Each row's doc_id, n_words, n_removed, kept text (unchanged if nothing goes, else kept words with single spaces) and
    its other columns in the struct ``rest`` (null if there are none)."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(None).cast("int")
    kind = docs.select(rest.alias("rest")).schema["rest"].dataType.simpleString()
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), rest.alias("rest"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, math.ceil(size / shard_bytes))
    docs = _versions(docs, shards)
    return stream(docs, passages(docs.select("doc_id", "version", "text"), window, anchor, shards), shards, kind)


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums = [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in texts(b.column(3))]
            yield pa.record_batch([*b.columns[:3], pa.array(sums, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.mapInArrow(digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")
