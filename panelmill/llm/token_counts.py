"""Operator 1: token counts by a separator scan of flat token files.

A flat token file is a run of token ids of fixed width in which an end-of-document id follows each document; there is no
index. It is read in blocks that know nothing of documents. Each block is searched for the separator with one vector
comparison and gives one short row: how many separators it has, the ids before the first and after the last, and the
lengths between them. A prefix scan over the blocks of a file (running sums ordered by block number) then gives each block
the number of documents that ended before it and the length of the piece that hangs over from earlier blocks, so a
document that spans many blocks is stitched from their sums alone.

``write_flat`` makes such files from texts: blocks of a binary column, written by Spark, cut at fixed sizes and not at
documents. ``scan_flat`` reads them, or real binary files given as (file, block, data) rows.

Nulls: a null text is an empty document (0 tokens), as is an empty text; a null doc_id is kept. A file that doesn't end
with a separator has one last document without one. Rows with equal doc_id are counted one by one. An empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmill.llm.text import slices, texts
from panelmill.session import written

BLOCK_TOKENS = 1 << 17
_CODERS: dict[str, object] = {}


def coder(path: str | None = None):
    """The byte-level BPE encoder and its separator id; the vocabulary file is read where the task runs."""
    import base64

    import public_tokenizers
    import tiktoken

    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    if path not in _CODERS:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _CODERS[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _CODERS[path], 50256


def write_flat(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, vocabulary: str | None = None) -> DataFrame:
    """Flat files of 16-bit ids, one for each partition: rows (file, block, data, ends), written in the shared folder.

    ``ends`` names the documents that end in the block, for reports only; the scan doesn't read it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, separator = coder(vocabulary)
        file, block, held, ends, size = None, 0, [], [], 0

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal block, held, ends, size
            data = np.concatenate(held) if held else np.zeros(0, dtype=np.uint16)
            at = 0
            while len(data) - at >= block_tokens or (last and at < len(data)):
                part = data[at : at + block_tokens]
                n = int((part == separator).sum())
                yield pa.record_batch([pa.array([file]), pa.array([block], pa.int64()), pa.array([part.astype("<u2").tobytes()], pa.binary()), pa.array([ends[:n]], pa.list_(pa.int64()))], names=["file", "block", "data", "ends"])
                ends, block, at = ends[n:], block + 1, at + len(part)
            held, size = [data[at:]], len(data) - at

        for b in slices(batches, "text", 1 << 20):
            for doc_id, t in zip(b.column(0).to_pylist(), texts(b.column(1))):
                file = file if file is not None else f"part-{b.column(2)[0].as_py():05d}"
                ids = np.array([*encoding.encode_ordinary(t.decode()), separator], dtype=np.uint16)
                held.append(ids)
                ends.append(doc_id)
                size += len(ids)
                if size >= 4 * block_tokens:
                    yield from cut(False)
        yield from cut(True)

    numbered = docs.select(F.col("doc_id").cast("long"), "text", F.spark_partition_id().alias("part"))
    return written(numbered.mapInArrow(run, "file string, block long, data binary, ends array<long>"), "flat-tokens")


def scan_flat(flat: DataFrame, separator: int, dtype: str = "<u2") -> DataFrame:
    """A row for each document of each file: (file, ordinal, n_tokens), ordinal from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, sizes, lengths = [], [], []
            for data in b.column(2).to_pylist():
                at = np.flatnonzero(np.frombuffer(data or b"", dtype=dtype) == separator)
                size = len(data or b"") // np.dtype(dtype).itemsize
                n.append(len(at))
                sizes.append(size)
                # ids before each separator since the last one, then those after the last separator
                lengths.append(np.diff(np.concatenate([[-1], at, [size]])) - 1)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(sizes, pa.int64()), pa.array(lengths, pa.list_(pa.int64()))], names=["file", "block", "n", "size", "lengths"])

    found = flat.select("file", "block", "data").mapInArrow(run, "file string, block long, n long, size long, lengths array<long>")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # The piece that hangs over: everything since the last separator of the file's earlier blocks.
    seen = found.withColumns({"ended": F.coalesce(F.sum("n").over(before), F.lit(0)), "passed": F.coalesce(F.sum("size").over(before), F.lit(0))})
    mark = F.when(F.col("n") > 0, F.col("passed") + F.col("size") - F.element_at("lengths", -1))
    seen = seen.withColumn("since", F.coalesce(F.max(mark).over(before), F.lit(0)))
    last = F.row_number().over(Window.partitionBy("file").orderBy(F.desc("block"))) == 1
    seen = seen.withColumn("last", last)
    each = seen.select("file", "ended", "passed", "since", "n", "last", F.posexplode("lengths").alias("k", "own"))
    over = F.when(F.col("k") == 0, F.col("passed") - F.col("since")).otherwise(F.lit(0))
    each = each.where((F.col("k") < F.col("n")) | (F.col("last") & (F.col("own") + over > 0)))
    return each.select("file", (F.col("ended") + F.col("k")).alias("ordinal"), (F.col("own") + over).alias("n_tokens"))


def count_tokens(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of each document, by way of flat files."""
    flat = write_flat(docs, block_tokens, vocabulary)
    ended = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    names = flat.select("file", "block", "ends").withColumn("ended", F.coalesce(F.sum(F.size("ends")).over(ended), F.lit(0)))
    names = names.select("file", F.posexplode("ends").alias("k", "doc_id"), "ended").select("file", (F.col("ended") + F.col("k")).alias("ordinal"), "doc_id")
    return names.join(scan_flat(flat, 50256), ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal")


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
