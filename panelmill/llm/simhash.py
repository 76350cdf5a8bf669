"""Operator 8: SimHash near-dedup by covering locality-sensitive hashing.

Every word shingle votes with its XXH64 (seed 42) on 64 bits. Fingerprints are linked if they differ in at most
``radius`` bits. Candidates come from covering codes (Pagh, "Locality-sensitive hashing without false negatives"):
bit i gets a non-zero vector m(i) of radius + 1 bits; table v keeps the bits whose m(i) has an odd product with v.
Up to ``radius`` differing bits span at most ``radius`` dimensions, so some v is orthogonal to all of them, and that
table's mask holds none of them: every pair within the radius collides in some table.

Equal fingerprints are one row from the start, so a group of exact copies costs one row. A bucket with more than
``MAX_BUCKET`` fingerprints is covered again over the bits its mask leaves free; after three levels a bucket is
bounded by the few bits still free, so no bucket is cut and none is large. Inside a bucket only a spanning forest of
the links leaves the task.

Nulls: a null text is an empty one; texts without words have fingerprint zero and are linked like any other. Rows with
the same doc_id are one document, whatever their texts: their fingerprints are linked, and each row is returned. A null
doc_id is kept: it gets the component of its fingerprint's documents, null if there is no other. Empty tables give no rows.
Other columns are not read. Joins back to the documents read written tables, so that Spark can split a fingerprint that very
many documents have (all empty texts).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.components import components
from panelmill.llm.text import slices, texts
from panelmill.session import spent, written

RADIUS = 3
MAX_BUCKET = 1024
BITS = 64


def fingerprint(text: bytes, shingle: int = 3) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        end = np.cumsum(size + 1) - 1
        start = end - size
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(start[: len(words) - shingle + 1].tolist(), end[shingle - 1 :].tolist())]
    votes = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, len(hashes), 8192):
        part = np.array(hashes[lo : lo + 8192], dtype=">u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            found = np.array([fingerprint(t, shingle) for t in texts(b.column(1))], dtype=np.uint64).view(np.int64)
            yield pa.record_batch([b.column(0), pa.array(found)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks over ``bits`` such that any ``radius`` of the bits are all left out by at least one mask."""
    vectors = (1 << (radius + 1)) - 1
    m = {bit: 1 + k % vectors for k, bit in enumerate(bits)}
    return [sum(1 << bit for bit in bits if (m[bit] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def nested_masks(radius: int, levels: int) -> list[list[int]]:
    """Level 0: covering masks of all bits. Level n: each mask of level n - 1 with each covering mask of the bits it leaves free."""
    out = [covering_masks(list(range(BITS)), radius)]
    for _ in range(levels - 1):
        out.append([m | s for m in out[-1] for s in covering_masks([b for b in range(BITS) if not m >> b & 1], radius)])
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links in one bucket."""
    near = np.bitwise_count((fps[:, None] ^ fps[None, :]).view(np.uint64)) <= radius
    left = np.ones(len(fps), dtype=bool)
    edges: list[tuple[int, int]] = []
    for root in range(len(fps)):
        if left[root]:
            left[root] = False
            queue = [root]
            while queue:
                at = queue.pop()
                for other in np.flatnonzero(near[at] & left).tolist():
                    left[other] = False
                    edges.append((int(fps[at]), int(fps[other])))
                    queue.append(other)
    return edges


def links(fps: DataFrame, radius: int = RADIUS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Edges (u, v) between distinct fingerprints whose closure is the closure of all links within the radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(0)
            values = col.flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(pc.list_value_length(col).to_numpy(zero_copy_only=False))])
            edges = [e for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()) for e in _forest(values[lo:hi], radius)]
            yield pa.record_batch([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["u", "v"])

    found = None
    rows = fps.select("fp", F.lit(0).alias("path"))
    width = (1 << (radius + 1)) - 1
    levels = nested_masks(radius, 3)
    for level, masks in enumerate(levels):
        table = F.array(*[F.lit(_signed(m)) for m in masks])
        each = rows.select("fp", F.explode(F.sequence(F.col("path") * width, F.col("path") * width + width - 1)).alias("path"))
        each = each.select("fp", "path", F.col("fp").bitwiseAND(F.get(table, F.col("path"))).alias("key"))
        sized = each.groupBy("path", "key").agg(F.count("*").alias("n")).where("n > 1")
        last = level == len(levels) - 1
        fits = sized if last else sized.where(F.col("n") <= max_bucket)
        buckets = each.join(fits.select("path", "key"), ["path", "key"]).groupBy("path", "key").agg(F.collect_list("fp").alias("fps"))
        edges = buckets.select("fps").mapInArrow(run, "u long, v long").distinct()
        found = edges if found is None else found.union(edges)
        if last:
            break
        large = written(sized.where(F.col("n") > max_bucket).select("path", "key"), "simhash-large")
        if large.isEmpty():
            break
        rows = written(each.join(large, ["path", "key"]).select("fp", "path"), "simhash-dense")
    return found.distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = RADIUS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the least doc_id reachable over links, the document's own included."""
    marked = written(fingerprints(docs, shingle), "simhash")
    firsts = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    several = marked.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("u"), F.max("fp").alias("other")).where("u <> other").select("doc_id", "u")
    same_id = marked.join(written(several, "simhash-ids"), "doc_id").where("u <> fp").select("u", F.col("fp").alias("v")).distinct()
    edges = written(links(firsts.select("fp"), radius, max_bucket).union(same_id), "simhash-links")
    reached = components(edges, "simhash-cc")
    classes = firsts.join(reached, firsts.fp == reached.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("class"))
    named = written(classes, "simhash-classes")
    spent(firsts, edges)
    names = named.groupBy("class").agg(F.min("first").alias("component_id"))
    return marked.join(named.join(names, "class").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
