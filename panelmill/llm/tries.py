"""Operator 12: the trie of rebuilt conversations, by double arrays.

A conversation is rebuilt from the first turns of the first conversation of its five and its own later ones. Each distinct sequence of
first turns is a node.

1. Turns are range-partitioned in their order and cut into segments of at most ``SEGMENT`` turns, so a conversation may be of any
   length; running sums over its few segments give each its place. A turn is a 128-bit hash of role and text and its text's bytes; texts
   don't move. The heads of eight turns at most are joined to their five conversations.
2. A node's key is the combination of the hashes of its turns with their places, and depth. Segments are range-partitioned by the
   key they start from, their first turns and conversation: a prefix shard is a stretch of that order, so that a first turn that a
   third of all conversations share is divided like any other.
3. Each shard numbers its turns densely and packs its segments into BASE and CHECK arrays: from slot s, turn t leads to
   BASE[s] + t if CHECK holds s there. Traversing them counts the members of each slot.
4. Few nodes, the upper ones, are in several shards. Counts and smallest members are added up for each key. A conversation owns the
   nodes of which it is the smallest member, which are the last ones of its path; from where it starts to own, and whether its end is
   childless, everything summed over subtrees follows turn by turn: a turn that isn't owned saves its text, an owned one is a child of
   the node above, an owned childless end is a leaf. The shards traverse again and sum these; sums are merged by key as well.
5. Ends are sorted by node and conv_id, joined into runs, and streamed into each node's digest.

Nulls: null turns come first, a null role or text is empty; rows with a null conv_id belong to no conversation and are left out. Equal
turns of a conversation are ordered by role and a hash of the text; repeated rows are turns of their own. A conversation that is left without
turns is a member of the root. conv_id - conv_id % 5 uses the remainder from 0 to 4, for negative ids too. An empty table has no nodes.
Other columns are not read. Turns are told apart by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmill.llm.text import mix
from panelmill.session import spent, written

FAMILY = 5
HEADS = 9  # a head has fewer turns than this
SEGMENT = 1024
SHARD_TURNS = 300_000
ENDS_A_RUN = 8192
TURNS = "array<struct<a:bigint,b:bigint,bytes:int>>"


def _segments(turns: DataFrame, segment: int, partitions: int | None) -> DataFrame:
    """(conv, start, n, total, turns): the original turns of each conversation in order."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long"), role.alias("role"), F.xxhash64(role, text).alias("a"), F.xxhash64(text, F.lit(12), role).alias("b"), F.octet_length(text).alias("bytes"), F.monotonically_increasing_id().alias("row")
    )
    order = ["conv", "turn", "role", "a", "b", "row"]
    rows = rows.repartitionByRange(*([partitions] if partitions else []), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            conv = b.column(0).to_numpy()
            cut = np.flatnonzero(np.diff(conv)) + 1
            edges = np.unique(np.concatenate([[0, len(conv)], cut, *[np.arange(i, j, segment) for i, j in zip(np.append(0, cut), np.append(cut, len(conv)))]])).astype(np.int32)
            turn = pa.StructArray.from_arrays([b.column(3), b.column(4), b.column(5)], names=["a", "b", "bytes"])
            n = len(edges) - 1
            columns = [pa.array([part] * n, pa.int32()), pa.array(range(seq, seq + n), pa.int64()), pa.array(conv[edges[:-1]]), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), turn)]
            seq += n
            yield pa.record_batch(columns, names=["part", "seq", "conv", "turns"])

    found = written(rows.mapInArrow(run, f"part int, seq bigint, conv bigint, turns {TURNS}"), "trie-segments")
    own = Window.partitionBy("conv")
    before = own.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    n = F.size("turns").cast("long")
    return found.select("conv", "turns", F.coalesce(F.sum(n).over(before), F.lit(0)).alias("start"), F.sum(n).over(own).alias("total"))


def rebuilt(turns: DataFrame, segment: int = SEGMENT, partitions: int | None = None) -> DataFrame:
    """(conv, start, length, turns): the turns of each rebuilt conversation; start counts those before, length all of them."""
    own = written(_segments(turns, segment, partitions), "trie-turns")
    most = F.lit(HEADS - 1)
    first = own.where(F.col("start") < most).select("conv", "start", F.slice("turns", 1, (most - F.col("start")).cast("int")).alias("turns"))
    heads = first.groupBy("conv").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("start", "turns"))), lambda x: x["turns"])).alias("head"))
    h = (F.crc32(F.col("conv").cast("string")) % HEADS).cast("int")
    wanted = own.where("start = 0").select("conv", h.alias("h"), (F.col("conv") - F.pmod("conv", F.lit(FAMILY))).alias("base"))
    heads = heads.withColumnRenamed("conv", "base")
    head = F.coalesce(F.slice("head", 1, F.col("h")), F.array().cast(TURNS))
    heads = wanted.join(heads, "base", "left").select("conv", "h", head.alias("head"))
    rows = own.join(heads, "conv")
    drop = F.greatest(F.col("h") - F.col("start"), F.lit(0)).cast("int")
    kept = F.slice("turns", drop + 1, F.greatest(F.size("turns") - drop, F.lit(0)))
    place = F.when(F.col("start") == 0, 0).otherwise(F.col("start") + drop - F.col("h") + F.size("head")).cast("long")
    length = F.size("head") + F.greatest(F.col("total") - F.col("h"), F.lit(0))
    rows = rows.select("conv", place.alias("start"), length.cast("long").alias("length"), F.when(F.col("start") == 0, F.concat("head", kept)).otherwise(kept).alias("turns"), (F.col("start") == 0).alias("first"))
    out = written(rows.where("size(turns) > 0 OR first AND length = 0").drop("first"), "trie-rebuilt")
    spent(own)
    return out


def _steps(a: np.ndarray, b: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each turn adds to the two halves of a node's key."""
    place = place.astype(np.uint64)
    with np.errstate(over="ignore"):
        return mix(a.view(np.uint64) ^ mix(place * np.uint64(2) + np.uint64(1))), mix(b.view(np.uint64) + mix(place * np.uint64(2)))


def _flat(b: pa.RecordBatch, column: str) -> tuple[np.ndarray, ...]:
    """(a, b, bytes, number of turns of each row) of a column of turns."""
    col = b.column(b.schema.get_field_index(column))
    n = np.diff(col.offsets.to_numpy()).astype(np.int64)
    flat = col.flatten()
    return (*(flat.field(k).to_numpy(zero_copy_only=False) for k in range(3)), n)


def _keyed(rows: DataFrame) -> DataFrame:
    """With the key (k1, k2) of the node that each segment starts from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y, _, n = _flat(b, "turns")
            start = np.repeat(b.column(1).to_numpy() - (np.cumsum(n) - n), n) + np.arange(len(x))
            sums = []
            for step in _steps(x, y, start):
                total = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(step)]) if len(step) else np.zeros(1, np.uint64)
                end = np.cumsum(n)
                sums.append(pa.array((total[end] ^ total[end - n]).view(np.int64)))
            yield pa.record_batch([*b.columns, *sums], names=[*b.schema.names, "x1", "x2"])

    found = rows.mapInArrow(run, f"conv bigint, start bigint, length bigint, turns {TURNS}, x1 bigint, x2 bigint")
    before = Window.partitionBy("conv").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    key = lambda x: F.coalesce(F.bit_xor(x).over(before), F.lit(0))
    whole = F.size("turns") == F.col("length")
    alone = found.where(whole).select("conv", "start", "length", "turns", F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"))
    return alone.unionByName(found.where(~whole).select("conv", "start", "length", "turns", key("x1").alias("k1"), key("x2").alias("k2")))


class DoubleArray:
    """A trie in two arrays. Rows are sequences of dense symbols from 1 on; slot 0 is the root."""

    def __init__(self, parent: np.ndarray, symbol: np.ndarray) -> None:
        """Of nodes 1.. with their parents (0 is the root) and symbols; a node's parent stands before it."""
        n = len(parent)
        order = np.lexsort((symbol, parent))
        owner, label = parent[order], symbol[order]
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        count = np.diff(np.append(first, n))
        top = int(symbol.max(initial=0)) + 1
        self.base = np.zeros(2 * n + 2 * top + 2, dtype=np.int64)
        self.check = np.full(len(self.base), -1, dtype=np.int64)
        self.check[0] = -2  # the root is nobody's child
        slot = np.zeros(n + 1, dtype=np.int64)
        base_of = np.zeros(n + 1, dtype=np.int64)
        used = self.check != -1
        low = 1
        many = np.flatnonzero(count > 1)
        for k in many[np.argsort(-count[many], kind="stable")].tolist():
            labels = label[first[k] : first[k] + count[k]]
            while used[low]:
                low += 1
            base, at = 0, low
            for _ in range(64):
                base = at - labels[0]
                if labels[-1] + base >= len(used):
                    break
                if not used[base + labels].any():
                    break
                at += 1
                while at < len(used) and used[at]:
                    at += 1
            need = int(labels[-1] + base) + 1
            if need > len(used) or used[base + labels].any():
                base = int(np.flatnonzero(used)[-1]) + 1 - int(labels[0])
                need = int(labels[-1] + base) + 1
            if need > len(used):
                more = max(need, 2 * len(used)) - len(used)
                used = np.concatenate([used, np.zeros(more, bool)])
            used[base + labels] = True
            base_of[owner[first[k]]] = base
            slot[order[first[k] : first[k] + count[k]] + 1] = base + labels
        # Nodes with one child fill what is free, all at once.
        single = first[count == 1]
        free = np.flatnonzero(~used)
        free = free[free > 0]
        if len(free) < len(single):
            free = np.concatenate([free, np.arange(len(used), len(used) + len(single) - len(free))])
        slot[order[single] + 1] = free[: len(single)]
        base_of[owner[single]] = free[: len(single)] - label[single]
        size = max(len(used), int(slot.max(initial=0)) + 1)
        self.base, self.check = np.zeros(size, dtype=np.int64), np.full(size, -1, dtype=np.int64)
        self.check[slot[1:]] = slot[parent]
        self.base[slot] = base_of

    def step(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The slots that ``symbol`` leads to, -1 where it leads nowhere."""
        to = self.base[at] + symbol
        inside = (to > 0) & (to < len(self.check))
        to = np.where(inside, to, 0)
        return np.where(inside & (self.check[to] == at), to, -1)

    @classmethod
    def of(cls, n: np.ndarray, symbols: np.ndarray) -> tuple[DoubleArray, np.ndarray]:
        """Of sequences (``n`` symbols each, one after another), with the symbols renumbered densely by the nodes they first lead to, so
        that siblings tend to have neighbouring numbers."""
        start = np.cumsum(n) - n
        at = np.zeros(len(n), dtype=np.int64)
        parents, labels, nodes = [], [], 0
        for depth in range(int(n.max(initial=0))):
            live = np.flatnonzero(n > depth)
            pair = np.stack([at[live], symbols[start[live] + depth]])
            by = np.lexsort(pair[::-1])
            new = np.concatenate([[True], (np.diff(pair[:, by], axis=1) != 0).any(axis=0)])
            number = np.empty(len(by), dtype=np.int64)
            number[by] = nodes + np.cumsum(new)
            parents.append(pair[0, by[new]])
            labels.append(pair[1, by[new]])
            nodes += int(new.sum())
            at[live] = number
        none = np.zeros(0, np.int64)
        parent, label = np.concatenate([none, *parents]), np.concatenate([none, *labels])
        values, first, back = np.unique(label, return_index=True, return_inverse=True)
        dense = np.empty(len(values), dtype=np.int64)
        dense[np.argsort(first)] = np.arange(1, len(values) + 1)
        return cls(parent, dense[back]), dense[np.searchsorted(values, symbols)] if len(symbols) else symbols

    def slots(self, n: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The slot that each symbol of each sequence leads to."""
        start = np.cumsum(n) - n
        out = np.full(len(symbols), -1, dtype=np.int64)
        at = np.zeros(len(n), dtype=np.int64)
        for depth in range(int(n.max(initial=0))):
            live = np.flatnonzero(n > depth)
            at[live] = self.step(at[live], symbols[start[live] + depth])
            out[start[live] + depth] = at[live]
        return out


NODE = "k1 bigint, k2 bigint, depth bigint, p1 bigint, p2 bigint, n bigint, owner bigint, child boolean, bytes int"
ROW = "conv bigint, start bigint, length bigint, slots array<int>, sizes array<int>, e1 bigint, e2 bigint"


def _shard(number: int, b: pa.RecordBatch) -> pa.Table:
    """The nodes of a shard's trie and its rows with their slots."""
    conv, start, length = (b.column(k).to_numpy() for k in (0, 1, 2))
    x, y, size, n = _flat(b, "turns")
    roots = np.stack([b.column(k).to_numpy() for k in (4, 5)])
    head = np.cumsum(n) - n
    row = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(x)) - head[row] + start[row]
    keys = []
    for step, root in zip(_steps(x, y, place), roots.view(np.uint64)):
        total = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(step)]) if len(step) else np.zeros(1, np.uint64)
        keys.append((total[1:] ^ total[head[row]] ^ root[row]).view(np.int64))
    # The node that a row starts from is its first symbol.
    turn = np.unique(np.stack([x, y]), axis=1, return_inverse=True)[1].ravel() if len(x) else np.zeros(0, np.int64)
    origin = np.unique(np.stack([*roots, start]), axis=1, return_inverse=True)[1].ravel()
    first = np.cumsum(n + 1) - n - 1
    symbols = np.empty(len(x) + len(n), dtype=np.int64)
    symbols[first] = origin
    inner = np.arange(len(x)) + row + 1
    symbols[inner] = turn + len(n)
    trie, symbols = DoubleArray.of(n + 1, symbols)
    slots = trie.slots(n + 1, symbols)
    # Nodes: the turns of all rows, and the root from the rows that start there.
    depth = np.full(len(symbols), 0, dtype=np.int64)
    depth[inner] = place + 1
    counted = np.ones(len(symbols), dtype=bool)
    counted[first] = start == 0
    who = np.empty(len(symbols), dtype=np.int64)
    who[first], who[inner] = np.arange(len(n)), row
    k = [np.zeros(len(symbols), dtype=np.int64) for _ in range(2)]
    for half, mine, root in zip(k, keys, roots):
        half[inner], half[first] = mine, root
    bytes_ = np.zeros(len(symbols), dtype=np.int64)
    bytes_[inner] = size
    at = np.flatnonzero(counted)
    used, one, back = np.unique(slots[at], return_index=True, return_inverse=True)
    one = at[one]
    members = np.bincount(back, minlength=len(used))
    owner = np.full(len(used), np.iinfo(np.int64).max)
    np.minimum.at(owner, back, conv[who[at]])
    child = np.bincount(back, weights=length[who[at]] > depth[at], minlength=len(used)) > 0
    above = np.maximum(one - 1, 0)  # the symbol before a turn's is that of its parent
    top = depth[one] == 0
    m = len(used)
    end = start + n == length
    last = first + n
    ends = [pa.array(np.where(end, half[last], 0), mask=~end) for half in k]
    offsets = pa.array(np.append(first, len(symbols)).astype(np.int32))
    nodes = {"kind": pa.array([0] * m, pa.int32()), "shard": pa.array([number] * m, pa.int64()), "slot": pa.array(used.astype(np.int32)), "k1": pa.array(k[0][one]), "k2": pa.array(k[1][one]), "depth": pa.array(depth[one])}
    nodes |= {"p1": pa.array(k[0][above], mask=top), "p2": pa.array(k[1][above], mask=top), "n": pa.array(members), "owner": pa.array(owner), "child": pa.array(child), "bytes": pa.array(bytes_[one].astype(np.int32))}
    rows = {"kind": pa.array([1] * len(n), pa.int32()), "shard": pa.array([number] * len(n), pa.int64()), "conv": b.column(0), "start": b.column(1), "length": b.column(2)}
    rows |= {"slots": pa.ListArray.from_arrays(offsets, pa.array(slots.astype(np.int32))), "sizes": pa.ListArray.from_arrays(offsets, pa.array(bytes_.astype(np.int32))), "e1": ends[0], "e2": ends[1]}
    return pa.concat_tables([pa.table(nodes), pa.table(rows)], promote_options="default")


def _packed(rows: DataFrame, shard_turns: int, partitions: int | None) -> DataFrame:
    """The nodes (kind 0) and the placed rows (kind 1) of all prefix shards."""
    lead = F.transform(F.slice("turns", 1, 8), lambda t: t["a"])
    rows = rows.withColumn("lead", lead).repartitionByRange(*([partitions] if partitions else []), "k1", "k2", "lead", "conv").sortWithinPartitions("k1", "k2", "lead", "conv").drop("lead")
    schema = f"kind int, shard bigint, slot int, {NODE}, {ROW}"
    names = [c.strip().split(" ")[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, turns = TaskContext.get().partitionId() << 32, [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks()
            yield from _shard(number, whole.to_batches()[0]).select(names).to_batches(max_chunksize=50_000)

        for b in batches:
            held.append(b)
            turns += b.num_rows + len(b.column(3).flatten())
            if turns >= shard_turns:
                yield from packed()
                number, held, turns = number + 1, [], 0
        if turns:
            yield from packed()

    return rows.select("conv", "start", "length", "turns", "k1", "k2").mapInArrow(run, schema)


def _sums(nodes: pa.Table, rows: pa.Table) -> pa.Table:
    """What a shard's rows add to the sums over the subtrees of its nodes."""
    slot = nodes.column("slot").to_numpy()
    by = np.argsort(slot)
    out = {c: nodes.column(c).take(pa.array(by)) for c in ("k1", "k2", "depth")}
    slot = slot[by]
    start, length, since, leaf, rest = (rows.column(c).to_numpy() for c in ("start", "length", "since", "leaf", "rest"))
    lists = rows.column("slots").combine_chunks()
    n = np.array([len(x) for x in lists], dtype=np.int64)
    slots, sizes = (rows.column(c).combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("slots", "sizes"))
    row = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    depth = np.arange(len(slots)) - first[row] + start[row]
    saves = np.where(depth < since[row], sizes, 0)
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(saves)])
    behind = total[(first + n)[row]] - total[:-1] + rest[row]
    counted = (depth > start[row]) | (start[row] == 0)
    at = np.searchsorted(slot, slots[counted])

    def add(x: np.ndarray) -> pa.Array:
        sums = np.zeros(len(slot), dtype=np.int64)
        np.add.at(sums, at, x[counted].astype(np.int64))
        return pa.array(sums)

    out["n_children"] = add((depth >= since[row] - 1) & (depth < length[row]))
    out["n_leaves"] = add(leaf[row])
    out["saved_tokens"] = add(behind)
    return pa.table(out)


def _digests(ends: DataFrame, tasks: int) -> DataFrame:
    """(k1, k2, depth, ends_sha256) of the nodes at which conversations end; ends is (k1, k2, depth, conv)."""
    key = ["k1", "k2", "depth"]
    ends = ends.repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = [b.column(k).to_numpy() for k in range(4)]
            new = np.concatenate([[True], np.any([np.diff(c) != 0 for c in columns[:3]], axis=0)])
            new[::ENDS_A_RUN] = True
            head = np.flatnonzero(new)
            ids = [",".join(map(str, columns[3][i:j].tolist())) for i, j in zip(head.tolist(), np.append(head[1:], len(new)).tolist())]
            yield pa.record_batch([*(pa.array(c[head]) for c in columns), pa.array(ids, pa.string())], names=[*key, "conv", "ids"])

    runs = written(ends.mapInArrow(run, "k1 bigint, k2 bigint, depth bigint, conv bigint, ids string"), "trie-ends")
    sorted_runs = runs.repartition(tasks, *key).sortWithinPartitions(*key, "conv")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, hashlib.sha256()
        for b in batches:
            out = []
            for *node, _, ids in zip(*(c.to_pylist() for c in b.columns)):
                if node == now:
                    sha.update(b",")
                else:
                    if now:
                        out.append((*now, sha.hexdigest()))
                    now, sha = node, hashlib.sha256()
                sha.update(ids.encode())
            if out:
                yield pa.record_batch([pa.array(c) for c in zip(*out)], names=[*key, "ends_sha256"])
        if now:
            yield pa.record_batch([pa.array([c]) for c in (*now, sha.hexdigest())], names=[*key, "ends_sha256"])

    return sorted_runs.mapInArrow(digest, "k1 bigint, k2 bigint, depth bigint, ends_sha256 string")


def trie(turns: DataFrame, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS, partitions: int | None = None) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of each node."""
    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rebuilt(turns, segment, partitions)
    found = written(_packed(_keyed(rows), shard_turns, partitions), "trie-shards")
    spent(rows)
    key = ["k1", "k2", "depth"]
    partial, placed = found.where("kind = 0"), found.where("kind = 1")
    nodes = partial.groupBy(*key).agg(F.sum("n").alias("n_convs"), F.min("owner").alias("conv_id"), F.max("child").alias("child"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    nodes = written(nodes, "trie-nodes")
    owners = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.min("depth").alias("since"), F.max(~F.col("child")).alias("leaf"))
    placed = placed.select(F.col("shard").alias("shard"), "conv", "start", "length", "slots", "sizes").join(owners, "conv", "left")
    since = F.coalesce("since", F.col("length") + 1).cast("long")
    placed = placed.withColumns({"since": since, "leaf": F.coalesce("leaf", F.lit(False))})
    # Texts that the later segments of a conversation save count at the nodes of its earlier ones.
    whole = F.size("slots") == F.col("length") + 1
    saves = F.aggregate(F.slice("sizes", 1, F.greatest(F.least(F.col("since") - F.col("start"), F.size("slots").cast("long")), F.lit(0)).cast("int")), F.lit(0).cast("long"), lambda s, x: s + x)
    later = Window.partitionBy("conv").orderBy(F.desc("start")).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.where(whole).withColumn("rest", F.lit(0).cast("long")).unionByName(placed.where(~whole).withColumn("rest", F.coalesce(F.sum(saves).over(later), F.lit(0))))
    left, right = (x.repartition(tasks, "shard").groupBy("shard") for x in (partial.select("shard", "slot", *key), placed))
    sums = left.cogroup(right).applyInArrow(_sums, "k1 bigint, k2 bigint, depth bigint, n_children bigint, n_leaves bigint, saved_tokens bigint")
    ends = found.where("kind = 1 AND e1 IS NOT NULL").select(F.col("e1").alias("k1"), F.col("e2").alias("k2"), F.col("length").alias("depth"), "conv")
    sums = sums.groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    # Read from a written table on both sides: a node that very many are children of can be split.
    out = nodes.join(parents, ["p1", "p2", "depth"], "left").select(*key, "conv_id", "parent_conv_id", "n_convs")
    out = out.join(sums, key).join(_digests(ends, tasks), key, "left")
    empty = hashlib.sha256().hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
