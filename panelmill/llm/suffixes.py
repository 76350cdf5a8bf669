"""Operator 11: removal of repeated byte strings, by suffix arrays.

A byte goes if a ``WINDOW``-byte string that covers it also starts anywhere else, in the same text or another.

1. Every window picks the least hash among its ``ANCHOR``-byte substrings; equal windows pick equal ones. A run of windows that
   picked the same is a region. Regions are counted by a 128-bit digest before any text moves, so that a passage that a
   third of all texts share is one region with a count. A region whose pick stands nowhere else can't hold a repeat.
2. The others are cut from one text each and dealt by their pick to shards of about ``SHARD_BYTES``: all places of a string meet
   in one shard. Regions of a pick with more bytes than a shard are dealt to several shards by their digest.
3. Each shard builds the suffix array of its regions by Larsson-Sadakane refinement: sorted by five bytes, then only the groups that are
   still tied are sorted again by the ranks of the suffixes behind their prefix, which doubles each time. Kasai's
   algorithm gives the common prefixes of neighbours (many stretches of the text in step). Neighbours that share ``WINDOW`` bytes
   are places of one string; it is repeated if they, times the texts that hold their regions, are two or more.
4. Shards of one pick are merged: each gives the strings of its suffix array as sorted runs of 96-bit fingerprints, cut at common
   bounds; the runs of a range are merged pairwise by binary search, and what is found in two shards is repeated.
5. The repeated stretches go back to all texts that hold their region and are cut out of them.

Hashes choose what is compared and stand for equal regions (128 bits) and for equal windows of different shards (96 bits).

Nulls: a null text is an empty one. Rows with equal doc_id are texts of their own, a row that is there twice repeats itself. Texts of
fewer than ``WINDOW`` bytes stay whole. Very long texts are read in overlapping parts of about a million bytes. Cuts may fall inside
a character, so what is kept is bytes. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.text import mix, powers, slices, texts
from panelmill.session import spent, written

WINDOW = 400
ANCHOR = 64
SHARD_BYTES = 1 << 20
PIECE = 512
PART = 1 << 20

_BYTES = np.random.default_rng(11).integers(1 << 63, size=(2, 256), dtype=np.uint64) | np.uint64(1)
_PLACE = np.uint64(21)


def _text_key() -> list:
    return [F.xxhash64("doc_id", "text").alias("a"), F.xxhash64("text", F.lit(11), "doc_id").alias("b")]


def rolling(data: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """A hash of all substrings of ``size`` bytes: differences of a polynomial's prefix sums."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[salt][data] * up[: len(data)])])
        return mix((total[size:] - total[:n]) * down[:n])


def _sliding(x: np.ndarray, span: int, best) -> np.ndarray:
    """The least or greatest of each ``span`` neighbours, by doubling."""
    n, width = len(x) - span + 1, 1
    while 2 * width <= span:
        x = best(x[:-width], x[width:])
        width *= 2
    return best(x[:n], x[span - width : span - width + n])


def regions(data: np.ndarray, valid: np.ndarray, window: int, anchor: int, piece: int = PIECE) -> tuple[np.ndarray, ...]:
    """(pick, first window, number of windows, whether the pick stands there more than once) of each region; ``valid`` has a value for
    each window: which text it lies in, -1 if it doesn't lie in one."""
    h = rolling(data, anchor)
    span = window - anchor + 1
    least = _sliding(h, span, np.minimum)
    new = np.concatenate([[True], (np.diff(least) != 0) | (np.diff(valid) != 0)])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(least)))
    ok = valid[first] >= 0
    first, n = first[ok], n[ok]
    parts = -(-n // piece)
    nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    first, n = np.repeat(first, parts) + nth * piece, np.minimum(np.repeat(n, parts) - nth * piece, piece)
    pick = least[first]
    # Picked places: those whose hash is the least of a window that covers them.
    edge = np.zeros(span - 1, dtype=np.uint64)
    at = np.flatnonzero(h == _sliding(np.concatenate([edge, least, edge]), span, np.maximum))
    lo, hi = np.searchsorted(at, first), np.searchsorted(at, first + n + span - 1)
    row = np.repeat(np.arange(len(first)), hi - lo)
    inside = at[np.arange(len(row)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)]
    times = np.bincount(row[h[inside] == pick[row]], minlength=len(first))
    return pick, first, n, times > 1


def _places(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """A row for each region of each text (a, b): its pick, digest, first window, number of windows."""
    names = ["pick", "d1", "d2", "a", "b", "lo", "n", "again"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            raw = texts(b.column(2))
            size = np.array([len(t) for t in raw], dtype=np.int64)
            start = np.cumsum(size) - size
            joined = b"".join(raw)
            data = np.frombuffer(joined, dtype=np.uint8)
            doc = np.repeat(np.arange(len(raw), dtype=np.int32), size)
            for lo in range(0, len(data) - window + 1, PART):
                part = data[lo : lo + PART + window - 1]
                own, last = doc[lo : lo + len(part) - window + 1], doc[lo + window - 1 : lo + len(part)]
                pick, first, n, again = regions(part, np.where(own == last, own, -1), window, anchor)
                first = first + lo
                digest = b"".join([xxhash.xxh3_128_digest(joined[i:j]) for i, j in zip(first.tolist(), (first + n + window - 1).tolist())])
                d = np.frombuffer(digest, dtype="<i8").reshape(-1, 2)
                at = doc[first]
                key = pa.array(at)
                columns = [pa.array(pick.view(np.int64)), pa.array(d[:, 0]), pa.array(d[:, 1]), b.column(0).take(key), b.column(1).take(key), pa.array(first - start[at]), pa.array(n.astype(np.int32)), pa.array(again)]
                yield pa.record_batch(columns, names=names)

    return docs.mapInArrow(run, "pick long, d1 long, d2 long, a long, b long, lo long, n int, again boolean")


def _cut(docs: DataFrame, window: int) -> DataFrame:
    """(shard, pick, slots, d1, d2, twice, bytes) of the regions that ``docs`` lists in ``wanted`` for each text."""
    kinds = [("shard", pa.int64()), ("pick", pa.int64()), ("slots", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("twice", pa.bool_()), ("bytes", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # a row that is there many times gives its regions once for each task
        for b in slices(batches, "text", 1 << 20):
            rows = []
            for text, wanted, key in zip(texts(b.column(0)), b.column(1).to_pylist(), zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                if key in seen:
                    continue
                seen.add(key)
                for r in wanted:
                    rows.append((*(r[c] for c, _ in kinds[:-1]), text[r["lo"] : r["lo"] + r["n"] + window - 1]))
                    if len(rows) == 4096:
                        yield pa.record_batch([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], names=[c for c, _ in kinds])
                        rows = []
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], names=[c for c, _ in kinds])

    return docs.mapInArrow(run, "shard long, pick long, slots long, d1 long, d2 long, twice boolean, bytes binary")


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes in the order of their first ``depth`` bytes, by Larsson-Sadakane refinement. Behind the end stand zeros."""
    n = len(data)
    small = n < 1 << int(_PLACE)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(5):
        key = (key << np.uint64(8)) | padded[k : k + n]

    def ordered(key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places by key, and whether each has another key than the one before. Small ones are sorted with the place in one number."""
        if small:
            both = np.sort((key << _PLACE) | place.astype(np.uint64))
            place, key = (both & np.uint64((1 << int(_PLACE)) - 1)).astype(np.int64), both >> _PLACE
        else:
            by = np.argsort(key, kind="stable")
            place, key = place[by], key[by]
        return place, np.concatenate([[True], key[1:] != key[:-1]])

    order, new = ordered(key, np.arange(n))
    rank = np.zeros(n, dtype=np.int64)
    slots = np.arange(n)
    width, known = (_PLACE if small else np.uint64(32)), 5
    while True:
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(new)))
        rank[order[slots]] = np.repeat(slots[head], size)
        slots = slots[np.repeat(size > 1, size)]
        if known >= depth or not len(slots):
            return order
        ahead = min(known, depth - known)
        place = order[slots]
        behind = place + ahead
        after = np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
        order[slots], new = ordered((rank[place].astype(np.uint64) << width) | after.astype(np.uint64), place)
        known += ahead


def common_prefixes(data: np.ndarray, order: np.ndarray, cap: int, lanes: int = 1 << 14) -> np.ndarray:
    """The common prefix of each suffix with the one before it in ``order``, ``cap`` at most, by Kasai's algorithm: what a text place
    shares with its neighbour is at least what the place before it shares with its own, less one. The text is cut into ``lanes``
    stretches that go on in step, eight bytes at a time."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(cap + 16, np.uint8)])
    eight = np.zeros(n + cap + 8, dtype=np.uint64)
    for k in range(8):
        eight |= padded[k : k + len(eight)].astype(np.uint64) << np.uint64(8 * k)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, dtype=np.int32)
    step = -(-n // lanes)
    base = np.arange(0, n, step)
    held = np.zeros(len(base), dtype=np.int64)
    last = held - 2
    for t in range(step):
        i = base + t
        if i[-1] >= n:
            i, held, last = i[:-1], held[:-1], last[:-1]
            base = base[:-1]
        j = before[i]
        # Places that share ``cap`` bytes are in no order; what was shared there holds on only for the same two stretches.
        held = np.where((held == cap) & (j != last + 1), 0, np.maximum(held - 1, 0))
        held[j < 0] = 0
        last = j
        live = np.flatnonzero((j >= 0) & (held < cap))
        while len(live):
            h = held[live]
            x = eight[i[live] + h] ^ eight[j[live] + h]
            same = np.where(x == 0, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) >> 3)
            held[live] = h + same
            live = live[(same == 8) & (h + 8 < cap)]
        held = np.minimum(held, cap)
        out[i] = held
    return out[order]


def _scan(window: int):
    """The repeated stretches of a shard's regions, and the fingerprints of its windows where other shards have the same pick."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        once = dict(zip(zip(table.column("d1").to_pylist(), table.column("d2").to_pylist()), range(table.num_rows)))
        table = table.take(pa.array(once.values(), pa.int64()))
        raw = table.column("bytes").to_pylist()
        twice = np.array(table.column("twice").to_pylist(), dtype=bool)
        slots = np.array(table.column("slots").to_pylist(), dtype=np.int64)
        pick = np.array(table.column("pick").to_pylist(), dtype=np.int64)
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        size = np.array([len(t) for t in raw], dtype=np.int64)
        start = np.cumsum(size) - size
        region = np.repeat(np.arange(len(raw), dtype=np.int32), size)
        valid = np.arange(len(data)) - start[region] <= size[region] - window
        order = suffix_array(data, window)
        shared = common_prefixes(data, order, window)
        head = np.flatnonzero(shared < window)  # the first suffix shares nothing with one before it
        weight = np.where(valid, 1 + twice[region], 0)[order]
        total = np.add.reduceat(weight, head)
        each = np.diff(np.append(head, len(order)))
        repeated = np.zeros(len(data), dtype=bool)
        repeated[order] = np.repeat(total > 1, each)
        at = np.flatnonzero(repeated & valid)
        new = np.concatenate([[True], (np.diff(region[at]) != 0) | (np.diff(at) > window)]) if len(at) else np.zeros(0, bool)
        lo, last = at[new], at[np.append(np.flatnonzero(new)[1:], len(at)) - 1] if len(at) else at
        who = region[lo]
        spans = [[] for _ in raw]
        for k, a, b in zip(who.tolist(), (lo - start[who]).tolist(), (last + window - start[who]).tolist()):
            spans[k] += (a, b)
        columns = {"shard": pa.array([key[0].as_py()] * len(raw), pa.int64()), "region": pa.array(range(len(raw)), pa.int32()), "d1": table.column("d1"), "d2": table.column("d2"), "spans": pa.array(spans, pa.list_(pa.int32()))}
        columns |= {"pick": pa.nulls(len(raw), pa.int64()), "range": pa.nulls(len(raw), pa.int64()), "run": pa.nulls(len(raw), pa.binary())}
        out = pa.table(columns)
        if not (slots > 1).any():
            return out
        # One window of each class that lies in a region of a divided pick; those repeated here need no answer.
        usable = (valid & (slots[region] > 1))[order]
        row = np.flatnonzero(usable)
        group = np.repeat(np.arange(len(head)), each)[row]
        row = row[np.concatenate([[True], np.diff(group) != 0])]
        group = group[np.concatenate([[True], np.diff(group) != 0])]
        place = order[row]
        f1, f2 = (rolling(data, window, salt)[place] for salt in (0, 1))
        who = region[place]
        entry = np.zeros(len(place), dtype=RUN)
        entry["f1"], entry["f2"], entry["at"] = f1, f2 >> np.uint64(32), place - start[who]
        entry["region"] = np.where(total[group] > 1, -1, who)
        bounds = ((f1 >> np.uint64(32)) * slots[who].astype(np.uint64)) >> np.uint64(32)
        by = np.lexsort((f1, pick[who]))
        entry, bounds, owner = entry[by], bounds[by], pick[who][by]
        cut = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(bounds) != 0)]))
        ends = np.append(cut[1:], len(entry))
        n = len(cut)
        more = {"shard": pa.array([key[0].as_py()] * n, pa.int64()), "region": pa.nulls(n, pa.int32()), "d1": pa.nulls(n, pa.int64()), "d2": pa.nulls(n, pa.int64()), "spans": pa.nulls(n, pa.list_(pa.int32()))}
        more |= {"pick": pa.array(owner[cut]), "range": pa.array(bounds[cut].astype(np.int64)), "run": pa.array([entry[i:j].tobytes() for i, j in zip(cut.tolist(), ends.tolist())], pa.binary())}
        return pa.concat_tables([out, pa.table(more)])

    return run


#: A window of a run: its fingerprint, its region in the shard (-1: needs no answer) and its place there.
RUN = np.dtype([("f1", "<u8"), ("f2", "<u4"), ("region", "<i4"), ("at", "<i4")])


def merged(runs: list[np.ndarray]) -> list[np.ndarray]:
    """Which windows of each sorted run another run has as well; runs are merged pairwise, by binary search in one for the other's."""
    size = np.array([len(r) for r in runs], dtype=np.int64)
    found = np.zeros(int(size.sum()), dtype=bool)
    now = [(r["f1"], r["f2"], np.arange(s, s + len(r))) for r, s in zip(runs, (np.cumsum(size) - size).tolist())]
    while len(now) > 1:
        pairs, now = now, []
        for a, b in zip(pairs[::2], pairs[1::2]):
            if len(a[0]) < len(b[0]):
                a, b = b, a
            at = np.searchsorted(a[0], b[0])
            near = np.minimum(at, len(a[0]) - 1)
            both = (at < len(a[0])) & (a[0][near] == b[0]) & (a[1][near] == b[1])
            found[b[2][both]] = True
            found[a[2][at[both]]] = True
            now.append(tuple(np.insert(x, at[~both], y[~both]) for x, y in zip(a, b)))
        if len(pairs) % 2:
            now.append(pairs[-1])
    return np.split(found, np.cumsum(size)[:-1])


def _merge(window: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        runs = [np.frombuffer(x, dtype=RUN) for x in table.column("run").to_pylist()]
        rows = []
        for shard, r, found in zip(table.column("shard").to_pylist(), runs, merged(runs)):
            r = r[found & (r["region"] >= 0)]
            r = r[np.lexsort((r["at"], r["region"]))]
            new = np.flatnonzero(np.diff(r["region"], prepend=-1))
            for i, j in zip(new.tolist(), np.append(new[1:], len(r)).tolist()):
                at = r["at"][i:j].astype(np.int64)
                edge = np.flatnonzero(np.diff(at, prepend=-window - 1) > window)
                spans = np.stack([at[edge], at[np.append(edge[1:], len(at)) - 1] + window], axis=1).ravel().tolist()
                rows.append((shard, int(r["region"][i]), spans))
        columns = list(zip(*rows)) if rows else [(), (), ()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.list_(pa.int32())))], names=["shard", "region", "spans"])

    return run


def repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(a, b, lo, hi): the repeated stretches of each text, by the key of its doc_id and text; docs has a, b and text."""
    spark = docs.sparkSession
    places = written(_places(docs, window, anchor), "suffix-places")
    one = places.groupBy("d1", "d2").agg(F.min(F.struct("a", "b", "lo")).alias("at"), F.max("pick").alias("pick"), F.max("n").alias("n"), F.max("again").alias("again"), F.count("*").alias("times"))
    one = written(one, "suffix-regions")
    size = F.col("n") + F.lit(window - 1)
    picks = one.groupBy("pick").agg(F.sum("times").alias("all"), F.max("again").alias("any"), F.sum(size).alias("bytes")).where("all > 1 OR any")
    picks = written(picks.select("pick", F.ceil(F.col("bytes") / shard_bytes).cast("long").alias("slots"), "bytes"), "suffix-picks")
    whole = picks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    shards = max(1, math.ceil(whole / shard_bytes))
    tasks = max(1, min(shards, 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    shard = F.when(F.col("slots") > 1, F.xxhash64("pick", F.pmod("d1", "slots"))).otherwise(F.pmod(F.xxhash64("pick"), F.lit(shards))).alias("shard")
    wanted = written(one.join(picks, "pick").select("d1", "d2", "at", "n", "pick", "slots", (F.col("times") > 1).alias("twice"), shard), "suffix-wanted")
    spent(one, picks)
    lists = wanted.groupBy(F.col("at.a").alias("a"), F.col("at.b").alias("b")).agg(F.collect_list(F.struct("shard", "pick", "slots", "d1", "d2", "twice", F.col("at.lo").alias("lo"), "n")).alias("wanted"))
    cut = _cut(docs.join(lists, ["a", "b"]).select("text", "wanted", "a", "b"), window)
    schema = "shard long, region int, d1 long, d2 long, spans array<int>, pick long, range long, run binary"
    found = written(cut.repartition(tasks, "shard").groupBy("shard").applyInArrow(_scan(window), schema), "suffix-shards")
    spent(wanted)
    runs = found.where("run IS NOT NULL").select("pick", "range", "shard", "run")
    across = runs.repartition(tasks, "pick", "range").groupBy("pick", "range").applyInArrow(_merge(window), "shard long, region int, spans array<int>")
    across = written(across, "suffix-merged")
    own = found.where("run IS NULL").select("shard", "region", "d1", "d2", "spans")
    both = own.where(F.size("spans") > 0).select("d1", "d2", "spans").unionByName(across.join(own.select("shard", "region", "d1", "d2"), ["shard", "region"]).select("d1", "d2", "spans"))
    each = both.select("d1", "d2", F.explode(F.sequence(F.lit(0), (F.size("spans") / 2).cast("int") - 1)).alias("k"), "spans")
    each = written(each.select("d1", "d2", F.get("spans", 2 * F.col("k")).alias("from"), F.get("spans", 2 * F.col("k") + 1).alias("to")), "suffix-spans")
    spent(found, across)
    # Both sides are written: the join can split a region that very many texts hold.
    out = written(places.select("d1", "d2", "a", "b", "lo").join(each, ["d1", "d2"]).select("a", "b", (F.col("lo") + F.col("from")).alias("lo"), (F.col("lo") + F.col("to")).alias("hi")).distinct(), "suffix-repeats")
    spent(places, each)
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (bytes) of each row."""
    keyed = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).select(*_text_key(), "doc_id", "text")
    found = repeats(keyed.select("a", "b", "text"), window, anchor, shard_bytes)
    marks = found.groupBy("a", "b").agg(F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            rows = []
            for text, lo, hi in zip(texts(b.column(1)), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if not lo:
                    rows.append((len(text), 0, 0, text))
                    continue
                depth = np.zeros(len(text) + 1, dtype=np.int32)
                np.add.at(depth, lo, 1)
                np.add.at(depth, hi, -1)
                gone = np.cumsum(depth[:-1]) > 0
                rows.append((len(text), int(gone.sum()), int(gone[0]) + int((np.diff(gone.astype(np.int8)) > 0).sum()), np.frombuffer(text, np.uint8)[~gone].tobytes()))
            columns = list(zip(*rows)) if rows else [()] * 4
            yield pa.record_batch([b.column(0), *(pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary())))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    both = keyed.join(marks, ["a", "b"], "left").select("doc_id", "text", "lo", "hi")
    return both.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op11_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
