"""Boosted trees under absolute loss, for many fits in the same jobs.

Rows say which ``fit`` they belong to, so the models of all forecast origins grow together: a round is one job for each level of its trees
and one for their leaves, however many fits there are. Rows keep their bins and prediction in a written table; tasks add up counts and
signs of residuals for each (fit, node, feature, bin), which is all that the driver sees: as many rows as the models have cells. Splits
follow the signs, the gradients of absolute loss; leaves are then renewed by the median of their residuals, without which a sign's
step of one would barely move.

Trees are full, in level order, so an ensemble is four arrays, and what a forest's first k trees predict is a prefix sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.session import spent, written

BINS = 32
#: Of medians and bin edges, which are mergeable sketches: exact up to some ten thousand rows of a group, and within 1/ACCURACY of the rank beyond.
ACCURACY = 100_000
#: Trees since the last written predictions that a task evaluates again.
KEEP = 16
#: Rows of a written partition, and the most partitions whose sums the driver adds up itself; those of more are shuffled first.
PARTITION_ROWS, FEW = 100_000, 32


@dataclass(frozen=True)
class Forest:
    """``edges`` of each feature's bins; each fit's first value; and for (fit, round) the inner nodes' feature and cut (bins above it
    go right) and the leaves' values."""

    names: tuple[str, ...]
    edges: tuple[np.ndarray, ...]
    base: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @property
    def rounds(self) -> int:
        return self.value.shape[1]

    @property
    def depth(self) -> int:
        return int(np.log2(self.value.shape[2]))

    def bins(self, features: np.ndarray) -> np.ndarray:
        """The bins of rows of features."""
        return np.stack([np.searchsorted(e, x, "left") for e, x in zip(self.edges, features.T)], axis=1)

    def node(self, fit: np.ndarray, bins: np.ndarray, round_: int, levels: int | None = None) -> np.ndarray:
        """The node of each row in one tree, after ``levels`` levels; all of them give the leaf."""
        at, rows = np.zeros(len(fit), dtype=np.int64), np.arange(len(fit))
        for level in range(self.depth if levels is None else levels):
            inner = (1 << level) - 1 + at
            at = 2 * at + (bins[rows, self.feature[fit, round_, inner]] > self.cut[fit, round_, inner])
        return at

    def leaf_values(self, fit: np.ndarray, bins: np.ndarray, first: int, last: int) -> np.ndarray:
        """What each of the trees first to last adds to each row."""
        return np.stack([self.value[fit, k, self.node(fit, bins, k)] for k in range(first, last)], axis=1) if last > first else np.zeros((len(fit), 0))

    def prefixes(self, fit: np.ndarray, features: np.ndarray) -> np.ndarray:
        """The predictions of the first 0, 1, ... trees."""
        each = self.leaf_values(fit, self.bins(features), 0, self.rounds)
        return np.cumsum(np.concatenate([self.base[fit][:, None], each], axis=1), axis=1)

    def table(self, spark: SparkSession) -> DataFrame:
        """(fit, round, node, feature, above, value): inner nodes, then leaves; a row goes right if its feature is greater than ``above``."""
        rows = [(f, -1, 0, None, None, float(b)) for f, b in enumerate(self.base)]
        inner = self.feature.shape[2]
        for f in range(len(self.base)):
            for k in range(self.rounds):
                for n in range(inner):
                    i, cut = int(self.feature[f, k, n]), int(self.cut[f, k, n])
                    rows.append((f, k, n, self.names[i], float(self.edges[i][cut]) if cut < len(self.edges[i]) else float("inf"), None))
                rows += [(f, k, inner + n, None, None, float(v)) for n, v in enumerate(self.value[f, k])]
        return spark.createDataFrame(rows, "fit int, round int, node int, feature string, above double, value double")


def _columns(b: pa.RecordBatch, names: list[str], kind: type = float) -> np.ndarray:
    """Columns by name, as one array of rows."""
    return np.stack([b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(kind) for c in names], axis=1)


def predicted(rows: DataFrame, forest: Forest, rounds: list[int] | None = None) -> DataFrame:
    """``rows`` (fit and the features) with ``predictions``, an array of what the first so many trees say: all numbers of ``rounds`` in one pass."""
    wanted = rounds or [forest.rounds]
    schema = ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes), "predictions array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fit = b.column(b.schema.get_field_index("fit")).to_numpy(zero_copy_only=False).astype(np.int64)
            made = forest.prefixes(fit, _columns(b, list(forest.names)))[:, wanted]
            yield pa.record_batch([*b.columns, pa.array(list(made), pa.list_(pa.float64()))], names=[*b.schema.names, "predictions"])

    return rows.mapInArrow(run, schema)


def _best_splits(n: np.ndarray, g: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The feature and cut of each node with the greatest gain; counts and signs are (..., feature, bin). No gain: a cut above all bins."""
    left, signs = np.cumsum(n, axis=-1)[..., :-1], np.cumsum(g, axis=-1)[..., :-1]
    whole, total = n.sum(axis=-1, keepdims=True), g.sum(axis=-1, keepdims=True)
    right = whole - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = signs**2 / left + (total - signs) ** 2 / right - total**2 / whole
    gain = np.where((left >= least) & (right >= least), gain, -1.0)
    flat = gain.reshape(*gain.shape[:-2], -1)
    best = flat.argmax(axis=-1)
    worth = np.take_along_axis(flat, best[..., None], axis=-1)[..., 0] > 1e-9
    return np.where(worth, best // gain.shape[-1], 0), np.where(worth, best % gain.shape[-1], BINS)


def fit(rows: DataFrame, names: list[str], label: str, fits: int, rounds: int, depth: int = 2, rate: float = 0.3, least: int = 10) -> Forest:
    """One forest of ``fits`` models over rows with ``fit`` (0 to fits - 1), features and label."""
    probs = [k / BINS for k in range(1, BINS)]
    cuts = rows.agg(*[F.percentile_approx(c, probs, ACCURACY).alias(c) for c in names]).first()
    edges = tuple(np.unique(np.array(cuts[c] if cuts[c] else [0.0], dtype=float)) for c in names)
    base, parts = np.zeros(fits), 0.0
    for k, m, n in rows.groupBy("fit").agg(F.percentile_approx(label, 0.5, ACCURACY), F.count("*")).collect():
        base[k], parts = m, parts + n / PARTITION_ROWS
    parts = max(1, round(parts))
    inner, leaves, width = (1 << depth) - 1, 1 << depth, len(names)
    forest = Forest(tuple(names), edges, base, np.zeros((fits, rounds, inner), np.int64), np.full((fits, rounds, inner), BINS), np.zeros((fits, rounds, leaves)))
    cells = [f"b{k}" for k in range(width)]
    schema = ", ".join(["fit int", *(f"{c} tinyint" for c in cells), "label double", "made double"])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = _columns(b, ["fit"], int)[:, 0]
            bins = forest.bins(_columns(b, names)).astype(np.int8)
            yield pa.record_batch([pa.array(k, pa.int32()), *(pa.array(x) for x in bins.T), pa.array(_columns(b, [label])[:, 0]), pa.array(forest.base[k])], names=["fit", *cells, "label", "made"])

    def residuals(b: pa.RecordBatch, known: Forest, since: int, now: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        k, bins = _columns(b, ["fit"], int)[:, 0], _columns(b, cells, int)
        made = _columns(b, ["made"])[:, 0] + known.leaf_values(k, bins, since, now).sum(axis=1)
        return k, bins, _columns(b, ["label"])[:, 0] - made

    def counted(known: Forest, since: int, now: int, level: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shape = (fits, 1 << level, width, BINS)
            n, g = np.zeros(np.prod(shape), np.int64), np.zeros(np.prod(shape), np.int64)
            for b in batches:
                k, bins, r = residuals(b, known, since, now)
                node = known.node(k, bins, now, level)
                at = (((k * (1 << level) + node)[:, None] * width + np.arange(width)) * BINS + bins).ravel()
                n += np.bincount(at, minlength=len(n))
                g += np.bincount(at, weights=np.repeat(np.sign(r), width), minlength=len(n)).astype(np.int64)
            at = np.flatnonzero(n)
            yield pa.record_batch([pa.array(at), pa.array(n[at]), pa.array(g[at])], names=["at", "n", "g"])

        return run

    def leafed(known: Forest, since: int, now: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                k, bins, r = residuals(b, known, since, now)
                yield pa.record_batch([pa.array(k * leaves + known.node(k, bins, now)), pa.array(r)], names=["at", "r"])

        return run

    def moved(known: Forest, since: int, now: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                made = _columns(b, ["label"])[:, 0] - residuals(b, known, since, now)[2]
                yield pa.record_batch([*b.columns[:-1], pa.array(made)], names=b.schema.names)

        return run

    def added(found: DataFrame) -> pa.Table:
        """Sums by cell of what tasks have counted."""
        return (found if parts <= FEW else found.groupBy("at").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))).toArrow()

    state, since = written(rows.select("fit", *names, label).mapInArrow(binned, schema).coalesce(parts), "boosting"), 0
    for now in range(rounds):
        if now - since == KEEP:
            before, state = state, written(state.mapInArrow(moved(forest, since, now), schema), "boosting")
            spent(before)
            since = now
        feature, cut = forest.feature.copy(), forest.cut.copy()
        for level in range(depth):
            n, g = (np.zeros((fits, 1 << level, width, BINS), np.int64) for _ in range(2))
            found = added(state.mapInArrow(counted(forest, since, now, level), "at long, n long, g long"))
            for sums, c in ((n, "n"), (g, "g")):
                np.add.at(sums.reshape(-1), found.column("at").to_numpy(), found.column(c).to_numpy())
            first = (1 << level) - 1
            feature[:, now, first : 2 * first + 1], cut[:, now, first : 2 * first + 1] = _best_splits(n, g, least)
            forest = replace(forest, feature=feature.copy(), cut=cut.copy())
        value = forest.value.copy()
        medians = state.mapInArrow(leafed(forest, since, now), "at long, r double").groupBy("at").agg(F.percentile_approx("r", 0.5, ACCURACY)).collect()
        for at, m in medians:
            value[at // leaves, now, at % leaves] = rate * m
        forest = replace(forest, value=value)
    spent(state)
    return forest
