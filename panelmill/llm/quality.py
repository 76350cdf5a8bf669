"""Operator 5: a quality classifier over document statistics.

Random Fourier features (Rahimi and Recht) approximate a Gaussian kernel over standardised statistics. Every partition
sums its own normal equations, X'X and X'y, the sums are added up row by row in Spark, and the ridge solution is one
small linear system, whatever the number of rows. Isotonic regression (pool adjacent violators) over counted score
bins turns the ridge score into a probability.

Statistics come from the whole text alone. Labels of held-out documents (crc32 of the doc_id as text, modulo
``folds``, is 0) are never read. Nulls: a null text is an empty one and scored as such; labels with a null doc_id or mark
don't count; a null doc_id is scored and not held out. Several labels of one document all count. Without usable labels
every score is 0.5. Rows with equal doc_id are scored one by one. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.text import slices, texts, word_hashes
from panelmill.session import written

FOLDS = 5
FEATURES = 192
GAMMA = 0.08
RIDGE = 1e-3
BINS = 1000
CUT = 0.3
SEED = 17
SUMS = 2048  # partial sums of the normal equations, at most

N_STATS = 18


def statistics_of(text: bytes) -> np.ndarray:
    """Statistics of one text, each roughly within 0 to 10."""
    words = text.split()
    out = np.zeros(N_STATS)
    n = len(words)
    if not n:
        return out
    data = np.frombuffer(text, dtype=np.uint8)
    count = np.bincount(data, minlength=256)
    solid = max(1, int(count.sum() - count[32] - count[9:14].sum()))
    h = word_hashes(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=n)
    _, times = np.unique(h, return_counts=True)
    lines = [x for x in text.split(b"\n") if x.split()]
    letters = int(count[65:91].sum() + count[97:123].sum())
    known = times / n
    chars = count[count > 0] / len(data)
    out[0] = np.log1p(n)
    out[1] = size.mean()
    out[2] = size.std()
    out[3] = 10 * count[65:91].sum() / max(1, letters)
    out[4] = 5 * min(2.0, count[[33, 63]].sum() / n)
    out[5] = 5 * min(2.0, count[[35, 36, 37, 38, 42, 60, 62]].sum() / n)
    out[6] = 10 * min(1.0, count[124] / n)
    out[7] = 10 * count[48:58].sum() / solid
    out[8] = 10 * (1 - len(set(lines)) / len(lines))
    out[9] = 10 * (h[1:] == h[:-1]).mean() if n > 1 else 0.0
    out[10] = 10 * len(times) / n
    out[11] = -2 * (known * np.log(known)).sum()
    out[12] = -2 * (chars * np.log(chars)).sum()
    out[13] = 10 * count[[44, 46, 58, 59]].sum() / solid
    out[14] = np.log1p(n / len(lines))
    out[15] = 10 * count[128:].sum() / solid
    out[16] = 10 * times.max() / n
    out[17] = np.log1p(size.max())
    return out


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats) for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            found = np.concatenate([statistics_of(t) for t in texts(b.column(1))]).astype(np.float32)
            yield pa.record_batch([b.column(0), pa.ListArray.from_arrays(np.arange(0, len(found) + 1, N_STATS, dtype=np.int32), pa.array(found))], names=["doc_id", "stats"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, stats array<float>")


def held_out(folds: int = FOLDS):
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == 0, F.lit(False))


def matrix(b: pa.RecordBatch, column: str) -> np.ndarray:
    return b.column(b.schema.get_field_index(column)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, N_STATS)


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, features: int, gamma: float) -> np.ndarray:
    """cos(w.x + b) with Gaussian w, and a constant."""
    draw = np.random.default_rng(SEED)
    w = draw.normal(0, np.sqrt(2 * gamma), (N_STATS, features))
    shift = draw.uniform(0, 2 * np.pi, features)
    z = np.sqrt(2 / features) * np.cos(((x - mean) / scale) @ w + shift)
    return np.hstack([z, np.ones((len(x), 1))])


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each statistic."""
    each = [F.col("stats")[k].cast("double") for k in range(N_STATS)]
    got = rows.agg(*[F.avg(c) for c in each], *[F.stddev_pop(c) for c in each]).first()
    return np.array(got[:N_STATS], dtype=np.float64), np.maximum(np.array(got[N_STATS:], dtype=np.float64), 1e-3)


def _ridge(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, features: int, gamma: float, ridge: float) -> np.ndarray:
    """Weights from normal equations that each partition sums; Spark adds the sums up, a row of X'X at a time."""
    d = features + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = np.zeros((d, d + 1))
        for b in batches:
            if b.num_rows:
                z = fourier(matrix(b, "stats"), mean, scale, features, gamma)
                y = b.column(b.schema.get_field_index("mark")).to_numpy(zero_copy_only=False).astype(np.float64)
                a += z.T @ np.hstack([z, y[:, None]])
        yield pa.record_batch([pa.array(np.arange(d)), pa.array(a.tolist(), pa.list_(pa.float64()))], names=["at", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for at, row in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[at] = total.get(at, 0) + np.array(row)
        keys = sorted(total)
        yield pa.record_batch([pa.array(keys, pa.int64()), pa.array([total[k].tolist() for k in keys], pa.list_(pa.float64()))], names=["at", "sums"])

    schema = "at long, sums array<double>"
    parts = rows.coalesce(SUMS).mapInArrow(sums, schema).repartition("at").mapInArrow(add, schema)
    a = np.zeros((d, d + 1))
    for at, row in parts.collect():  # features + 1 rows, whatever the input
        a[at] += np.array(row)
    penalty = ridge * max(1.0, a[-1, d - 1]) * np.eye(d)
    penalty[-1, -1] = 0
    return np.linalg.lstsq(a[:, :d] + penalty, a[:, d], rcond=None)[0]


def isotonic(weight: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the non-decreasing means nearest to total / weight."""
    blocks: list[list[float]] = []
    for w, t in zip(weight, total):
        blocks.append([w, t, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w2, t2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w2, blocks[-1][1] + t2, blocks[-1][2] + n2]
    return np.concatenate([np.full(int(n), t / w if w else 0.0) for w, t, n in blocks]) if blocks else np.zeros(0)


def classify(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, features: int = FEATURES, gamma: float = GAMMA, ridge: float = RIDGE, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score and predicted for each document, learned from labels (doc_id, quality)."""
    stats = written(statistics(docs), "quality-stats")
    marks = labels.select(F.col("doc_id").cast("long"), (F.col("quality") != 0).cast("double").alias("mark")).where(~held_out(folds) & F.col("doc_id").isNotNull() & F.col("mark").isNotNull())
    train = written(stats.join(marks, "doc_id").select("stats", "mark"), "quality-train")
    if train.isEmpty():
        return stats.select("doc_id", held_out(folds).alias("held_out"), F.lit(0.5).alias("score"), F.lit(int(cut <= 0.5)).alias("predicted"))
    mean, scale = _moments(train)
    weights = _ridge(train, mean, scale, features, gamma, ridge)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = fourier(matrix(b, "stats"), mean, scale, features, gamma) @ weights if b.num_rows else np.zeros(0)
            yield pa.record_batch([b.column(0), pa.array(np.clip(z, 0.0, 1.0))], names=[b.schema.names[0], "raw"])

    bins = train.select("mark", "stats").mapInArrow(score, "mark double, raw double")
    counted = {r[0]: r[1:] for r in bins.groupBy(F.floor(F.col("raw") * BINS).cast("int")).agg(F.count("*"), F.sum("mark")).collect()}  # BINS + 1 rows at most
    at = np.array(sorted(counted))
    level = isotonic(np.array([counted[k][0] for k in at], dtype=float), np.array([counted[k][1] for k in at], dtype=float))

    def calibrated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in score(batches):
            raw = b.column(1).to_numpy(zero_copy_only=False)
            # The isotonic level, with a trace of the ridge score so that equal levels keep their order.
            yield pa.record_batch([b.column(0), pa.array(0.999 * np.interp(raw * BINS, at + 0.5, level) + 0.001 * raw)], names=["doc_id", "score"])

    scored = stats.mapInArrow(calibrated, "doc_id long, score double")
    return scored.select("doc_id", held_out(folds).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return classify(read("documents"), read("labels"))
