"""Word and hash helpers used inside tasks.

A word is a maximal run of bytes other than space and \\x09-\\x0D; ``bytes.split()`` splits on exactly these.
Null texts count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_P = 0x9E3779B97F4A7C15 | 1
_PART = 1 << 20
_POWERS = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, b"" for null."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``max_bytes`` of text (or one longer text)."""
    for b in batches:
        col = b.column(b.schema.get_field_index(column))
        size = np.array([0 if x is None else x for x in pc.binary_length(col).to_pylist()], dtype=np.int64)
        part = np.cumsum(size) // max_bytes
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), b.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            if hi > lo:
                yield b.slice(lo, hi - lo)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public splitmix64 constants)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n or more powers of the multiplier and of its inverse modulo 2^64."""
    global _POWERS
    if len(_POWERS[0]) < n:
        m = max(n, _PART)
        with np.errstate(over="ignore"):
            each = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(m - 1, x, np.uint64)])) for x in (_P, pow(_P, -1, 1 << 64))]
        _POWERS = (each[0], each[1])
    return _POWERS


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word: differences of a polynomial's prefix sums over the joined bytes."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size)
    if end[-1] > _PART and len(words) > 1:
        cut = max(1, int(np.searchsorted(end, _PART)))
        return np.concatenate([word_hashes(words[lo : lo + cut]) for lo in range(0, len(words), cut)])
    start = end - size
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    up, down = powers(len(data))
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
        h = (total[end] - total[start]) * down[start]
    return mix(h ^ (size.astype(np.uint64) << np.uint64(48)))


def gram_hashes(h: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive words."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(n, salt, dtype=np.uint64)
        for i in range(k):
            out = out * np.uint64(_P) + h[i : i + n]
    return mix(out)
