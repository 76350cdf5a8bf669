"""Plain versions of operators, for tests."""

from __future__ import annotations

import re

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(t: str | None) -> list[str]:
    return WORD.findall(t or "")


def fingerprint(t: str | None) -> int:
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints: dict[int, int], radius: int = 3) -> dict[int, int]:
    ids = sorted(prints)
    top = {i: i for i in ids}

    def find(i: int) -> int:
        while top[i] != i:
            i = top[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {i: find(i) for i in ids}


def brute_repeats(texts: list[tuple[int, str | None]], window: int) -> dict[tuple[int, str], tuple[int, int, str]]:
    """(doc_id, text) -> (words, removed words, kept words with single spaces)."""
    first: dict[tuple, tuple] = {}
    listed = {(i, t or "") for i, t in texts if i is not None}
    for i, t in listed:
        w = words(t)
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            first[key] = min((i, p), first.get(key, (i, p)))
    out = {}
    for i, t in listed:
        w = words(t)
        keep = [True] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] != (i, p):
                keep[p : p + window] = [False] * window
        out[i, t] = (len(w), len(w) - sum(keep), " ".join(x for x, k in zip(w, keep) if k))
    return out
