"""The BPE lattice of pieces.py for many words at once, in numpy.

The same recursion over the same lattice: nodes after each character, an edge for each piece, admitted if the piece and
the one before it stay apart. All words of a batch take a step together; words with characters outside the vocabulary
and words longer than the longest piece are left to the window of ``Pieces``. Words that were met before are told by their 64-bit hash
alone: of the ``KEEP_WORDS`` that a task remembers at most, two share one with a probability of about 1 in 10 million.
"""

from __future__ import annotations

import numpy as np

from panelmill.llm.pieces import MARK, Pieces
from panelmill.llm.text import mix, word_hashes

_P = np.uint64(0x5851F42D4C957F2D)
PAIR_SLOTS = 1 << 21
KEEP_WORDS = 2_000_000
NONE = np.int32(-1)


class Table:
    """Sorted 64-bit hashes with a value for each."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def find(self, keys: np.ndarray, missing: int) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), missing, dtype=self.values.dtype)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], missing)


class Batches:
    """Encodes batches of distinct words; remembers a bounded number of them."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        names = list(pieces.ids)
        ids = np.array([pieces.ids[p] for p in names], dtype=np.int64)
        self.breaks = not any("\n" in p for p in names)  # no piece holds a line break: all paths meet before and after one
        self.whole = pieces.bpe and pieces.cuts and all(c in pieces.ids for c in set("".join(names)))
        if not self.whole:
            return
        points = [np.frombuffer(p.encode("utf-32-le"), dtype=np.uint32) for p in names]
        self.size = max(pieces.ids.values()) + 2
        self.unknown = self.size - 1
        self.chars = np.zeros((self.size, pieces.longest), dtype=np.uint32)
        self.len = np.ones(self.size, dtype=np.int64)
        rank = np.zeros(self.size, dtype=np.int64)
        prefixes: dict[int, int] = {}
        hashes = []
        with np.errstate(over="ignore"):
            for i, c in zip(ids.tolist(), points):
                self.chars[i, : len(c)] = c
                self.len[i] = len(c)
                rank[i] = -int(pieces.scores[i])
                h = np.uint64(0)
                for k, x in enumerate(c.tolist()):
                    h = h * _P + np.uint64(x + 1)
                    if k == len(c) - 1:
                        prefixes[int(h)] = i
                    else:
                        prefixes.setdefault(int(h), -1)
                hashes.append(h)
            self.power = np.cumprod(np.full(2 * pieces.longest + 1, _P, dtype=np.uint64)) * np.uint64(pow(int(_P), -1, 1 << 64))
        self.ranks = Table(np.array(hashes, dtype=np.uint64), rank[ids])
        # -2: no piece starts so; -1: only longer pieces do
        self.prefixes = Table(np.fromiter(prefixes, dtype=np.uint64, count=len(prefixes)), np.fromiter(prefixes.values(), dtype=np.int64, count=len(prefixes)))
        self.pair_key = np.full(PAIR_SLOTS, -1, dtype=np.int64)
        self.pair_apart = np.zeros(PAIR_SLOTS, dtype=bool)
        self.alone = np.zeros(self.size, dtype=bool)
        for lo in range(0, len(ids), 8192):
            part = ids[lo : lo + 8192]
            self.alone[part] = self._merged(self.chars[part], self.len[part], self.len[part] * 0)
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.at = np.zeros(0, dtype=np.int64)
        self.n = np.zeros(0, dtype=np.int64)
        self.pool = np.zeros(0, dtype=np.uint16 if self.size < 65536 else np.int32)

    def _merged(self, chars: np.ndarray, length: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Whether merging each text ends with one piece (cut 0) or with two that meet at ``cut``."""
        n, width = len(chars), int(length.max())
        out = np.zeros(n, dtype=bool)
        far = np.int64(1 << 40)
        with np.errstate(over="ignore"):
            h = chars[:, :width].astype(np.uint64) + np.uint64(1)
        size = (np.arange(width)[None, :] < length[:, None]).astype(np.int64)
        rows = np.arange(n)
        parts = length.copy()
        rank = np.full((n, width), far)

        def rate(r: np.ndarray, k: np.ndarray) -> None:
            ok = (k >= 0) & (k + 1 < parts[r])
            rank[r[~ok & (k >= 0)], k[~ok & (k >= 0)]] = far
            r, k = r[ok], k[ok]
            with np.errstate(over="ignore"):
                both = h[r, k] * self.power[size[r, k + 1]] + h[r, k + 1]
            rank[r, k] = self.ranks.find(both, far)

        for k in range(width - 1):
            rate(rows, np.full(n, k))
        while len(rows):
            k = rank[rows].argmin(axis=1)
            live = rank[rows, k] < far
            rows, k = rows[live], k[live]
            if not len(rows):
                break
            with np.errstate(over="ignore"):
                h[rows, k] = h[rows, k] * self.power[size[rows, k + 1]] + h[rows, k + 1]
            size[rows, k] += size[rows, k + 1]
            shift = np.minimum(np.arange(width)[None, :] + (np.arange(width)[None, :] > k[:, None]), width - 1)
            for a in (h, size, rank):
                a[rows] = np.take_along_axis(a[rows], shift, axis=1)
            parts[rows] -= 1
            rate(rows, k - 1)
            rate(rows, k)
        out[:] = np.where(cut == 0, parts == 1, (parts == 2) & (size[:, 0] == cut))
        return out

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each pair of pieces stays two pieces; pairs are remembered in a table of fixed size."""
        key = left.astype(np.int64) * self.size + right
        slot = (mix(key.astype(np.uint64)) >> np.uint64(43)).astype(np.int64) & (PAIR_SLOTS - 1)
        free = (left == self.unknown) | (right == self.unknown)
        hit = self.pair_key[slot] == key
        out = np.where(hit, self.pair_apart[slot], free)
        new = np.flatnonzero(~hit & ~free)
        if len(new):
            keys, back = np.unique(key[new], return_inverse=True)
            fresh = np.zeros(len(keys), dtype=bool)
            a, b = keys // self.size, keys % self.size
            total = self.len[a] + self.len[b]
            order = np.argsort(total, kind="stable")
            for lo in range(0, len(order), 4096):
                o = order[lo : lo + 4096]
                width = int(total[o].max())
                column = np.arange(width)[None, :]
                text = np.where(
                    column < self.len[a[o]][:, None],
                    np.pad(self.chars[a[o]], ((0, 0), (0, max(0, width - self.chars.shape[1]))))[:, :width],
                    np.take_along_axis(self.chars[b[o]], np.clip(column - self.len[a[o]][:, None], 0, self.chars.shape[1] - 1), axis=1),
                )
                fresh[o] = self._merged(text, total[o], self.len[a[o]])
            out[new] = fresh[back]
            at = (mix(keys.astype(np.uint64)) >> np.uint64(43)).astype(np.int64) & (PAIR_SLOTS - 1)
            self.pair_key[at], self.pair_apart[at] = keys, fresh
            # Where two keys share a slot the last one stays; give it its own answer.
            self.pair_apart[at] = fresh[np.searchsorted(keys, self.pair_key[at])]
        return out

    def _lattice(self, chars: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids from last to first for each word, and whether a character has no piece."""
        n, width = chars.shape
        if width > self.pieces.longest:
            raise ValueError("a word is wider than the window")
        last = np.full((n, width + 1), self.unknown, dtype=np.int64)
        step = np.ones((n, width + 1), dtype=np.int64)
        odd = np.zeros(n, dtype=bool)
        for s in range(width):
            act = np.flatnonzero(length > s)
            h = np.zeros(len(act), dtype=np.uint64)
            before = last[act, s]
            for size in range(1, min(self.pieces.longest, width - s) + 1):
                fits = length[act] >= s + size
                act, h, before = act[fits], h[fits], before[fits]
                if not len(act):
                    break
                with np.errstate(over="ignore"):
                    h = h * _P + (chars[act, s + size - 1].astype(np.uint64) + np.uint64(1))
                found = self.prefixes.find(h, -2)
                if size == 1:
                    odd[act[found == -2]] = True
                k = np.flatnonzero((found >= 0) & self.alone[np.maximum(found, 0)])
                k = k[self.apart(before[k], found[k])]
                last[act[k], s + size] = found[k]
                step[act[k], s + size] = size
                go = found != -2
                act, h, before = act[go], h[go], before[go]
        at, rows, columns = length.copy(), np.arange(n), []
        while len(rows):
            column = np.full(n, -1, dtype=np.int64)
            column[rows] = last[rows, at[rows]]
            columns.append(column)
            at[rows] -= step[rows, at[rows]]
            rows = rows[at[rows] > 0]
        return np.stack(columns, axis=1), odd

    def cut(self, text: bytes) -> list[bytes]:
        """The words of a text with single spaces, each with the space before it (also the first), and its line breaks."""
        text = (b" " + text).replace(b" ", b"\0 ")
        if self.breaks:
            text = text.replace(b"\n", b"\0\n\0")
        return list(filter(None, text.split(b"\0")))

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and their number for each word. A space in a word stands for a mark."""
        h = word_hashes(words)
        keys, first, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) > KEEP_WORDS:
            self.forget()
        seen = np.searchsorted(self.known, keys)
        new = np.flatnonzero(self.known[np.minimum(seen, max(0, len(self.known) - 1))] != keys) if len(self.known) else np.arange(len(keys))
        if len(new):
            self._learn(keys[new], [words[i] for i in first[new].tolist()])
        slot = np.searchsorted(self.known, keys)[back]
        n, at = self.n[slot], self.at[slot]
        total = np.cumsum(n)
        where = np.arange(int(total[-1]) if len(total) else 0) + np.repeat(at - (total - n), n)
        return self.pool[where].astype(np.int32), n

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        self.pieces.starts += len(words)  # each lattice ends where the next word starts, the one node that is left there
        mark = MARK.encode()
        joined = np.frombuffer(b"".join(words).replace(b" ", mark).decode().encode("utf-32-le"), dtype=np.uint32)
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        bytes_at = np.cumsum([0, *map(len, words)])
        heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        length = heads[bytes_at[1:]] - heads[bytes_at[:-1]]
        start = np.cumsum(length) - length
        counts = np.zeros(len(words), dtype=np.int64)
        flats, owners = [], []
        slow = length > self.pieces.longest
        order = np.argsort(length, kind="stable")
        order = order[~slow[order]]
        for lo in range(0, len(order), 32768):
            o = order[lo : lo + 32768]
            width = int(length[o].max())
            column = np.arange(width)[None, :]
            chars = np.where(column < length[o][:, None], joined[np.minimum(start[o][:, None] + column, len(joined) - 1)], 0)
            path, odd = self._lattice(chars, length[o])
            path = path[:, ::-1]
            keep = (path >= 0) & ~odd[:, None]
            counts[o] = keep.sum(axis=1)
            flats.append(path[keep])
            owners.append(np.repeat(o, counts[o]))
            slow[o[odd]] = True
        for i in np.flatnonzero(slow).tolist():
            got = np.array(self.pieces._ids(words[i].decode().replace(" ", MARK)), dtype=np.int64)
            counts[i] = len(got)
            flats.append(got)
            owners.append(np.full(len(got), i))
        flat, owner = np.concatenate(flats), np.concatenate(owners)
        flat = flat[np.argsort(owner, kind="stable")]
        at = len(self.pool) + np.cumsum(counts) - counts
        self.pool = np.concatenate([self.pool, flat.astype(self.pool.dtype)])
        order = np.argsort(np.concatenate([self.known, keys]), kind="stable")
        self.known = np.concatenate([self.known, keys])[order]
        self.at = np.concatenate([self.at, at])[order]
        self.n = np.concatenate([self.n, counts])[order]


_BATCHES: dict[int, Batches] = {}


def batches_of(pieces: Pieces) -> Batches | None:
    """The batch encoder of a vocabulary, once for each worker process; None where the lattice can't be cut into words."""
    key = id(pieces)
    if key not in _BATCHES:
        _BATCHES[key] = Batches(pieces)
    return _BATCHES[key] if _BATCHES[key].whole else None
