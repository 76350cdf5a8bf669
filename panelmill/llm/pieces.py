"""Operator 9: SentencePiece encoding and decoding by a streaming Viterbi pass.

The lattice has a node after every character and an edge for every piece of the vocabulary. The pass keeps backpointers for the
characters since the last commit. From one longest piece on it asks, at every further character, whether the paths behind all
nodes that a later piece could still start from meet in one node; the ids up to it are then final, are put out, and the window
moves there. ``commits`` counts these alone, ``widest`` is the widest window there was: for the given vocabulary a few characters more
than the longest piece, however long a text without spaces is.

* Unigram models: an edge adds its score; the best sum wins (the usual Viterbi recursion).
* BPE models (such as piece_bpe_32k): scores are merge ranks, and their best sum is not what the tokenizer puts out. So an
  edge is admitted only if the piece and the one before it stay apart when their joined text is merged on its own.
  Merging never crosses a boundary of its own result, so exactly one admitted edge ends at each node, and the path is the
  encoding that BPE gives. ids equal the sentencepiece library's.

No piece of the vocabulary reaches across a word start or a line break, so there only one node is left to start from and all paths
meet: each of them commits without a search. The pass therefore runs from one such commit to the next, and what it put out for a word is
kept for the word's next occurrence in a bounded table; ``starts`` counts the words that it was run for, not their repeats. Words of up to one longest piece, which end before the window could move, take their steps together
(piece_batches); all others, and texts with other spacing, go through the window character by character. Long texts are taken in
parts of ``PART_BYTES`` that end at a commit. A model with pieces across word starts isn't cut.

Characters without a piece become byte pieces. Nulls: a null text is an empty one, with no ids. A text that holds the mark
U+2581 itself decodes to one with spaces there (``exact`` is false), as in the library; all others decode to themselves.
Rows with equal doc_id are encoded one by one. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.text import slices, texts

MARK = "▁"
KEEP_WORDS = 400_000
KEEP_PAIRS = 1_000_000
WHOLE = 256
PART_BYTES = 1 << 20


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A vocabulary with its encoder and decoder."""

    def __init__(self, ids: dict[str, int], scores: list[float], byte_ids: list[int], names: list[str], bpe: bool, prefix: bool = True) -> None:
        self.ids, self.scores, self.byte_ids, self.names, self.bpe, self.prefix = ids, scores, byte_ids, names, bpe, prefix
        self.longest = max(map(len, ids), default=1)
        self.unknown = min(scores, default=0.0) - 10.0
        self.cuts = not any(MARK in p.lstrip(MARK) for p in ids)
        self.words: dict[str, list[int]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.commits = self.starts = self.widest = 0
        self.bytes_of = {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.text_of = [self.bytes_of.get(i) or n.replace(MARK, " ").encode() for i, n in enumerate(names)]

    @classmethod
    def load(cls, model: bytes) -> Pieces:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        normal = [i for i in range(len(names)) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        scores = [sp.get_score(i) for i in range(len(names))]
        byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        bpe = all(scores[i] == int(scores[i]) for i in normal)
        return cls({names[i]: i for i in normal}, scores, byte_ids, names, bpe, sp.encode("a") == sp.encode(" a")[1:] or sp.encode_as_pieces("a")[0].startswith(MARK))

    # -- merging two pieces on their own ------------------------------------------------

    def _merge(self, text: str) -> list[str]:
        """What merging makes of a short text: the best-ranked neighbours first, then the leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best = None
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best[0]):
                    best = (self.scores[i], k)
            if best is None:
                break
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _apart(self, left: str, right: str) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= KEEP_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self._merge(left + right) == ([left, right] if left else [right])
        return known

    # -- the streaming pass ---------------------------------------------------------------

    def viterbi(self, text: str) -> Iterator[str]:
        """The pieces of ``text`` (marks in place of spaces), each as soon as it is final."""
        n, longest, ids = len(text), self.longest, self.ids
        start = 0  # everything before it has been put out
        piece: list[str] = [""]  # the piece that ends at start + k on the best path
        score = [0.0]
        before = ""  # the piece that ended at ``start``
        for end in range(1, n + 1):
            k = end - start
            self.widest = max(self.widest, k)
            found, best = text[end - 1], None
            for size in range(min(k, longest), 0, -1):
                p = text[end - size : end]
                if p in ids:
                    if self.bpe:
                        last = piece[k - size] or before
                        if (self._apart("", p) or size == 1) and (not last or self._apart(last, p)):
                            found, best = p, 0.0
                            break
                    elif best is None or score[k - size] + self.scores[ids[p]] > best:
                        found, best = p, score[k - size] + self.scores[ids[p]]
            if not self.bpe:
                alone = score[k - 1] + self.unknown
                if best is None or (text[end - 1] not in ids and alone > best):
                    found, best = text[end - 1], alone
            piece.append(found)
            score.append(best or 0.0)
            if k >= longest and end < n:
                live = set(range(max(0, k - longest + 1), k + 1))
                while len(live) > 1:  # step the furthest node back until all paths meet
                    at = max(live)
                    live.discard(at)
                    live.add(at - len(piece[at]))
                meet = live.pop()
                if meet:
                    self.commits += 1
                    yield from self._path(piece, meet)
                    before = piece[meet]
                    start += meet
                    base = score[meet]
                    piece = ["", *piece[meet + 1 :]]
                    score = [s - base for s in score[meet:]]
        yield from self._path(piece, n - start)

    @staticmethod
    def _path(piece: list[str], end: int) -> list[str]:
        out = []
        while end > 0:
            out.append(piece[end])
            end -= len(piece[end])
        return out[::-1]

    def _ids(self, text: str) -> list[int]:
        out: list[int] = []
        for p in self.viterbi(text):
            i = self.ids.get(p)
            out.extend([i] if i is not None else [self.byte_ids[b] for b in p.encode()])
        return out

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        text = (MARK if self.prefix else "") + text.replace(" ", MARK)
        if not self.cuts:
            return self._ids(text)
        out: list[int] = []
        words = self.words
        for word in _words(text):
            got = words.get(word)
            if got is None:
                got = self._ids(word)
                if len(word) <= WHOLE:
                    if len(words) >= KEEP_WORDS:
                        words.clear()
                    words[word] = got
            out += got
        return out

    def decode(self, ids: list[int]) -> bytes:
        text_of = self.text_of
        out = b"".join([text_of[i] for i in ids])
        return out[1:] if self.prefix and out[:1] == b" " else out


def _words(text: str) -> Iterator[str]:
    """Cut before each mark that follows another character: a word with the marks before it."""
    held = ""
    for part in text.split(MARK):
        # parts are what stands between marks; an empty part is one more mark
        if part:
            yield held + part
            held = MARK
        else:
            held += MARK
    if len(held) > 1:
        yield held[:-1]


def _parts(text: bytes, size: int) -> Iterator[bytes]:
    """The text cut before spaces (all paths meet there) into parts of about ``size``, the space between two parts left out."""
    at = 0
    while len(text) - at > size:
        cut = text.find(b" ", at + size)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def encode_all(pieces: Pieces, raw: list[bytes], part_bytes: int = PART_BYTES) -> list[np.ndarray]:
    """The ids of each text. Words of texts with single spaces between them go together, about ``part_bytes`` at a time."""
    from panelmill.llm.piece_batches import batches_of

    together = batches_of(pieces) if pieces.prefix else None
    out: list[list[np.ndarray]] = [[] for _ in raw]
    words: list[bytes] = []
    sizes: list[tuple[int, int]] = []
    held = 0

    def flush() -> None:
        if words:
            ids, n = together.encode(words)
            end = np.cumsum(n)
            at = 0
            for k, size in sizes:
                lo = end[at - 1] if at else 0
                at += size
                out[k].append(ids[lo : end[at - 1]])
            words.clear()
            sizes.clear()

    for k, t in enumerate(raw):
        if together is not None and t and not (t[:1] == b" " or b"  " in t or b"\0" in t or _MARK in t):
            for part in _parts(t, part_bytes):
                cut = together.cut(part)
                words.extend(cut)
                sizes.append((k, len(cut)))
                held += len(part)
                if held >= part_bytes:
                    flush()
                    held = 0
        else:
            out[k].append(np.array(pieces.encode(t.decode()), dtype=np.int32))
    flush()
    return [x[0] if len(x) == 1 else np.concatenate([np.zeros(0, np.int32), *x]) for x in out]


_MARK = MARK.encode()
_LOADED: dict[int, Pieces] = {}


def _pieces(model: bytes) -> Pieces:
    """One vocabulary for each worker process."""
    key = hash(model)
    if key not in _LOADED:
        _LOADED[key] = Pieces.load(model)
    return _LOADED[key]


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, n_tokens, ids, exact): exact says whether decoding the ids gives the text again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        for b in slices(batches, "text", 4 << 20):
            raw = texts(b.column(1))
            ids = encode_all(pieces, raw)
            n = list(map(len, ids))
            exact = [pieces.decode(got.tolist()) == t for got, t in zip(ids, raw)]
            at = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            yield pa.record_batch([b.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(np.concatenate(ids))), pa.array(exact)], names=["doc_id", "n_tokens", "ids", "exact"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, exact boolean")


def decode(tokens: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, text) of rows with ids; null ids decode to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        for b in batches:
            out = [pieces.decode(x or []).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op9_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), model_bytes(default_model()))
