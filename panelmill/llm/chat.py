"""Operator 2: chat formatting. Transcripts are parsed by a hidden Markov model and rendered turn by turn.

A transcript is plain lines. Each line is observed as one of a few dozen symbols: the speaker marker it starts with (a name
before a colon, known or not, or none), whether a blank line stands before it, whether it asks something, and its length
class. States are (role, first line of a turn or a later one). Transition, start and emission counts come from the transcripts of
training conversations, whose roles are known, counted by Spark over all of them; Viterbi then recovers the roles of every line,
also where markers are missing or unknown, and runs of lines become turns in one canonical rendering.

``blocks`` makes plain transcripts of a table of turns. What goes wrong in them follows from hashes of conversation and turn, in shares that
``Noise`` gives: markers that are missing, name another role or an unknown speaker, turns that no blank line ends, and texts whose second
line quotes a speaker. The query uses ``LOGS``, where half the turns have no right marker. A block always ends with a blank line. Marker
names that aren't known, and quoted ones, stay in the text. ``by_markers`` is the plain rule to hold the model against: a turn starts
after a blank line or at a known marker and has the marker's role, else the other one of user and assistant.

A conversation may be of any length. Turns are range-partitioned by conversation and turn, so a long one spans several tasks, and
cut into blocks of whole turns. A conversation in one block is decoded on its own. For longer ones each block gives a table of best
scores from the state before it to its last state (a max-plus product of its steps); these are multiplied up for each partition, a
Viterbi pass over them and then over the blocks of each partition fixes the states at all block ends, and each block is
decoded between its own two. The path is the best one over the whole conversation. Each block is one row of the result.

Nulls: a null text is an empty turn, a null turn sorts first, a null role is ``user``; a row with a null conv_id is a conversation of
its own. Roles: ``tool`` and ``function`` are ``tool``, any other unknown one is ``user``. Repeated turns stay, ordered by turn, role and a
hash of the text. In renderings a ``<|`` of a text gets a backslash, ``<\\|`` another one, so that no text can end or start a turn
(``unescaped`` undoes it); blank lines at a turn's end go. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelmill.session import written

ROLES = ["system", "user", "assistant", "tool"]
#: Usual speaker names of each role.
NAMES = {"system": ["System", "Instructions"], "user": ["User", "Human", "Q"], "assistant": ["Assistant", "AI", "A"], "tool": ["Tool", "Function"]}
MARKERS = {n.lower(): k for k, r in enumerate(ROLES) for n in NAMES[r]}
STRANGERS = ["Bot", "Guest", "Speaker 1"]
N_MARKER, N_LENGTH = len(ROLES) + 2, 8
SYMBOLS = N_MARKER * 2 * 2 * N_LENGTH
STATES = 2 * len(ROLES)
START = STATES  # in place of a state before the first line
FOLDS = 5
BLOCK_CHARS = 1 << 18


@dataclass(frozen=True)
class Noise:
    """Of 60 turns, how many have no marker, one of another role or one of an unknown speaker, no blank line after them, a quote in their second line."""

    unmarked: int = 12
    wrong: int = 0
    strange: int = 0
    unbroken: int = 0
    quoting: int = 0


LOGS = Noise(unmarked=18, wrong=8, strange=4, unbroken=20, quoting=10)

_SPEAKER = re.compile(r"^\s*[\[<*#]*\s*([A-Za-z][\w ]{0,20}?)\s*[\]>*]*\s*:\s?")


def observe(lines: list[str]) -> list[int]:
    """The symbol of each line; a blank line or nothing stands before the first."""
    out = []
    blank = True
    for line in lines:
        m = _SPEAKER.match(line)
        marker = MARKERS.get(m[1].lower(), N_MARKER - 2) if m else N_MARKER - 1
        length = min(N_LENGTH - 1, 1 + (len(line) // 20).bit_length()) if line else 0
        out.append(((marker * 2 + blank) * 2 + line.rstrip().endswith("?")) * N_LENGTH + length)
        blank = not line.strip()
    return out


def by_markers(lines: list[str]) -> list[int]:
    """The role of each line by markers and blank lines alone."""
    out: list[int] = []
    blank, other = True, {1: 2, 2: 1}
    for line in lines:
        m = _SPEAKER.match(line)
        known = MARKERS.get(m[1].lower()) if m else None
        if known is not None:
            out.append(known)
        elif blank and line.strip():
            out.append(other.get(out[-1], 1) if out else 1)
        else:
            out.append(out[-1] if out else 1)
        blank = not line.strip()
    return out


def blocks(turns: DataFrame, block_chars: int = BLOCK_CHARS, partitions: int | None = None, noise: Noise = Noise()) -> DataFrame:
    """Blocks of whole turns: (part, seq, conv_id, own, whole, before, transcript, roles, sizes).

    (part, seq) orders them; ``own`` tells rows with a null conv_id apart; ``whole`` says that the block is all of its conversation;
    ``before`` is the state of the line before it, START at a conversation's start, -1 at a partition's start, where it isn't known;
    ``roles`` and ``sizes`` are the true role and number of lines of each turn.
    """
    role = F.lower(F.coalesce("role", F.lit("user")))
    role = F.when(role == "function", "tool").when(role.isin(ROLES), role).otherwise("user")
    draw = lambda salt: F.pmod(F.xxhash64("conv_id", "turn", F.lit(salt)), F.lit(60))
    named = lambda names, n: F.get(F.array(*map(F.lit, names)), F.pmod(n, F.lit(len(names))).cast("int"))
    right = F.coalesce(*[F.when(role == r, named(names, draw(3))) for r, names in NAMES.items()])
    wrong = F.coalesce(*[F.when(role == r, named([n for o in ROLES if o != r for n in NAMES[o]], draw(3))) for r in ROLES])
    kind, text = draw(5), F.coalesce("text", F.lit(""))
    # Without a second line there is nothing to quote in.
    quote = F.concat(F.lit("\n"), named([n for names in NAMES.values() for n in names], draw(7)), F.lit(": "))
    at = F.instr(text, "\n")
    body = F.when((draw(11) < noise.quoting) & (at > 0), F.concat(F.substr(text, F.lit(1), at - 1), quote, F.substr(text, at + 1))).otherwise(text)
    u, w = noise.unmarked, noise.unmarked + noise.wrong
    name = F.when(kind < w, wrong).when(kind < w + noise.strange, named(STRANGERS, draw(3))).otherwise(right)
    marked = F.when(kind < u, body).otherwise(F.concat(name, F.lit(": "), body))
    marked = F.concat(marked, F.when(draw(13) < noise.unbroken, "\n").otherwise("\n\n"))
    row = F.monotonically_increasing_id()
    rows = turns.select(F.col("conv_id").cast("long"), F.when(F.col("conv_id").isNull(), row).otherwise(F.lit(0)).alias("own"), F.col("turn").cast("long"), role.alias("role"), F.xxhash64(text).alias("tie"), row.alias("row"), marked.alias("text"))
    order = ["conv_id", "own", "turn", "role", "tie", "row"]
    rows = rows.repartitionByRange(*([partitions] if partitions else []), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()))
        names = ["part", "seq", "conv_id", "own", "whole", "before", "transcript", "roles", "sizes"]
        out: list[tuple] = []
        key, before, opened, turns, chars = None, -1, False, [], 0

        def cut(whole: bool) -> None:
            nonlocal seq, turns, chars, before
            if not turns[-1][1].endswith("\n\n"):
                turns[-1] = (turns[-1][0], turns[-1][1] + "\n")
            sizes = [t.count("\n") for _, t in turns]
            out.append((part, seq, *key, whole, before, "".join([t for _, t in turns]), [r for r, _ in turns], sizes))
            before = 2 * ROLES.index(turns[-1][0]) + 1
            seq, turns, chars = seq + 1, [], 0

        for b in batches:
            for conv, own, role, text in zip(*(b.column(k).to_pylist() for k in (0, 1, 3, 6))):
                if (conv, own) != key:
                    if turns:
                        cut(whole=opened)
                    opened, before = key is not None, START if key is not None else -1
                    key = (conv, own)
                elif chars > block_chars:
                    opened = False
                    cut(whole=False)
                turns.append((role, text))
                chars += len(text)
            if len(out) >= 64:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                out.clear()
        if turns:
            cut(whole=False)
        if out:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    schema = "part int, seq long, conv_id long, own long, whole boolean, before int, transcript string, roles array<string>, sizes array<int>"
    return written(rows.mapInArrow(run, schema), "chat-blocks")


@dataclass
class Model:
    """Log probabilities of first states, steps and symbols."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    def enter(self) -> np.ndarray:
        """Log probabilities of a step from each state, and from nothing (START)."""
        return np.concatenate([self.move, self.start[None]])


def held_out(folds: int = FOLDS):
    """Conversations that training leaves out."""
    return F.coalesce(F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(folds)) == 0, F.lit(False))


def train(known: DataFrame) -> Model:
    """The model counted over all blocks of ``known``."""
    known = known.select("part", "seq", "conv_id", "own", "before", "transcript", "roles", "sizes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter, emit = np.zeros((STATES + 1, STATES), np.int64), np.zeros((STATES, SYMBOLS), np.int64)
        for b in batches:
            for before, text, roles, sizes in zip(*(b.column(k).to_pylist() for k in (4, 5, 6, 7))):
                states = [2 * ROLES.index(r) + (k > 0) for r, n in zip(roles, sizes) for k in range(n)]
                if before >= 0:
                    enter[before, states[0]] += 1
                np.add.at(enter, (states[:-1], states[1:]), 1)
                np.add.at(emit, (states, observe(text.split("\n")[:-1])), 1)
        counts = np.concatenate([enter.ravel(), emit.ravel()])
        at = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(at), pa.array(counts[at])], names=["at", "n"])

    # The step into each partition's first block: one row a partition, with the last block of the partition before.
    state = lambda c, later: 2 * (F.array_position(F.array(*map(F.lit, ROLES)), c) - 1) + later
    ends = F.struct("conv_id", "own", state(F.get("roles", F.lit(0)), 0).alias("first"), state(F.element_at("roles", -1), 1).alias("last"))
    parts = known.groupBy("part").agg(F.min_by(ends, "seq").alias("head"), F.max_by(ends, "seq").alias("tail"))
    tail = F.lag("tail").over(Window.orderBy("part"))
    goes_on = F.col("tail_before.conv_id").eqNullSafe(F.col("head.conv_id")) & (F.col("tail_before.own") == F.col("head.own"))
    edges = parts.withColumn("tail_before", tail).select((F.when(goes_on, F.col("tail_before.last")).otherwise(F.lit(START)) * STATES + F.col("head.first")).cast("long").alias("at"), F.lit(1).cast("long").alias("n"))
    counts = np.zeros((STATES + 1) * STATES + STATES * SYMBOLS)
    for at, n in known.mapInArrow(run, "at long, n long").union(edges).groupBy("at").agg(F.sum("n")).collect():  # as many rows as the model has parameters
        counts[at] = n
    enter, emit = np.split(counts + 0.05, [(STATES + 1) * STATES])
    log = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    enter, emit = log(enter.reshape(STATES + 1, STATES)), log(emit.reshape(STATES, SYMBOLS))
    return Model(enter[START], enter[:STATES], emit)


def viterbi(symbols: list[int], model: Model, before: int = START, last: int | None = None) -> np.ndarray:
    """The likeliest states after the state ``before``, ending in ``last`` if it is given; of equal paths the one with lower numbers."""
    score = model.enter()[before] + model.emit[:, symbols[0]]
    back = np.zeros((len(symbols), len(score)), dtype=np.int8)
    for t in range(1, len(symbols)):
        each = score[:, None] + model.move
        back[t] = each.argmax(axis=0)
        score = each.max(axis=0) + model.emit[:, symbols[t]]
    out = np.zeros(len(symbols), dtype=np.int64)
    out[-1] = int(score.argmax()) if last is None else last
    for t in range(len(symbols) - 1, 0, -1):
        out[t - 1] = back[t, out[t]]
    return out


def product(symbols: list[int], model: Model) -> np.ndarray:
    """Best scores from each state before the first line (or START) to each state of the last line."""
    score = model.enter() + model.emit[:, symbols[0]]
    for s in symbols[1:]:
        score = (score[:, :, None] + model.move[None]).max(axis=1) + model.emit[:, s]
    return score


def chain(tables: list[np.ndarray], before: int = START, last: int | None = None) -> list[int]:
    """The likeliest last states of consecutive blocks, from their tables of best scores."""
    score, back = tables[0][before], []
    for x in tables[1:]:
        each = score[:, None] + x[:STATES]
        back.append(each.argmax(axis=0))
        score = each.max(axis=0)
    out = [int(score.argmax()) if last is None else last]
    for b in reversed(back):
        out.append(int(b[out[-1]]))
    return out[::-1]


def _ends(parted: DataFrame, model: Model) -> DataFrame:
    """(part, seq, entry, exit, segment) of the blocks of conversations in several blocks."""

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [product(observe(t.split("\n")[:-1]), model).ravel().tolist() for t in b.column(4).to_pylist()]
            yield pa.record_batch([*b.columns[:4], pa.array(got, pa.list_(pa.float64()))], names=["part", "seq", "conv_id", "own", "scores"])

    read = lambda rows: [np.array(x).reshape(STATES + 1, STATES) for x in rows.to_pylist()]

    def multiplied(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        each = read(table.column("scores"))
        out = each[0]
        for x in each[1:]:
            out = (out[:, :, None] + x[None, :STATES]).max(axis=1)
        return pa.table({"part": table.column("part")[:1], "conv_id": table.column("conv_id")[:1], "own": table.column("own")[:1], "n": pa.array([len(each)], pa.int64()), "scores": pa.array([out.ravel().tolist()], pa.list_(pa.float64()))})

    def solved(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        last = chain(read(table.column("scores")))
        n = np.array(table.column("n").to_pylist())
        return pa.table({"part": table.column("part"), "conv_id": table.column("conv_id"), "own": table.column("own"), "entry": pa.array([START, *last[:-1]], pa.int32()), "exit": pa.array(last, pa.int32()), "segment": pa.array(np.cumsum(n) - n)})

    def within(key: tuple, table: pa.Table, ends: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        entry, exit_, first = (ends.column(c)[0].as_py() for c in ("entry", "exit", "segment"))
        last = chain(read(table.column("scores")), entry, exit_)
        return pa.table({"part": table.column("part"), "seq": table.column("seq"), "entry": pa.array([entry, *last[:-1]], pa.int32()), "exit": pa.array(last, pa.int32()), "segment": pa.array(np.arange(first, first + len(last)))})

    each = written(parted.select("part", "seq", "conv_id", "own", "transcript").mapInArrow(tables, "part int, seq long, conv_id long, own long, scores array<double>"), "chat-scores")
    each_part = each.groupBy("conv_id", "own", "part").applyInArrow(multiplied, "part int, conv_id long, own long, n long, scores array<double>")
    ends = written(each_part.groupBy("conv_id", "own").applyInArrow(solved, "part int, conv_id long, own long, entry int, exit int, segment long"), "chat-ends")
    both = each.groupBy("conv_id", "own", "part").cogroup(ends.groupBy("conv_id", "own", "part"))
    return both.applyInArrow(within, "part int, seq long, entry int, exit int, segment long")


def turns_of(lines: list[str], states: np.ndarray) -> list[tuple[str, str]]:
    """(role, text) of each turn, markers taken off."""
    out: list[tuple[str, list[str]]] = []
    for line, state in zip(lines, states.tolist()):
        if state % 2 == 0 or not out:
            m = _SPEAKER.match(line) if state % 2 == 0 else None
            out.append((ROLES[state // 2], [line[m.end() :] if m and m[1].lower() in MARKERS else line]))
        else:
            out[-1][1].append(line)
    return [(r, "\n".join(x).rstrip("\n")) for r, x in out]


def parse(text: str, model: Model) -> list[tuple[str, str]]:
    """(role, text) of each turn of a plain transcript."""
    lines = text.split("\n")
    return turns_of(lines, viterbi(observe(lines), model))


def escaped(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> str:
    return "".join(f"<|{role}|>\n{escaped(text)}\n<|end|>\n" for role, text in turns)


def format_blocks(plain: DataFrame, model: Model, folds: int = FOLDS) -> DataFrame:
    """(conv_id, segment, continues, held_out, n_turns, roles, recovered, n_lines, lines_right, lines_by_markers, rendered) of each block.

    ``segment`` counts the blocks of a conversation, ``continues`` says that a block's first turn is more of the last one of the block
    before, ``recovered`` that the roles found are the true ones, ``held_out`` that training left the conversation out. Of ``n_lines`` lines that
    aren't blank, ``lines_right`` have their true role, and ``lines_by_markers`` would have it by the plain rule.
    """
    names = ["conv_id", "segment", "continues", "held_out", "n_turns", "roles", "recovered", "n_lines", "lines_right", "lines_by_markers", "rendered"]
    columns = ["conv_id", "segment", "entry", "exit", "held_out", "transcript", "roles", "sizes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            goes_on, found, lines_of = [], [], []
            for entry, exit_, text, true, sizes in zip(*(b.column(k).to_pylist() for k in (2, 3, 5, 6, 7))):
                lines = text.split("\n")[:-1]
                states = viterbi(observe(lines), model, entry, exit_)
                goes_on.append(entry != START and bool(states[0] % 2))
                found.append(turns_of(lines, states))
                use = np.array([bool(line.strip()) for line in lines])
                want = np.repeat([ROLES.index(r) for r in true], sizes)
                lines_of.append((int(use.sum()), *(int((use & (got == want)).sum()) for got in (states // 2, np.array(by_markers(lines))))))
            roles = [[r for r, _ in x] for x in found]
            right = [r == t for r, t in zip(roles, b.column(6).to_pylist())]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(goes_on, pa.bool_()), b.column(4), pa.array(map(len, found), pa.int64()), pa.array(roles, pa.list_(pa.string())), pa.array(right, pa.bool_()), *(pa.array([x[k] for x in lines_of], pa.int64()) for k in range(3)), pa.array(map(render, found), pa.string())], names=names)

    plain = plain.withColumn("held_out", held_out(folds))
    alone = plain.where("whole").withColumns({"segment": F.lit(0).cast("long"), "entry": F.lit(START), "exit": F.lit(None).cast("int")})
    parted = plain.where("NOT whole")
    # Two blocks a partition at least come here, its first and last one: they may go on in the next.
    parted = parted.join(_ends(parted, model), ["part", "seq"])
    return alone.select(*columns).union(parted.select(*columns)).mapInArrow(run, "conv_id long, segment long, continues boolean, held_out boolean, n_turns long, roles array<string>, recovered boolean, n_lines long, lines_right long, lines_by_markers long, rendered string")


def op2_chat_format(spark, sf_dir: str) -> DataFrame:
    plain = blocks(spark.read.parquet(f"{sf_dir}/conversations.parquet"), noise=LOGS)
    return format_blocks(plain, train(plain.where(~held_out())))
