"""Operator 6: quality rules as a learned decision list, with DataFrame functions only.

Every text gets countable statistics (words, symbols, repeated lines and word windows, capitals and so on). Sequential
covering learns an ordered list of rules "if a >= x and b < y then reject": a rule grows by the threshold that gains
most (FOIL gain) on the growing part of the labelled rows, is pruned on the other part, takes the rows it covers out,
and the next rule is learned from the rest, until no rule is precise enough. The list becomes one Spark conditional
expression; the number of the rule that fired is returned.

Learning is one aggregation: each labelled row falls into a cell, given by the part it belongs to and the interval of
each statistic between fixed thresholds, and Spark counts good and bad rows for each cell. The number of cells is
bounded by the thresholds, not by the rows, and all labelled rows count.

Nulls: a null text has no words, so it fails the base rule. Labels with a null doc_id or a null mark don't count; several
labels of one document all count. Without any rejected label the list is empty and the base rule alone decides. Rows with
equal doc_id are judged one by one. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.session import written

SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: What a threshold may be, for each statistic; the last two settings bound the list.
THRESHOLDS: dict[str, list[float]] = {
    "symbols_per_word": [0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 1.0],
    "repeat_share": [0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.7],
    "dup_line_share": [0.05, 0.1, 0.2, 0.3, 0.5],
    "chars_per_word": [3.0, 4.0, 5.0, 7.0, 9.0, 12.0],
    "capital_share": [0.05, 0.1, 0.2, 0.4, 0.6],
    "marks_per_word": [0.05, 0.1, 0.2, 0.4, 0.8],
    "n_words": [50, 80, 120, 200, 400],
}
MAX_RULES = 8
MAX_CONDITIONS = 3
PRECISION = 0.8
LEAST_COVER = 5


def statistics(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id and the counts of each text, with ``carry`` also the whole row as the struct ``row``; one pass, no shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    held = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *held)
    held = ["row"] if carry else []
    parts = base.select(
        "doc_id",
        "text",
        *held,
        F.array_remove(F.split("text", SPACE, -1), "").alias("words"),
        F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.translate("text", BLANKS, "").alias("solid"),
    ).withColumn("n", F.size("words"))
    # Windows sorted by hash and place: equal ones are neighbours. Neighbours of one hash count if their words are equal.
    windows = F.when(
        F.col("n") >= 3,
        F.expr("sort_array(transform(sequence(0, n - 3), i -> struct(xxhash64(words[i], words[i + 1], words[i + 2]) AS h, i AS i)))"),
    ).otherwise(F.expr("cast(array() AS array<struct<h: bigint, i: int>>)"))
    same = "(get(w, {j}).h = x.h AND words[get(w, {j}).i] = words[x.i] AND words[get(w, {j}).i + 1] = words[x.i + 1] AND words[get(w, {j}).i + 2] = words[x.i + 2])"
    twice = F.expr(f"sort_array(filter(transform(w, (x, j) -> CASE WHEN (j > 0 AND {same.format(j='j - 1')}) OR {same.format(j='j + 1')} THEN x.i ELSE -1 END), i -> i >= 0))")
    covered = F.expr("aggregate(twice, struct(-3 AS p, 0L AS c), (a, i) -> struct(i AS p, a.c + least(3, i - a.p) AS c), a -> a.c)")
    count = lambda marks: (F.length("solid") - F.length(F.translate("solid", marks, ""))).cast("long")
    return (
        parts.withColumn("w", windows)
        .withColumn("twice", twice)
        .select(
            "doc_id",
            F.col("n").cast("long").alias("n_words"),
            F.length("solid").cast("long").alias("word_chars"),
            count(SYMBOLS).alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            covered.alias("n_repeat_words"),
            F.size("lines").cast("long").alias("n_lines"),
            F.length(F.regexp_replace("solid", r"[^\p{Lu}]+", "")).cast("long").alias("n_capitals"),
            count("!?").alias("n_marks"),
            *held,
        )
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def measures() -> dict[str, Column]:
    """The statistics that rules may test; a text without words has 0 everywhere."""
    per = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return {
        "symbols_per_word": per("n_symbols", "n_words"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "chars_per_word": per("word_chars", "n_words"),
        "capital_share": per("n_capitals", "word_chars"),
        "marks_per_word": per("n_marks", "n_words"),
        "n_words": F.col("n_words").cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    measure: str
    threshold: float
    above: bool

    def column(self) -> Column:
        value = measures()[self.measure]
        return value >= self.threshold if self.above else value < self.threshold


@dataclass
class Rule:
    conditions: list[Condition]
    covered: int = 0
    precision: float = 0.0


@dataclass
class DecisionList:
    rules: list[Rule] = field(default_factory=list)

    def fired(self) -> Column:
        """The 1-based number of the first rule that holds, 0 if none does."""
        out = F.lit(0)
        for k in range(len(self.rules), 0, -1):
            test = F.lit(True)
            for c in self.rules[k - 1].conditions:
                test = test & c.column()
            out = F.when(test, F.lit(k)).otherwise(out)
        return out


def cells(stats: DataFrame, labels: DataFrame, thresholds: dict[str, list[float]] = THRESHOLDS) -> DataFrame:
    """Good and bad labelled rows for each part and each combination of intervals."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("mark")).where("doc_id IS NOT NULL AND mark IS NOT NULL")
    known = measures()
    bins = {m: sum((known[m] >= t).cast("int") for t in cuts) for m, cuts in thresholds.items()}
    part = (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0).cast("int")
    rows = stats.where("doc_id IS NOT NULL").join(marked, "doc_id").select(part.alias("part"), "mark", *[b.alias(m) for m, b in bins.items()])
    return rows.groupBy("part", *thresholds).agg(F.sum((F.col("mark") == 0).cast("long")).alias("bad"), F.sum((F.col("mark") != 0).cast("long")).alias("good"))


def _holds(rule: list[tuple[int, int, bool]], cell: tuple) -> bool:
    return all((cell[m] > t) == above for m, t, above in rule)


def _counts(rule: list[tuple[int, int, bool]], rows: list[tuple]) -> tuple[int, int]:
    bad = good = 0
    for cell, b, g in rows:
        if _holds(rule, cell):
            bad += b
            good += g
    return bad, good


def _grow(rows: list[tuple], sizes: list[int], max_conditions: int) -> list[tuple[int, int, bool]]:
    rule: list[tuple[int, int, bool]] = []
    while len(rule) < max_conditions:
        bad = [[0] * (n + 1) for n in sizes]
        good = [[0] * (n + 1) for n in sizes]
        for cell, b, g in rows:
            for m, at in enumerate(cell):
                bad[m][at] += b
                good[m][at] += g
        all_bad, all_good = sum(bad[0]), sum(good[0])
        if not all_bad or not all_good:
            break
        best = (1e-9, None)
        for m, n in enumerate(sizes):
            low_bad = low_good = 0
            for t in range(n):  # below: interval <= t, that is value < threshold t
                low_bad += bad[m][t]
                low_good += good[m][t]
                for above, b, g in ((False, low_bad, low_good), (True, all_bad - low_bad, all_good - low_good)):
                    if b:
                        gain = b * (log2(b / (b + g)) - log2(all_bad / (all_bad + all_good)))
                        best = max(best, (gain, (m, t, above)), key=lambda x: x[0])
        if best[1] is None:
            break
        rule.append(best[1])
        rows = [r for r in rows if _holds(rule[-1:], r[0])]
    return rule


def learn(counted: list[tuple], thresholds: dict[str, list[float]] = THRESHOLDS, max_rules: int = MAX_RULES, max_conditions: int = MAX_CONDITIONS, precision: float = PRECISION) -> DecisionList:
    """The decision list for rows (part, interval of each statistic..., bad, good), part 0 growing and part 1 pruning."""
    names = list(thresholds)
    sizes = [len(thresholds[m]) for m in names]
    rows = sorted((r[0], tuple(r[1:-2]), r[-2], r[-1]) for r in counted)
    grow = [r[1:] for r in rows if r[0] == 0]
    prune = [r[1:] for r in rows if r[0] == 1]
    found = DecisionList()
    while len(found.rules) < max_rules:
        rule = _grow(grow, sizes, max_conditions)
        if not rule:
            break

        def worth(r: list) -> float:
            b, g = _counts(r, prune)
            return (b - g) / (b + g) if b + g else -1.0

        shorter = max((rule[:n] for n in range(len(rule), 0, -1)), key=worth)
        b, g = (x + y for x, y in zip(_counts(shorter, grow), _counts(shorter, prune)))
        if b < LEAST_COVER or b < precision * (b + g):
            break
        found.rules.append(Rule([Condition(names[m], thresholds[names[m]][t], above) for m, t, above in shorter], b + g, b / (b + g)))
        grow = [r for r in grow if not _holds(shorter, r[0])]
        prune = [r for r in prune if not _holds(shorter, r[0])]
    return found


def judge(docs: DataFrame, labels: DataFrame, thresholds: dict[str, list[float]] = THRESHOLDS) -> DataFrame:
    """The statistics of each document with base_failed, rule (0: none fired) and kept."""
    stats = written(statistics(docs), "quality-statistics")
    rules = learn([tuple(r) for r in cells(stats, labels, thresholds).collect()], thresholds)
    return stats.withColumns({"base_failed": base_failed(), "rule": rules.fired()}).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def kept_documents(docs: DataFrame, labels: DataFrame, thresholds: dict[str, list[float]] = THRESHOLDS) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. Rows and statistics are written once; the labelled ones are
    counted for learning and the decision list is then a filter on what was written. Texts are not shuffled."""
    rows = written(statistics(docs, carry=True), "quality-rows")
    rules = learn([tuple(r) for r in cells(rows.drop("row"), labels, thresholds).collect()], thresholds)
    return rows.where(~base_failed() & (rules.fired() == 0)).select("row.*")


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    found = judge(read("documents"), read("labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
