"""Data-quality gates. Each gives a table of violations; ``enforce`` turns one into an error.

A gate that checked no rows reports that as a violation itself: nothing checked is not a pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelmill.operators.panel import MONEY, on_calendar


class GateError(AssertionError):
    """A gate found violations."""


def enforce(violations: DataFrame, name: str, show: int = 5) -> None:
    found = violations.limit(show).collect()
    if found:
        raise GateError(f"{name}: {[r.asDict() for r in found]}")


def require_columns(df: DataFrame, required: list[str], name: str) -> None:
    if missing := [c for c in required if c not in df.columns]:
        raise GateError(f"{name} lacks {missing}")


def trim_to_allowlist(df: DataFrame, required: list[str], allowed: list[str] | None, name: str) -> DataFrame:
    """Only declared columns go on: a new upstream column never becomes a feature."""
    require_columns(df, required, name)
    keep = [*required, *(allowed or [])]
    return df.select([c for c in keep if c in df.columns])


def close(a: Column, b: Column, rtol: float = 1e-9, atol: float = 1e-8) -> Column:
    return F.abs(a - b) <= F.lit(atol) + rtol * F.abs(b)


def same_amount(a: Column, b: Column) -> Column:
    """Close, and the same to the cent: on amounts of a billion the relative tolerance alone lets a whole unit pass. False for nulls."""
    return F.coalesce(close(a, b) & (a.cast(MONEY) == b.cast(MONEY)), F.lit(False))


def check(name: str, rows: DataFrame, bad: Column) -> DataFrame:
    """One row: (gate, checked, violations, ok), ok only if rows were checked and none is bad."""
    found = rows.agg(F.count("*").alias("checked"), F.coalesce(F.sum(F.coalesce(bad, F.lit(True)).cast("long")), F.lit(0)).alias("violations"))
    return found.select(F.lit(name).alias("gate"), "checked", "violations", ((F.col("checked") > 0) & (F.col("violations") == 0)).alias("ok"))


def unique_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def unmatched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, keys, "left_anti")


def same_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only."""
    left, right = a.select(*keys).distinct().withColumn("_a", F.lit(True)), b.select(*keys).distinct().withColumn("_b", F.lit(True))
    both = left.join(right, keys, "full_outer")
    return both.where("_a IS NULL OR _b IS NULL").select(*keys, F.when(F.col("_a").isNull(), "right_only").otherwise("left_only").alias("side"))


def lineage_facts(df: DataFrame, column: str = "feature_run_id") -> DataFrame:
    """One row: how many values and nulls a lineage column has, and the greatest value."""
    return df.agg(F.countDistinct(column).alias("ids"), F.count_if(F.col(column).isNull()).alias("nulls"), F.max(column).alias("id"))


def other_runs(tables: dict[str, DataFrame], run_id: str) -> DataFrame:
    """(table_name, n_rows, n_other_run): rows of each table that another run, or none, has stamped."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"), F.count_if(~F.col("run_id").eqNullSafe(F.lit(run_id))).alias("n_other_run"))
        out = row if out is None else out.unionByName(row)
    return out


def disjoint(calibration: DataFrame, starts: DataFrame) -> DataFrame:
    """One row (last_calibration_month, first_start_month, disjoint): every month that calibration predicts lies before the backtest's."""
    rows = calibration.agg(F.max("target_month").alias("last_calibration_month")).crossJoin(starts.agg(F.min("start_month").alias("first_start_month")))
    return rows.withColumn("disjoint", F.coalesce(F.col("last_calibration_month") < F.col("first_start_month"), F.lit(False)))


def single_lineage(df: DataFrame, column: str = "feature_run_id", expected: str | None = None) -> DataFrame:
    """A violation row unless the column has exactly one value, no null, and the expected one."""
    rows = lineage_facts(df, column)
    bad = (F.col("ids") != 1) | (F.col("nulls") > 0)
    return rows.where(bad | (F.col("id") != expected) if expected else bad)


def uncovered_weeks(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    return panel.select("ds").distinct().join(F.broadcast(calendar.select("ds")), "ds", "left_anti")


def fiscal_position(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """Weekly actuals rekeyed to (unique_id, month, week of month)."""
    return on_calendar(panel, calendar).select("unique_id", "fiscal_year_month", "fiscal_week_of_month", "y")


def feature_drift(df: DataFrame, declared: list[str], lags: list[int], rolling: dict[int, int]) -> list[str]:
    """Names that are emitted but not declared or the other way round, and a note if their number isn't lags + transforms."""
    emitted = [c for c in df.columns if c not in ("unique_id", "ds", "y")]
    odd = sorted(set(emitted) ^ set(declared))
    return odd + ([f"{len(emitted)} features"] if len(emitted) != len(lags) + len(rolling) else [])


def lag_alignment(features: DataFrame, panel: DataFrame, k: int) -> DataFrame:
    """Rows whose lag isn't the panel's value k weeks before, by dates and not by row order."""
    past = panel.select("unique_id", F.date_add("ds", 7 * k).alias("ds"), F.col("y").alias("expected"))
    return features.join(past, ["unique_id", "ds"], "left").select("unique_id", "ds", F.col(f"lag{k}").alias("found"), "expected").where(~F.col("found").eqNullSafe(F.col("expected")))


def mtd_increments(table: DataFrame, panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """Origins with whether month-to-date starts at 0 and grows by the week's actual; an origin whose week before is absent isn't ok."""
    w = Window.partitionBy("unique_id", "target_month").orderBy("weeks_actualized")
    weeks = fiscal_position(panel, calendar).select("unique_id", F.col("fiscal_year_month").alias("target_month"), F.col("fiscal_week_of_month").alias("weeks_actualized"), "y")
    mtd = F.col("mtd_revenue").cast(MONEY)
    added = {"grown": F.col("mtd_revenue") - F.lag("mtd_revenue").over(w), "added": (mtd - F.lag(mtd).over(w)).cast("double")}
    rows = table.select("unique_id", "target_month", "weeks_actualized", "mtd_revenue").withColumns(added)
    joined = rows.join(weeks, ["unique_id", "target_month", "weeks_actualized"], "left")
    ok = F.when(F.col("weeks_actualized") == 0, F.col("mtd_revenue") == 0).otherwise(same_amount(F.col("added"), F.col("y")))
    return joined.select("unique_id", "target_month", "weeks_actualized", "mtd_revenue", "grown", "y", F.coalesce(ok, F.lit(False)).alias("ok"))


def week_zero_coverage(table: DataFrame, totals: DataFrame) -> DataFrame:
    """(unique_id, target_month, side): active pairs of the table's months without a week-0 origin, and week-0 origins of no active pair."""
    keys = ["unique_id", "target_month"]
    active = totals.select("unique_id", F.col("fiscal_year_month").alias("target_month")).join(table.select("target_month").distinct(), "target_month", "left_semi")
    return same_keys(active.distinct(), table.where("weeks_actualized = 0").select(*keys).distinct(), keys)


def total_reconciliation(table: DataFrame, panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """Month total against month-to-date at the last origin plus the final week."""
    last = fiscal_position(panel, calendar).select("unique_id", F.col("fiscal_year_month").alias("target_month"), F.col("fiscal_week_of_month").alias("weeks_in_month"), F.col("y").alias("final_week"))
    rows = table.where(F.col("weeks_actualized") == F.col("weeks_in_month") - 1).join(last, ["unique_id", "target_month", "weeks_in_month"], "left")
    rebuilt = (F.col("mtd_revenue").cast(MONEY) + F.col("final_week").cast(MONEY)).cast("double")
    return rows.select("unique_id", "target_month", "actual_monthly_total", rebuilt.alias("rebuilt")).withColumn("ok", same_amount(F.col("actual_monthly_total"), F.col("rebuilt")))


def remaining_identity(table: DataFrame, panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """The remaining target against the sum of the weeks after the origin, with their number."""
    weeks = fiscal_position(panel, calendar).select("unique_id", F.col("fiscal_year_month").alias("target_month"), "fiscal_week_of_month", "y")
    rows = table.join(weeks, ["unique_id", "target_month"]).where(F.col("fiscal_week_of_month") > F.col("weeks_actualized"))
    made = rows.groupBy("unique_id", "target_month", "weeks_actualized", "weeks_in_month", "remaining_target").agg(F.sum(F.col("y").cast(MONEY)).cast("double").alias("summed"), F.count("*").alias("weeks"))
    ok = same_amount(F.col("remaining_target"), F.col("summed")) & (F.col("weeks") == F.col("weeks_in_month") - F.col("weeks_actualized"))
    return made.withColumn("ok", ok)


def join_integrity(model: DataFrame, table: DataFrame, features: DataFrame) -> DataFrame:
    """(gate, checked, violations): unique feature keys, every origin matched, no rows lost or made, the same key types. ``checked`` counts
    the rows that a gate had to look at: a gate that checked none is a violation."""
    keys = ["unique_id", "ds"]
    spark = model.sparkSession
    dup = unique_keys(features, keys).agg(F.count("*").alias("violations")).select(F.lit("unique_feature_keys").alias("gate"), "violations")
    lost = unmatched(table.select("unique_id", F.date_add("forecast_origin_date", 7).alias("ds")), features, keys).agg(F.count("*").alias("violations")).select(F.lit("origins_without_features").alias("gate"), "violations")
    rows = model.agg(F.count("*").alias("a")).crossJoin(table.agg(F.count("*").alias("b"))).select(F.lit("row_count").alias("gate"), F.abs(F.col("a") - F.col("b")).alias("violations"))
    kinds = {c: dict(features.dtypes)[c] for c in keys}
    types = spark.createDataFrame([("key_types", int(kinds["unique_id"] != dict(table.dtypes)["unique_id"]))], "gate string, violations long")
    sizes = {"unique_feature_keys": features, "origins_without_features": table, "row_count": table, "key_types": features}
    checked = None
    for gate, df in sizes.items():
        row = df.agg(F.lit(gate).alias("gate"), F.count("*").alias("checked"))
        checked = row if checked is None else checked.unionByName(row)
    found = checked.join(dup.union(lost).union(rows).union(types), "gate")
    return found.select("gate", "checked", F.when(F.col("checked") == 0, F.lit(1)).otherwise(F.col("violations")).cast("long").alias("violations"))


def shared_cutoff(model: DataFrame, panel: DataFrame, lags: list[int]) -> DataFrame:
    """Rows of the modelling table whose lag k isn't the panel's value k - 1 weeks before the origin."""
    out = None
    for k in lags:
        past = panel.select("unique_id", F.date_add("ds", 7 * (k - 1)).alias("forecast_origin_date"), F.col("y").alias("expected"))
        bad = model.join(past, ["unique_id", "forecast_origin_date"], "left").where(~F.col(f"lag{k}").eqNullSafe(F.col("expected"))).select("unique_id", "forecast_origin_date", F.lit(k).alias("lag"))
        out = bad if out is None else out.union(bad)
    return out


def feature_partition(df: DataFrame, keys: list[str], parts: dict[str, list[str]]) -> list[str]:
    """Features of ``df`` that aren't in exactly one part, and names in parts that ``df`` lacks: a leakage check is only as whole as this."""
    named = [c for part in parts.values() for c in part]
    return sorted({c for c in df.columns if c not in keys and named.count(c) != 1} | (set(named) - set(df.columns)) | {c for c in named if named.count(c) > 1})


def leakage(panel: DataFrame, rebuild: Callable[[DataFrame], DataFrame], keys: list[str], features: list[str], at: str, cutoff, seed: int = 0) -> DataFrame:
    """Features up to the cutoff that change when everything after it is scrambled. (feature, changed_before, changed_after):
    changed_after is the positive control and should not be 0 for features that follow y."""
    noise = F.pmod(F.xxhash64("unique_id", "ds", F.lit(seed)), F.lit(1_000_000)).cast("double")
    scrambled = panel.withColumn("y", F.when(F.col("ds") > cutoff, noise).otherwise(F.col("y")))
    a = rebuild(panel).select(*keys, *[F.col(f).alias(f"a_{f}") for f in features])
    b = rebuild(scrambled).select(*keys, *[F.col(f).alias(f"b_{f}") for f in features])
    both = a.join(b, keys, "full_outer")
    before = F.col(at) <= cutoff
    sums = [F.sum((~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")) & side).cast("long")).alias(f"{f}|{name}") for f in features for name, side in (("before", before), ("after", ~before))]
    row = both.agg(*sums)
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"`{f}|before`").alias("changed_before"), F.col(f"`{f}|after`").alias("changed_after")) for f in features]))
    return row.select(pairs.alias("r")).select("r.*")


def fold_population(rows: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    """One row: rows, rows that aren't horizon_1, and tiers outside or missing from the vocabulary."""
    known = F.array(*map(F.lit, labels))
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("horizon") != "horizon_1").alias("n_other_horizon"),
        F.count_if(~F.array_contains(known, F.col("tier"))).alias("n_unknown_tier"),
        F.size(F.array_except(known, F.collect_set("tier"))).cast("long").alias("n_missing_tier"),
    )


def expected_counts(spine: DataFrame, totals: DataFrame, months: DataFrame) -> DataFrame:
    """One row: how many target months, origins, series and events a result over ``months`` (target_month) must have, from its inputs alone."""
    at = spine.join(F.broadcast(months), "target_month", "left_semi").select("target_month", "forecast_origin_date").distinct()
    active = totals.select("unique_id", F.col("fiscal_year_month").alias("target_month")).join(F.broadcast(months), "target_month", "left_semi").distinct()
    events = at.join(active, "target_month")
    of = lambda df, c, name: df.agg(F.countDistinct(c).alias(name))
    return of(months, "target_month", "target_months").crossJoin(of(at, "forecast_origin_date", "origins")).crossJoin(of(active, "unique_id", "series")).crossJoin(events.agg(F.count("*").alias("events")))


def parity(a: DataFrame, b: DataFrame, keys: list[str], exact: list[str], numeric: list[str], rtol: float = 1e-9) -> DataFrame:
    """Keys that only one side has, or whose exact or numeric columns differ."""
    left, right = a.select(*keys, F.struct(*exact, *numeric).alias("a")), b.select(*keys, F.struct(*exact, *numeric).alias("b"))
    both = left.join(right, keys, "full_outer")
    differs = F.lit(False)
    for c in exact:
        differs = differs | ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    for c in numeric:
        differs = differs | ~F.coalesce(close(F.col(f"a.{c}"), F.col(f"b.{c}"), rtol), F.col(f"a.{c}").isNull() & F.col(f"b.{c}").isNull())
    side = F.when(F.col("a").isNull(), "right_only").when(F.col("b").isNull(), "left_only").when(differs, "differs")
    return both.select(*keys, side.alias("problem")).where("problem IS NOT NULL")


def reconstruction(series: DataFrame, components: DataFrame, keys: list[str]) -> DataFrame:
    """Forecasts that aren't exactly month-to-date plus remainder."""
    c = components.select(*keys, (F.col("mtd_revenue").cast(MONEY) + F.col("predicted_remaining").cast(MONEY)).cast("double").alias("rebuilt"))
    return series.select(*keys, "monthly_forecast").join(c, keys, "full_outer").where(~F.col("monthly_forecast").eqNullSafe(F.col("rebuilt")))


def base_frame_checks(base: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row of counts that should all be 0 but the first: repeated keys, one-sided rows, columns that the sides disagree on, null
    inputs, and origins that the calendar lacks."""
    keys = ["forecast_origin_date", "predicted_fiscal_year_month", "unique_id"]
    known = calendar.select(F.col("ds").alias("forecast_origin_date"), F.lit(True).alias("in_calendar"))
    rows = base.join(F.broadcast(known), "forecast_origin_date", "left").join(unique_keys(base, keys).select(*keys, F.lit(True).alias("repeated")), keys, "left")
    unlike = lambda c: F.count_if(F.array_contains("differs", c))
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("repeated")).alias("n_repeated"),
        F.count_if(F.col("_merge") == "left_only").alias("n_left_only"),
        F.count_if(F.col("_merge") == "right_only").alias("n_right_only"),
        unlike("tier").alias("n_other_tier"),
        unlike("series_weight").alias("n_other_weight"),
        unlike("actual_monthly_total").alias("n_other_actual"),
        F.count_if((F.col("_merge") == "both") & (F.col("w").isNull() | F.col("a").isNull() | F.col("fc").isNull() | F.col("fb").isNull() | F.col("tier").isNull())).alias("n_null_inputs"),
        F.count_if(F.col("in_calendar").isNull()).alias("n_not_in_calendar"),
    )


def schema_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """(column, a, b): columns that one side lacks or whose types differ."""
    x, y = dict(a.dtypes), dict(b.dtypes)
    rows = [(c, x.get(c), y.get(c)) for c in sorted({*x, *y}) if x.get(c) != y.get(c)]
    return a.sparkSession.createDataFrame(rows, "column string, a string, b string")


def calendars_agree(a: DataFrame, b: DataFrame, origins: DataFrame, columns: list[str]) -> DataFrame:
    """Origins where two calendars differ, or that one of them lacks."""
    o = origins.select(F.col("forecast_origin_date").alias("ds")).distinct()
    x, y = a.select("ds", F.struct(*columns).alias("a")), b.select("ds", F.struct(*columns).alias("b"))
    return o.join(x, "ds", "left").join(y, "ds", "left").where(F.col("a").isNull() | F.col("b").isNull() | ~F.col("a").eqNullSafe(F.col("b"))).select("ds")


def tier_prefix(rows: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    """One row: the tiers that occur, in order, and whether they are the first of the labels."""
    present = F.array_intersect(F.array(*map(F.lit, labels)), F.collect_set("tier"))
    made = rows.agg(present.alias("present"), F.countDistinct("tier").alias("n"))
    return made.select("present", (F.col("present") == F.slice(F.array(*map(F.lit, labels)), F.lit(1), F.size("present"))).alias("is_prefix"), (F.size("present") == F.col("n")).alias("all_known"))


def ambiguous_weeks(calendar: DataFrame) -> DataFrame:
    return calendar.groupBy("ds").agg(F.countDistinct("fiscal_year_month").alias("months")).where("months > 1")


def frame_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """(column, rows_compared, rows_different, max_abs_delta) for every column that both have; null equals null."""
    shared = [c for c in a.columns if c in b.columns and c not in keys]
    both = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in shared], F.lit(True).alias("_a")).join(b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in shared], F.lit(True).alias("_b")), keys, "full_outer")
    numeric = {c for c, t in a.dtypes if t in ("double", "float", "int", "bigint") or t.startswith("decimal")}
    aggs = []
    for c in shared:
        x, y = F.col(f"a_{c}"), F.col(f"b_{c}")
        delta = F.max(F.abs(x - y)).cast("double") if c in numeric else F.lit(None).cast("double")
        aggs.append(F.struct(F.lit(c).alias("column"), F.count("*").alias("rows_compared"), F.sum((~x.eqNullSafe(y)).cast("long")).alias("rows_different"), delta.alias("max_abs_delta")))
    return both.agg(F.array(*aggs).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: how many rows each side has that the other lacks, repeats counted."""
    b = b.select(*a.columns)
    return a.exceptAll(b).agg(F.count("*").alias("only_left")).crossJoin(b.exceptAll(a).agg(F.count("*").alias("only_right")))


def report(checks: list[DataFrame]) -> DataFrame:
    """One table of checks, PASS or FAIL; it never raises."""
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out.withColumn("status", F.when(F.col("ok"), "PASS").otherwise("FAIL"))


def mutations_seen(cases: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(gate, mutation, violations) for each case: what a gate finds on a frame with a named defect. One plan over all cases; a gate that
    doesn't see its defect has 0."""
    out = None
    for (gate, mutation), violations in cases.items():
        row = violations.agg(F.count("*").alias("violations")).select(F.lit(gate).alias("gate"), F.lit(mutation).alias("mutation"), "violations")
        out = row if out is None else out.unionByName(row)
    return out


def mean_of_folds(summary: DataFrame, scores: DataFrame) -> DataFrame:
    """Rows of a summary whose value isn't the mean of their folds' defined scores (null if none is defined), and rows that one side lacks."""
    keys = ["model", "horizon", "tier", "metric"]
    means = scores.groupBy(*keys).agg(F.struct((F.sum("value") / F.count("value")).alias("mean")).alias("m"))
    both = summary.select(*keys, F.struct("value").alias("s")).join(means, keys, "full_outer")
    same = F.coalesce(close(F.col("s.value"), F.col("m.mean"), 1e-12, 1e-12), F.col("s.value").isNull() & F.col("m.mean").isNull())
    return both.where(F.col("s").isNull() | F.col("m").isNull() | ~same)


def merge_parts(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two results of one model as one: same columns, and every origin of the first before every one of the second."""
    if set(first.columns) != set(second.columns):
        raise GateError(f"columns differ: {sorted(set(first.columns) ^ set(second.columns))}")
    ends = first.agg(F.max("forecast_origin_date")).first()[0], second.agg(F.min("forecast_origin_date")).first()[0]
    if None not in ends and ends[0] >= ends[1]:
        raise GateError(f"origins overlap: {ends}")
    return first.unionByName(second)


def parameter_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """(key, a, b) of two (key, value) tables where the values differ or one is missing."""
    both = a.select("key", F.col("value").alias("a")).join(b.select("key", F.col("value").alias("b")), "key", "full_outer")
    return both.where(~F.col("a").eqNullSafe(F.col("b")))
