"""Error metrics at fold, period and summary grain.

A fold is (forecast_origin_date, predicted_fiscal_year_month). Undefined values are null, never NaN or 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.operators.features import progress
from panelmill.operators.monitor import tiers_held

FOLD = ["forecast_origin_date", "predicted_fiscal_year_month"]
KEYS = [*FOLD, "unique_id"]
NEAR_ZERO = 1e-12


def ratio(n: Column, d: Column) -> Column:
    """n / d where d isn't next to zero, else null."""
    return F.when(d > NEAR_ZERO, n / d)


AGREED = {"tier": "tier", "series_weight": "w", "actual_monthly_total": "a"}


def base_frame(challenger: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Challenger and benchmark side by side, with ``_merge`` saying which side has the key; fc, fb: forecasts, a: actual, w: weight.

    ``differs`` lists the columns (tier, weight, actual) that both sides compute and that disagree; two nulls agree."""
    c = challenger.select(*KEYS, "horizon", "tier", "tier_rank", F.col("series_weight").alias("w"), F.col("actual_monthly_total").alias("a"), F.col("monthly_forecast").alias("fc"), "origin_month_fraction_elapsed", F.lit(True).alias("in_c"))
    b = benchmark.select(*KEYS, F.col("monthly_forecast").alias("fb"), F.struct(*AGREED).alias("other"), F.lit(True).alias("in_b"))
    side = F.when(F.col("in_c").isNull(), "right_only").when(F.col("in_b").isNull(), "left_only").otherwise("both")
    both = c.join(b, KEYS, "full_outer").withColumn("_merge", side)
    unlike = [F.when((F.col("_merge") == "both") & ~F.col(mine).eqNullSafe(F.col(f"other.{name}")), F.lit(name)) for name, mine in AGREED.items()]
    return both.withColumn("differs", F.array_compact(F.array(*unlike))).drop("in_c", "in_b", "other")


def sums() -> dict[str, Column]:
    """All sums that the fold metrics need, in one aggregate."""
    w, a = F.col("w"), F.col("a")
    ec, eb = F.abs(F.col("fc") - a), F.abs(F.col("fb") - a)
    counts = (eb > NEAR_ZERO) & (w > NEAR_ZERO)
    signed = (F.abs(a) > NEAR_ZERO) & (w > NEAR_ZERO)
    return {
        "w_ec": F.sum(w * ec),
        "w_eb": F.sum(w * eb),
        "w_sum": F.sum(w),
        "ps_num": F.sum(F.when(counts, w * F.try_divide(ec, eb))),
        "ps_den": F.sum(F.when(counts, w)),
        "wb_num": F.sum(w * (F.col("fc") - a)),
        "wb_den": F.sum(w * F.abs(a)),
        "sb_num": F.sum(F.when(signed, w * F.try_divide(F.col("fc") - a, F.abs(a)))),
        "sb_den": F.sum(F.when(signed, w)),
        "ae": F.sum(ec),
        "se": F.sum(F.col("fc") - a),
        "aa": F.sum(F.abs(a)),
        "n_obs": F.count("*"),
    }


def metric_columns() -> dict[str, Column]:
    r = lambda n, d: ratio(F.col(n), F.col(d))
    return {
        "weighted_mae": r("w_ec", "w_sum"),
        "wrmae_pooled": r("w_ec", "w_eb"),
        "wrmae_per_series": r("ps_num", "ps_den"),
        "signed_bias_pooled": r("wb_num", "wb_den"),
        "signed_bias_per_series": r("sb_num", "sb_den"),
        "wape": r("ae", "aa"),
        "weighted_signed_bias": r("se", "aa"),
    }


SCORED = ["wrmae_pooled", "wrmae_per_series", "signed_bias_pooled", "signed_bias_per_series", "wape", "weighted_signed_bias"]


def fold_values(base: DataFrame, by: list[str]) -> DataFrame:
    """Every metric of every fold and group."""
    made = base.groupBy(*by, *FOLD).agg(*[c.alias(n) for n, c in sums().items()])
    return made.select(*by, *FOLD, *[c.alias(n) for n, c in metric_columns().items()], "n_obs")


def overall(base: DataFrame, metric: str, by: list[str] | None = None) -> DataFrame:
    """The mean over folds of one metric; folds where it is undefined don't count."""
    return fold_values(base, by or []).groupBy(*(by or [])).agg(F.avg(metric).alias("value"), F.count(metric).alias("n_folds"))


def both_models(base: DataFrame, challenger: str, benchmark: str) -> DataFrame:
    """The base frame once for each model: the benchmark is scored against itself; a model in both roles is scored once."""
    rows = base.withColumn("model", F.lit(challenger))
    if challenger != benchmark:
        rows = rows.unionByName(base.withColumn("fc", F.col("fb")).withColumn("model", F.lit(benchmark)))
    return rows


def fold_scores(rows: DataFrame) -> DataFrame:
    """(model, horizon, tier, fold..., metric, value, n_obs) for each tier and for ``global``.

    One aggregate over grouping sets replaces the loops over tiers, folds and metrics; a left join from folds x present tiers
    brings back slices without rows (value null, n_obs 0).
    """
    keys = ["model", "horizon", *FOLD]
    grouped = rows.groupingSets([[*map(F.col, keys), F.col("tier")], [*map(F.col, keys)]], *keys, "tier").agg(F.grouping("tier").alias("is_global"), *[c.alias(n) for n, c in sums().items()])
    made = grouped.select(*keys, F.when(F.col("is_global") == 1, "global").otherwise(F.col("tier")).alias("tier"), *[metric_columns()[m].alias(m) for m in SCORED], "n_obs")
    present = rows.select("tier").distinct().union(rows.sparkSession.createDataFrame([("global",)], "tier string"))
    slices = rows.select(*keys).distinct().crossJoin(F.broadcast(present))
    full = slices.join(made, [*keys, "tier"], "left").withColumn("n_obs", F.coalesce("n_obs", F.lit(0)))
    return full.unpivot([*keys, "tier", "n_obs"], SCORED, "metric", "value").select(*keys, "tier", "metric", "value", "n_obs")


def derived(scores: DataFrame, keys: list[str]) -> DataFrame:
    """Coarser scores: the mean of the fold values, never of coarser ones."""
    return scores.groupBy(*keys, "metric").agg(F.avg("value").alias("value"), F.sum("n_obs").alias("n_obs"), F.count("value").alias("n_folds"))


def period_scores(scores: DataFrame) -> DataFrame:
    return derived(scores, ["model", "horizon", "tier", "predicted_fiscal_year_month"])


def summary_scores(scores: DataFrame) -> DataFrame:
    return derived(scores, ["model", "horizon", "tier"])


def shares(base: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Each series' part in the benchmark's (x) and the challenger's (y) pooled error: x sums to 1, y to the pooled WRMAE."""
    by = by or []
    w_ec, w_eb = F.col("w") * F.abs(F.col("fc") - F.col("a")), F.col("w") * F.abs(F.col("fb") - F.col("a"))
    rows = base.select(*by, *KEYS, w_ec.alias("c"), w_eb.alias("b"))
    folds = rows.groupBy(*by, *FOLD).agg(F.sum("b").alias("total")).where(F.col("total") > NEAR_ZERO)
    n = folds.groupBy(*by).agg(F.count("*").alias("folds"))
    joined = rows.join(folds, [*by, *FOLD])
    made = joined.groupBy(*by, "unique_id").agg(F.sum(F.col("b") / F.col("total")).alias("x"), F.sum(F.col("c") / F.col("total")).alias("y"))
    made = made.join(F.broadcast(n), by) if by else made.crossJoin(F.broadcast(n))
    all_series = base.select(*by, "unique_id").distinct()
    return all_series.join(made, [*by, "unique_id"], "left").select(*by, "unique_id", *[F.coalesce(F.col(c) / F.col("folds"), F.lit(0.0)).alias(c) for c in "xy"])


def horizon_shares(base: DataFrame) -> DataFrame:
    """The shares of each horizon with their net effect y - x, the tier at the series' last origin, and a label of its other tiers."""
    held = tiers_held(base, ["horizon"]).select("horizon", "unique_id", F.col("last_tier").alias("tier"), F.col("held").alias("label"))
    return shares(base, ["horizon"]).withColumn("net", F.col("y") - F.col("x")).join(held, ["horizon", "unique_id"], "left")


GRAINS = {"summary": [], "period": ["predicted_fiscal_year_month"], "fold": FOLD}


def against_benchmark(series: DataFrame, benchmark: str) -> DataFrame:
    """Every model of ``series`` (the benchmark too) beside the benchmark's forecasts: the rows of a leaderboard."""
    b = series.where(F.col("model") == benchmark).select(*KEYS, F.col("monthly_forecast").alias("fb"))
    rows = series.select("model", *KEYS, "horizon", "tier", "tier_rank", F.col("series_weight").alias("w"), F.col("actual_monthly_total").alias("a"), F.col("monthly_forecast").alias("fc"))
    return rows.join(b, KEYS)


def leaderboard(series: DataFrame, benchmark: str) -> DataFrame:
    """(grain, model, horizon, tier, period, origin, metric, value, n_folds) of all models, for each tier and ``global``: the fold scores
    and their means over the folds of each period and of all."""
    scores = fold_scores(against_benchmark(series, benchmark))
    out = None
    for grain, keys in GRAINS.items():
        made = scores.groupBy("model", "horizon", "tier", "metric", *keys).agg(F.avg("value").alias("value"), F.count("value").alias("n_folds"))
        at = lambda c, kind: (F.col(c) if c in keys else F.lit(None)).cast(kind)  # noqa: B023, E731
        row = made.select(F.lit(grain).alias("grain"), "model", "horizon", "tier", at("predicted_fiscal_year_month", "int").alias("period"), at("forecast_origin_date", "date").alias("origin"), "metric", "value", "n_folds")
        out = row if out is None else out.unionByName(row)
    return out


def by_progress(base: DataFrame, spine: DataFrame) -> DataFrame:
    """Pooled WRMAE by how much of the month was known: (weeks_in_month, weeks_actualized). Folds that the spine lacks, or has twice, are an
    error: none is left out without a word. The spine has a row for each origin and one month, so later months are left out by name."""
    at = spine.select("forecast_origin_date", F.col("target_month").alias("predicted_fiscal_year_month"), "weeks_in_month", "weeks_actualized")
    nearest = base.join(F.broadcast(base.groupBy("forecast_origin_date").agg(F.min("predicted_fiscal_year_month").alias("predicted_fiscal_year_month"))), FOLD, "left_semi")
    rows = progress(nearest, at)
    by = ["weeks_in_month", "weeks_actualized"]
    return fold_values(rows, by).groupBy(*by).agg(F.avg("wrmae_pooled").alias("value"), F.sum("n_obs").alias("n_events"))


#: Headline metrics by name.
HERO = {"wrmae_pooled": "wrmae_pooled", "wrmae_per_series": "wrmae_per_series", "wape": "wape"}


def hero(base: DataFrame, metric: str, horizon: str) -> DataFrame:
    """One row: the named metric over one horizon. Unknown names are an error; a missing benchmark is, where it is needed."""
    if metric not in HERO:
        raise ValueError(f"unknown metric {metric!r}; one of {sorted(HERO)}")
    if metric != "wape" and "fb" not in base.columns:
        raise ValueError(f"{metric} needs a benchmark")
    return overall(base.where(F.col("horizon") == horizon), HERO[metric]).withColumn("metric", F.lit(metric))


def headline(summary: DataFrame, model: str, horizons: list[str], metric: str = "wrmae_pooled") -> DataFrame:
    """One row with a column for each horizon."""
    rows = summary.where((F.col("tier") == "global") & (F.col("model") == model) & (F.col("metric") == metric))
    return rows.groupBy("model").pivot("horizon", horizons).agg(F.first("value"))


def series_errors(base: DataFrame) -> DataFrame:
    """Relative absolute error and signed relative bias of each series and fold; null where the denominator is 0."""
    a = F.col("a")
    return base.select(*KEYS, "tier", F.try_divide(F.abs(F.col("fc") - a), F.abs(F.col("fb") - a)).alias("relative_mae"), F.try_divide(F.col("fc") - a, F.abs(a)).alias("relative_bias"))
