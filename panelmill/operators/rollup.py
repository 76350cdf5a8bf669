"""Monthly forecasts: month-to-date actuals plus the predicted remainder, tiers and weights as of each origin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.operators.origins import horizon_label, months
from panelmill.operators.panel import money, on_calendar
from panelmill.operators.profile import select_ranks

TIERS = ("very_low", "low", "middle", "high", "very_high")
KEYS = ["forecast_origin_date", "unique_id", "predicted_fiscal_year_month"]


def predicted_remaining(forecasts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Forecast weeks summed by month, in money (two decimals, half up)."""
    rows = forecasts.join(F.broadcast(calendar.select("ds", F.col("fiscal_year_month").alias("predicted_fiscal_year_month"))), "ds")
    return rows.groupBy("model", *KEYS).agg(F.sum(F.round("ypred", 2).cast("decimal(18,2)")).alias("predicted_remaining"))


def month_to_date(panel: DataFrame, origins: DataFrame, calendar: DataFrame) -> DataFrame:
    """Actuals of the origin's own month up to the origin, all origins in one plan; at a month's end there are none."""
    weeks = on_calendar(panel, calendar).select("unique_id", "ds", "y", "fiscal_year_month")
    inside = origins.where("fraction < 1").select("forecast_origin_date", "origin_month")
    rows = weeks.join(F.broadcast(inside), (F.col("fiscal_year_month") == F.col("origin_month")) & (F.col("ds") <= F.col("forecast_origin_date")))
    return rows.groupBy("forecast_origin_date", "unique_id", F.col("fiscal_year_month").alias("predicted_fiscal_year_month")).agg(money().alias("mtd_revenue"))


def combine(mtd: DataFrame, remaining: DataFrame) -> DataFrame:
    """mtd + remaining for every key that either side has; sums of decimals, so the forecast is exactly their sum."""
    models = remaining.select("model").distinct()
    known = mtd.crossJoin(F.broadcast(models))
    joined = known.join(remaining, ["model", *KEYS], "full_outer")
    zero = F.lit(0).cast("decimal(18,2)")
    a, b = F.coalesce("mtd_revenue", zero), F.coalesce("predicted_remaining", zero)
    return joined.select("model", *KEYS, a.cast("double").alias("mtd_revenue"), b.cast("double").alias("predicted_remaining"), (a + b).cast("double").alias("monthly_forecast"))


def tiers(history: DataFrame, weeks: int = 52, labels: tuple[str, ...] = TIERS) -> DataFrame:
    """A tier for each series as of each origin: quantile bins, closed on the right, of the mean positive week among the last
    ``weeks`` calendar rows. There are as many bins as distinct means, at most len(labels); a series without a positive week has
    the lowest label."""
    recent = history.where(F.col("week_index") > F.col("origin_week") - weeks)
    positive = F.when(F.col("y") > 0, F.col("y").cast("decimal(18,2)"))
    means = recent.groupBy("forecast_origin_date", "unique_id").agg((F.coalesce(F.sum(positive).cast("double"), F.lit(0.0)) / F.greatest(F.lit(1), F.count(positive))).alias("mean_positive"))
    # Linear interpolation on the sorted means: only the rows on either side of an edge are joined back, nothing is collected.
    up = means.where("mean_positive > 0")
    bins = up.groupBy("forecast_origin_date").agg(F.count("*").alias("n"), F.countDistinct("mean_positive").alias("distinct_means"))
    bins = bins.withColumn("bins", F.least(F.lit(len(labels)), F.col("distinct_means")))
    cuts = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("bins").cast("int") - 1)))
    edges = bins.select("forecast_origin_date", "n", "bins", cuts.alias("i")).select("forecast_origin_date", ((F.col("n") - 1) * F.col("i") / F.col("bins")).alias("p"))
    edges = edges.withColumns({"low": F.floor("p").cast("int"), "high": F.ceil("p").cast("int")})
    wanted = edges.select("forecast_origin_date", F.explode(F.array("low", "high")).alias("k"))
    ranked = select_ranks(up.select("forecast_origin_date", "mean_positive"), ["forecast_origin_date"], "mean_positive", wanted)
    at = lambda k, name: F.broadcast(edges.select("forecast_origin_date", "p", F.col(k).alias("k"))).join(ranked, ["forecast_origin_date", "k"]).select("forecast_origin_date", "p", F.col("mean_positive").alias(name))
    edges = at("low", "a").join(at("high", "b"), ["forecast_origin_date", "p"])
    edges = edges.groupBy("forecast_origin_date").agg(F.collect_list(F.col("a") + (F.col("p") - F.floor("p")) * (F.col("b") - F.col("a"))).alias("edges"))
    joined = means.join(F.broadcast(bins.join(edges, "forecast_origin_date")), "forecast_origin_date", "left")
    above = F.expr("size(filter(edges, e -> mean_positive > e))")
    rank = F.when((F.col("mean_positive") <= 0) | F.coalesce(F.col("bins") < 2, F.lit(True)), 0).otherwise(above).cast("int")
    return joined.select("forecast_origin_date", "unique_id", rank.alias("tier_rank"), F.get(F.array(*map(F.lit, labels)), rank).alias("tier"))


#: What damps a trailing sum into a weight.
DAMPENING = {"cbrt": F.cbrt, "sqrt": F.sqrt, "none": lambda c: c, "log1p": F.log1p}


def weights(history: DataFrame, weeks: int = 26, dampening: str = "cbrt") -> DataFrame:
    """Damped trailing sums, cut off at 0, as of each origin."""
    recent = history.where(F.col("week_index") > F.col("origin_week") - weeks)
    return recent.groupBy("forecast_origin_date", "unique_id").agg(DAMPENING[dampening](F.greatest(money().cast("double"), F.lit(0.0))).alias("series_weight"))


def monthly_series(components: DataFrame, actuals: DataFrame, tier: DataFrame, weight: DataFrame, origins: DataFrame, calendar: DataFrame, last: DataFrame) -> DataFrame:
    """Forecasts of realised months with actual, tier, weight and horizon label."""
    keys = ["forecast_origin_date", "unique_id"]
    index = months(calendar).select(F.col("fiscal_year_month").alias("predicted_fiscal_year_month"), F.col("month_index").alias("predicted_index"))
    realised = actuals.withColumnRenamed("fiscal_year_month", "predicted_fiscal_year_month").join(F.broadcast(last), F.col("predicted_fiscal_year_month") <= F.col("last_month"))
    rows = components.join(realised, ["unique_id", "predicted_fiscal_year_month"]).join(tier, keys).join(weight, keys)
    rows = rows.join(F.broadcast(origins), "forecast_origin_date").join(F.broadcast(index), "predicted_fiscal_year_month")
    return rows.select(
        "model",
        *KEYS,
        "tier",
        "tier_rank",
        "monthly_forecast",
        "actual_monthly_total",
        "series_weight",
        F.col("fraction").alias("origin_month_fraction_elapsed"),
        horizon_label(F.col("predicted_index"), F.col("origin_month_index"), F.col("fraction")).alias("horizon"),
        "mtd_revenue",
    )


def below_mtd(ms: DataFrame) -> DataFrame:
    """For each fold: how many forecasts and actuals lie below what the month already had, and by how much."""
    out = []
    for name, value in (("forecast", F.col("monthly_forecast")), ("actual", F.col("actual_monthly_total"))):
        gap: Column = F.col("mtd_revenue") - value
        out += [F.sum((gap > 0).cast("long")).alias(f"n_{name}_below"), F.avg((gap > 0).cast("double")).alias(f"share_{name}_below"), F.avg(F.when(gap > 0, gap)).alias(f"mean_{name}_gap"), F.max(F.when(gap > 0, gap)).alias(f"max_{name}_gap")]
    return ms.groupBy("model", "forecast_origin_date", "predicted_fiscal_year_month").agg(F.count("*").alias("n"), *out)
