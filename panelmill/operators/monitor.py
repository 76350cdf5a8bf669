"""The tables behind monitoring views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelmill.operators.panel import MONEY, on_calendar

FOLD = ["forecast_origin_date", "predicted_fiscal_year_month"]


def _money(c: str):
    return F.sum(F.col(c).cast(MONEY)).cast("double")


def monthly_status(weekly: DataFrame, calendar: DataFrame) -> DataFrame:
    """complete, incomplete (weeks absent) or gapped (weeks without value) for each series and month; a total only if complete."""
    rows = on_calendar(weekly, calendar).groupBy("unique_id", "fiscal_year_month").agg(F.count("*").alias("weeks"), F.count("y").alias("valued"), F.max("weeks_in_month").alias("expected"), _money("y").alias("total"))
    status = F.when(F.col("valued") < F.col("weeks"), "gapped").when(F.col("weeks") < F.col("expected"), "incomplete").otherwise("complete")
    return rows.select("unique_id", "fiscal_year_month", status.alias("status"), F.when(status == "complete", F.col("total")).alias("total"))


def fold_members(comparison: DataFrame) -> DataFrame:
    return comparison.select("forecast_origin_date", "unique_id").distinct()


def member_runs(members: DataFrame) -> DataFrame:
    """(unique_id, first, last): the runs of consecutive origins, by their number, at which a series is a member. As members hardly change
    from one origin to the next, that is about a row a series."""
    rows = members.select("forecast_origin_date", "unique_id").distinct().join(F.broadcast(numbered(members)), "forecast_origin_date")
    island = F.col("at") - F.row_number().over(Window.partitionBy("unique_id").orderBy("at"))
    return rows.withColumn("island", island).groupBy("unique_id", "island").agg(F.min("at").alias("first"), F.max("at").alias("last")).drop("island")


def numbered(members: DataFrame) -> DataFrame:
    """(forecast_origin_date, at): the origins numbered from 0, a row a week."""
    return members.select("forecast_origin_date").distinct().withColumn("at", F.row_number().over(Window.orderBy("forecast_origin_date")) - 1)


def _over_members(rows: DataFrame, period: str, members: DataFrame, **sums: Column) -> DataFrame:
    """(forecast_origin_date, period, ...): sums over the members of each origin, for each period that one of them has. Each run of origins
    adds a series' rows where it begins and takes them away behind its end; running sums over the origins give every origin's, so series
    by origins by periods are never made."""
    runs = rows.select("unique_id", period, *[c.alias(n) for n, c in sums.items()]).join(member_runs(members), "unique_id")
    sign = F.explode(F.array(F.struct(F.col("first").alias("at"), F.lit(1).alias("sign")), F.struct((F.col("last") + 1).alias("at"), F.lit(-1).alias("sign")))).alias("edge")
    edges = runs.select(period, *sums, sign)
    changes = edges.groupBy(period, F.col("edge.at").alias("at")).agg(F.sum(F.col("edge.sign").cast("long")).alias("members"), *[F.sum(F.col(n) * F.col("edge.sign")).alias(n) for n in sums])
    grid = changes.select(period).distinct().crossJoin(F.broadcast(numbered(members)))
    run = Window.partitionBy(period).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    made = grid.join(changes, [period, "at"], "left").select("forecast_origin_date", period, *[F.coalesce(F.sum(n).over(run), F.lit(0)).alias(n) for n in ("members", *sums)])
    return made.where("members > 0")


def global_monthly(monthly: DataFrame, members: DataFrame) -> DataFrame:
    """(forecast_origin_date, fiscal_year_month, status, total): the complete months of each origin's members summed; gapped if a member's
    month is, incomplete if no member has it whole."""
    is_ = lambda s: (F.col("status") == s).cast("long")
    made = _over_members(monthly, "fiscal_year_month", members, total=F.coalesce(F.col("total"), F.lit(0.0)).cast(MONEY), gapped=is_("gapped"), whole=is_("complete"))
    status = F.when(F.col("gapped") > 0, "gapped").when(F.col("whole") > 0, "complete").otherwise("incomplete")
    return made.select("forecast_origin_date", "fiscal_year_month", status.alias("status"), F.when(status == "complete", F.col("total").cast("double")).alias("total"))


def forecast_points(comparison: DataFrame, calendar: DataFrame) -> DataFrame:
    """Forecasts summed over members, at the month's last week."""
    last = calendar.groupBy(F.col("fiscal_year_month").alias("predicted_fiscal_year_month")).agg(F.max("ds").alias("ds"))
    rows = comparison.groupBy(*FOLD, "horizon").agg(_money("fc").alias("challenger"), _money("fb").alias("benchmark"), _money("a").alias("actual"))
    return rows.join(F.broadcast(last), "predicted_fiscal_year_month")


def weekly_sum(weekly: DataFrame, members: DataFrame) -> DataFrame:
    """(forecast_origin_date, ds, y): the sum of each origin's members for each week, null if one of them has no value."""
    made = _over_members(weekly, "ds", members, y=F.coalesce(F.col("y"), F.lit(0.0)).cast(MONEY), absent=F.col("y").isNull().cast("long"))
    return made.select("forecast_origin_date", "ds", F.when(F.col("absent") == 0, F.col("y").cast("double")).alias("y"))


def weekly_forecast(forecasts: DataFrame, comparison: DataFrame) -> DataFrame:
    """Forecast weeks summed over the origin's members, with the horizon of the month they lie in."""
    own = forecasts.join(fold_members(comparison), ["forecast_origin_date", "unique_id"], "left_semi")
    rows = own.groupBy("model", "forecast_origin_date", "ds", "predicted_fiscal_year_month").agg(F.round(F.sum(F.round("ypred", 2).cast(MONEY)), 2).cast("double").alias("ypred"))
    return rows.join(F.broadcast(comparison.select(*FOLD, "horizon").distinct()), FOLD)


def month_changes(forecast: DataFrame) -> DataFrame:
    """Where consecutive forecast weeks change months, with the date half way."""
    w = Window.partitionBy("model", "forecast_origin_date").orderBy("ds")
    rows = forecast.withColumns({"before": F.lag("ds").over(w), "month_before": F.lag("predicted_fiscal_year_month").over(w)})
    return rows.where("month_before <> predicted_fiscal_year_month").select("model", "forecast_origin_date", "before", "ds", F.date_add("before", F.floor(F.datediff("ds", "before") / 2).cast("int")).alias("midpoint"))


def facets(weekly: DataFrame, monthly: DataFrame, comparison: DataFrame, forecasts: DataFrame, calendar: DataFrame) -> DataFrame:
    """The lines of all facets: (facet, forecast_origin_date, grain, line, ds, fiscal_year_month, horizon, y).

    A facet is a series or ``global``, the sum of the origin's members. Lines: ``actual``, and a forecast for each model: monthly ones stand
    at their month's last week. A series' actuals are the same from every origin and have none (null); ``facet`` puts them together.
    ``forecasts`` has model, forecast_origin_date, unique_id, ds, ypred; only folds of the comparison are drawn."""
    ends = F.broadcast(calendar.groupBy("fiscal_year_month").agg(F.max("ds").alias("ds")))
    months = F.broadcast(calendar.select("ds", "fiscal_year_month"))
    members = fold_members(comparison)
    none = F.lit(None)

    def lines(rows: DataFrame, grain: str, facet: Column, origin: Column, line: Column, horizon: Column, y: str) -> DataFrame:
        dated = rows.join(ends, "fiscal_year_month") if grain == "month" else rows.join(months, "ds")
        return dated.select(facet.alias("facet"), origin.cast("date").alias("forecast_origin_date"), F.lit(grain).alias("grain"), line.alias("line"), "ds", "fiscal_year_month", horizon.cast("string").alias("horizon"), F.col(y).alias("y"))

    own, origin, actual, every = F.col("unique_id").cast("string"), F.col("forecast_origin_date"), F.lit("actual"), F.lit("global")
    out = lines(weekly, "week", own, none, actual, none, "y").unionByName(lines(monthly, "month", own, none, actual, none, "total"))
    out = out.unionByName(lines(weekly_sum(weekly, members), "week", every, origin, actual, none, "y")).unionByName(lines(global_monthly(monthly, members), "month", every, origin, actual, none, "total"))
    points = comparison.select(*FOLD, "unique_id", "horizon", F.explode(F.map_from_arrays(F.array(F.lit("challenger"), F.lit("benchmark")), F.array("fc", "fb"))).alias("line", "y")).withColumnRenamed("predicted_fiscal_year_month", "fiscal_year_month")
    summed = points.groupBy("forecast_origin_date", "fiscal_year_month", "horizon", "line").agg(_money("y").alias("y"))
    out = out.unionByName(lines(points, "month", own, origin, F.col("line"), F.col("horizon"), "y")).unionByName(lines(summed, "month", every, origin, F.col("line"), F.col("horizon"), "y"))
    folds = comparison.select(*FOLD, "unique_id", "horizon").withColumnRenamed("predicted_fiscal_year_month", "fiscal_year_month")
    ahead = forecasts.join(months, "ds").join(folds, ["forecast_origin_date", "fiscal_year_month", "unique_id"]).select("model", "forecast_origin_date", "unique_id", "ds", "horizon", F.round("ypred", 2).alias("y"))
    total = ahead.groupBy("model", "forecast_origin_date", "ds", "horizon").agg(_money("y").alias("y"))
    return out.unionByName(lines(ahead, "week", own, origin, F.col("model"), F.col("horizon"), "y")).unionByName(lines(total, "week", every, origin, F.col("model"), F.col("horizon"), "y"))


def facet(lines: DataFrame, name: str, origin: Column, grain: str) -> DataFrame:
    """One facet from one origin at one grain. A series without a fold at the origin has its history and no forecast."""
    own = (F.col("facet") == name) & (F.col("grain") == grain)
    return lines.where(own & (F.col("forecast_origin_date").isNull() | (F.col("forecast_origin_date") == origin)))


def scorecard(summary: DataFrame, metric: str, horizons: list[str]) -> DataFrame:
    """A row for each model and tier, a value and count column for each horizon."""
    rows = summary.where(F.col("metric") == metric)
    return rows.groupBy("model", "tier").pivot("horizon", horizons).agg(F.first("value").alias("value"), F.first("n_obs").alias("n_obs"))


def skill_by_origin(scores: DataFrame, metric: str) -> DataFrame:
    rows = scores.where((F.col("metric") == metric) & (F.col("tier") == "global"))
    return rows.groupBy("model", "horizon", "forecast_origin_date").agg(F.avg("value").alias("value"), F.count("value").alias("n_folds"))


def cohorts(scores: DataFrame, calendar: DataFrame) -> DataFrame:
    """Fold scores with their origin's cohort (weeks in month, weeks elapsed): all horizons of an origin share it."""
    at = calendar.select(F.col("ds").alias("forecast_origin_date"), "weeks_in_month", F.col("fiscal_week_of_month").alias("weeks_elapsed"))
    return scores.join(F.broadcast(at), "forecast_origin_date", "left")


def cohort_means(scores: DataFrame, calendar: DataFrame) -> DataFrame:
    return cohorts(scores, calendar).groupBy("model", "horizon", "tier", "metric", "weeks_in_month", "weeks_elapsed").agg(F.avg("value").alias("value"), F.count("value").alias("n_defined"), F.count("*").alias("n_folds"))


def fold_coverage(scores: DataFrame) -> DataFrame:
    return scores.groupBy("horizon").agg(F.countDistinct(*FOLD).alias("n_folds"), F.countDistinct("forecast_origin_date").alias("n_origins"))


def tiers_held(ms: DataFrame, by: list[str] | None = None) -> DataFrame:
    """For each series (and ``by``): the tier at its last origin of all, and in how many folds it had which others, as a sentence."""
    by = by or []
    last = ms.groupBy("unique_id").agg(F.max_by("tier", F.struct("forecast_origin_date", "predicted_fiscal_year_month")).alias("last_tier"))
    counted = ms.groupBy(*by, "unique_id", "tier", "tier_rank").agg(F.count("*").alias("n"))
    listed = counted.groupBy(*by, "unique_id").agg(F.array_sort(F.collect_list(F.struct("tier_rank", "tier", "n"))).alias("t"), F.sum("n").alias("folds"))
    others = F.expr("concat_ws('; ', transform(filter(t, x -> x.tier <> last_tier), x -> concat(x.tier, ' in ', x.n, ' of ', folds, ' folds')))")
    held = F.when(others == "", F.col("last_tier")).otherwise(F.concat(F.col("last_tier"), F.lit(" at last origin ("), others, F.lit(")")))
    return listed.join(last, "unique_id").select(*by, "unique_id", "last_tier", held.alias("held"))
