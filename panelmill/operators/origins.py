"""Forecast origins as rows, and what only the calendar decides about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def months(calendar: DataFrame) -> DataFrame:
    return calendar.groupBy("fiscal_year_month", "month_index").agg(
        F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"), F.min("week_index").alias("first_week"), F.max("week_index").alias("last_week"), F.max("weeks_in_month").alias("weeks_in_month")
    )


def last_complete_month(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row: the last fiscal month whose last week is in the panel."""
    end = panel.agg(F.max("ds").alias("end_ds"))
    return months(calendar).crossJoin(F.broadcast(end)).where("last_ds <= end_ds").agg(F.max("fiscal_year_month").alias("last_month"), F.max("month_index").alias("last_index"))


def start_months(calendar: DataFrame, last: DataFrame, n: int, step: int, horizon_months: int) -> DataFrame:
    """The evaluation's start months: the latest leaves ``horizon_months`` complete months, earlier ones are ``step`` apart."""
    latest = F.col("last_index") - (horizon_months - 1)
    at = last.select(F.explode(F.sequence(latest - (n - 1) * step, latest, F.lit(step))).alias("month_index"))
    return months(calendar).join(F.broadcast(at), "month_index").select(F.col("fiscal_year_month").alias("start_month"), "month_index")


def origins_for(starts: DataFrame, calendar: DataFrame, horizon_months: int) -> DataFrame:
    """Origins from the last week of the month before each start to the last but one week of its horizon, each with the
    longest horizon in weeks that any start gives it."""
    m = months(calendar).select("month_index", "last_week")
    before = m.select((F.col("month_index") + 1).alias("month_index"), F.col("last_week").alias("from_week"))
    after = m.select((F.col("month_index") - horizon_months + 1).alias("month_index"), F.col("last_week").alias("to_week"))
    spans = starts.join(before, "month_index").join(after, "month_index")
    each = spans.select("to_week", F.explode(F.sequence("from_week", F.col("to_week") - 1)).alias("week_index"))
    grouped = each.groupBy("week_index").agg(F.max(F.col("to_week") - F.col("week_index")).cast("int").alias("horizon"))
    cal = calendar.select("week_index", "ds", "fiscal_year_month", "month_index", "origin_month_fraction_elapsed")
    return F.broadcast(cal).join(grouped, "week_index").select(
        F.col("ds").alias("forecast_origin_date"),
        F.col("week_index").alias("origin_week"),
        "horizon",
        F.col("fiscal_year_month").alias("origin_month"),
        F.col("month_index").alias("origin_month_index"),
        F.col("origin_month_fraction_elapsed").alias("fraction"),
    )


def horizon_label(predicted_index: Column, origin_index: Column, fraction: Column) -> Column:
    """horizon_1 is the month after the last complete one, which at a month's end is the origin's own."""
    return F.concat(F.lit("horizon_"), (predicted_index - origin_index + F.when(fraction == 1, 0).otherwise(1)).cast("string"))


def fold_ids(origins: DataFrame) -> DataFrame:
    """Origins numbered by date; a repeated origin keeps its first horizon's number, so numbers are unique."""
    return origins.select("forecast_origin_date", "horizon").distinct().withColumn("fold_id", F.row_number().over(Window.orderBy("forecast_origin_date", "horizon")))


def spine(calendar: DataFrame) -> DataFrame:
    """One row for each week as an origin: its target month, weeks actualized and weeks in month. An origin at a month's end
    targets the next month with nothing actualized. The first month and the last week have no such origin."""
    over = Window.orderBy("ds")
    done = F.col("origin_month_fraction_elapsed") == 1
    rows = calendar.select(
        F.when(done, F.lead("fiscal_year_month").over(over)).otherwise(F.col("fiscal_year_month")).alias("target_month"),
        F.col("ds").alias("forecast_origin_date"),
        F.when(done, 0).otherwise(F.col("fiscal_week_of_month")).alias("weeks_actualized"),
        F.when(done, F.lead("weeks_in_month").over(over)).otherwise(F.col("weeks_in_month")).alias("weeks_in_month"),
        F.min("fiscal_year_month").over(Window.partitionBy()).alias("first_month"),
    )
    return rows.where("target_month > first_month").drop("first_month")


def workday_progress(spine: DataFrame, calendar: DataFrame) -> DataFrame:
    """The spine with workdays so far, in all and left in the target month; before its first week there are none."""
    month = Window.partitionBy("fiscal_year_month").orderBy("fiscal_week_of_month").rowsBetween(Window.unboundedPreceding, 0)
    sums = calendar.select(F.col("fiscal_year_month").alias("target_month"), F.col("fiscal_week_of_month").alias("weeks_actualized"), F.sum("count_workdays").over(month).alias("workdays_to_date"))
    total = calendar.groupBy(F.col("fiscal_year_month").alias("target_month")).agg(F.sum("count_workdays").alias("workdays_total"))
    joined = spine.join(F.broadcast(total), "target_month").join(F.broadcast(sums), ["target_month", "weeks_actualized"], "left")
    done = F.coalesce("workdays_to_date", F.lit(0))
    return joined.withColumns({"workdays_to_date": done, "workdays_remaining": F.col("workdays_total") - done})


def trailing_weeks(calendar: DataFrame, origins: DataFrame, n: int) -> DataFrame:
    """The last ``n`` calendar rows up to each origin."""
    return origins.select("forecast_origin_date", "origin_week").join(F.broadcast(calendar.select("ds", "week_index")), F.col("week_index").between(F.col("origin_week") - n + 1, F.col("origin_week"))).select("forecast_origin_date", "ds")


def future_weeks(calendar: DataFrame, after: DataFrame, n: int) -> DataFrame:
    """The first ``n`` calendar rows after the date of a one-row table (last_ds)."""
    rows = calendar.select("ds", "week_index").crossJoin(F.broadcast(after))
    return rows.where("ds > last_ds").withColumn("step", F.row_number().over(Window.orderBy("ds"))).where(F.col("step") <= n).select("ds", "step")


def fixed_step_folds(days: DataFrame, horizon: int, step: int, windows: int, test_days: int) -> DataFrame:
    """(part, fold, train_end, validation_end, n_train, n_validation): rolling-origin folds of ``horizon`` days, ``step`` apart, fold 0 the
    latest, before a hold-out test set of the last ``test_days`` days, which is the fold -1. ``days`` (day) are the observations."""
    last = days.agg(F.max("day").alias("m"))
    fold = last.select("m", F.lit("validation").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(windows - 1))).alias("fold"))
    back = F.lit(test_days) + F.lit(step) * F.col("fold")
    folds = fold.select("part", "fold", F.date_sub("m", (back + horizon).cast("int")).alias("train_end"), F.date_sub("m", back.cast("int")).alias("validation_end"))
    folds = folds.unionByName(last.select(F.lit("test").alias("part"), F.lit(-1).alias("fold"), F.date_sub("m", test_days).alias("train_end"), F.col("m").alias("validation_end")))
    counted = days.groupBy("day").agg(F.count("*").alias("n"))
    # one row a day meets one row a fold
    rows = counted.join(F.broadcast(folds), F.col("day") <= F.col("validation_end"))
    keys = ["part", "fold", "train_end", "validation_end"]
    sums = [F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)) for c in (F.col("day") <= F.col("train_end"), F.col("day") > F.col("train_end"))]
    return rows.groupBy(*keys).agg(sums[0].alias("n_train"), sums[1].alias("n_validation"))
