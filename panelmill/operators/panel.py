"""The weekly panel, its monthly totals and completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelmill.functions.calendar import week_start

MONEY = "decimal(18,2)"


def money(column: str = "y"):
    """Sums of money are sums of decimals: their order doesn't matter."""
    return F.sum(F.col(column).cast(MONEY))


def weekly_sums(facts: DataFrame) -> DataFrame:
    """Facts (unique_id, day, amount) summed by Sunday week: (unique_id, ds, y)."""
    return facts.groupBy("unique_id", week_start(F.col("day")).alias("ds")).agg(F.sum("amount").cast("double").alias("y"))


def weekly_panel(facts: DataFrame) -> DataFrame:
    """Weekly sums with a row for every week from each series' first one to the panel's last; every fact is in one of them."""
    sums = weekly_sums(facts)
    spans = sums.groupBy("unique_id").agg(F.min("ds").alias("first_ds"))
    last = sums.agg(F.max("ds").alias("last_ds"))
    grid = spans.crossJoin(F.broadcast(last)).select("unique_id", F.explode(F.sequence("first_ds", "last_ds", F.expr("interval 7 days"))).alias("ds"))
    return grid.join(sums, ["unique_id", "ds"], "left").select("unique_id", "ds", F.coalesce("y", F.lit(0.0)).alias("y"))


def on_calendar(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """The panel with its calendar columns. Weeks that the calendar lacks go, and a week it has twice doubles: gates.uncovered_weeks and
    gates.unique_keys find such calendars, and the study enforces both."""
    return panel.join(F.broadcast(calendar), "ds")


def monthly_totals(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """Realised totals; weeks outside the calendar don't count."""
    return on_calendar(panel, calendar).groupBy("unique_id", "fiscal_year_month").agg(money().cast("double").alias("actual_monthly_total"))


def trim_incomplete(panel: DataFrame, calendar: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of (series, month) pairs with each fiscal week exactly once, and the dropped pairs with what they had."""
    joined = on_calendar(panel, calendar)
    pair = Window.partitionBy("unique_id", "fiscal_year_month")
    marked = joined.withColumns({"present": F.size(F.collect_set("fiscal_week_of_month").over(pair)), "rows": F.count("*").over(pair)})
    whole = (F.col("present") == F.col("weeks_in_month")) & (F.col("rows") == F.col("weeks_in_month"))
    dropped = marked.where(~whole).groupBy("unique_id", "fiscal_year_month").agg(F.max("present").alias("present"), F.max("weeks_in_month").alias("expected"))
    return marked.where(whole).drop("present", "rows"), dropped


def reindexed(snapshot: DataFrame, calendar: DataFrame) -> DataFrame:
    """Each series on every calendar week from its first value to the panel's end; absent weeks are null."""
    spans = snapshot.where("y IS NOT NULL").groupBy("unique_id").agg(F.min("ds").alias("first_ds"))
    last = snapshot.agg(F.max("ds").alias("last_ds"))
    weeks = calendar.select("ds").crossJoin(F.broadcast(last)).where("ds <= last_ds").select("ds")
    grid = spans.join(F.broadcast(weeks), F.col("ds") >= F.col("first_ds")).select("unique_id", "ds")
    return grid.join(snapshot, ["unique_id", "ds"], "left")
