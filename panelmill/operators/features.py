"""The modelling table: lags, cumulative features and the series x origin grid."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelmill.operators import gates
from panelmill.operators.panel import MONEY, on_calendar


def weekly_features(panel: DataFrame, lags: list[int], rolling: dict[int, int] | None = None) -> DataFrame:
    """lag{k} of each series, and means of a lag over full windows of rows; the panel has no gaps."""
    w = Window.partitionBy("unique_id").orderBy("ds")
    out = panel.withColumns({f"lag{k}": F.lag("y", k).over(w) for k in lags})
    for k, n in (rolling or {}).items():
        window = w.rowsBetween(-(n - 1), 0)
        exact = F.sum(F.col(f"lag{k}").cast(MONEY)).over(window).cast("double") / n
        out = out.withColumn(f"rolling_mean_lag{k}_window_size{n}", F.when(F.count(f"lag{k}").over(window) == n, exact))
    return out


def origin_series_grid(spine: DataFrame, totals: DataFrame, pairs: DataFrame) -> DataFrame:
    """Every origin with every series that has its target month complete: a fan-out on the month."""
    active = totals.join(pairs, ["unique_id", "fiscal_year_month"], "left_semi").withColumnRenamed("fiscal_year_month", "target_month")
    return active.join(F.broadcast(spine), "target_month")


def mtd_by_week(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """Revenue of each month up to each week, and a zero row before the first."""
    weeks = on_calendar(panel, calendar)
    month = Window.partitionBy("unique_id", "fiscal_year_month").orderBy("fiscal_week_of_month").rowsBetween(Window.unboundedPreceding, 0)
    sums = weeks.select("unique_id", F.col("fiscal_year_month").alias("target_month"), F.col("fiscal_week_of_month").alias("weeks_actualized"), F.sum(F.col("y").cast(MONEY)).over(month).cast("double").alias("mtd_revenue"))
    zeros = sums.select("unique_id", "target_month").distinct().select("unique_id", "target_month", F.lit(0).alias("weeks_actualized"), F.lit(0.0).alias("mtd_revenue"))
    return sums.unionByName(zeros)


def attach_mtd(grid: DataFrame, panel: DataFrame, calendar: DataFrame) -> DataFrame:
    return grid.join(mtd_by_week(panel, calendar), ["unique_id", "target_month", "weeks_actualized"])


def attach_weekly_features(table: DataFrame, features: DataFrame) -> DataFrame:
    """What was known at each origin: features of the week after it, whose lag 1 is the origin's own week."""
    shifted = features.drop("y").withColumn("forecast_origin_date", F.date_sub("ds", 7)).drop("ds")
    return table.join(shifted, ["unique_id", "forecast_origin_date"])


def attach_last_month(table: DataFrame, totals: DataFrame, calendar: DataFrame) -> DataFrame:
    """The total of the month before the target month, by month order and not by arithmetic on YYYYMM."""
    order = calendar.select("fiscal_year_month").distinct().select(F.col("fiscal_year_month").alias("target_month"), F.lag("fiscal_year_month").over(Window.orderBy("fiscal_year_month")).alias("previous_month"))
    before = totals.select("unique_id", F.col("fiscal_year_month").alias("previous_month"), F.col("actual_monthly_total").alias("last_completed_month_revenue"))
    return table.join(F.broadcast(order), "target_month").join(before, ["unique_id", "previous_month"], "left")


@dataclass(frozen=True)
class ColumnRoles:
    """Names of a table's columns by role; roles share no column."""

    keys: tuple[str, ...]
    features: tuple[str, ...]
    target: str
    passthrough: tuple[str, ...] = ()
    progress: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        names = self.columns
        if len(set(names)) != len(names):
            raise ValueError(f"columns in more than one role: {sorted({n for n in names if names.count(n) > 1})}")

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.keys, *self.progress, *self.features, *self.passthrough, self.target)

    def select(self, df: DataFrame) -> DataFrame:
        return df.select(*self.columns)

    def select_features(self, df: DataFrame) -> DataFrame:
        return df.select(*self.features)

    def validate(self, df: DataFrame) -> None:
        if len(set(df.columns)) != len(df.columns):
            raise ValueError("repeated columns")
        if tuple(df.columns) != self.columns:
            raise ValueError(f"columns {df.columns} are not {list(self.columns)}")


def remaining_target(table: DataFrame) -> DataFrame:
    """The framing that predicts what is left of the month."""
    return table.withColumn("remaining_target", (F.col("actual_monthly_total").cast(MONEY) - F.col("mtd_revenue").cast(MONEY)).cast("double"))


def exogenous(panel: DataFrame, calendar: DataFrame, additional: DataFrame, features: list[str]) -> DataFrame:
    """Additional regressors with calendar columns: (unique_id, ds, features...) for history and future weeks. A repeated calendar date or
    key, and a panel row without regressors, are errors."""
    extra = [c for c in calendar.columns if c not in additional.columns]
    gates.enforce(gates.unique_keys(calendar, ["ds"]), "calendar dates")
    gates.enforce(gates.unique_keys(additional, ["unique_id", "ds"]), "regressor keys")
    gates.enforce(gates.unmatched(panel, additional, ["unique_id", "ds"]), "panel rows without regressors")
    return additional.join(F.broadcast(calendar.select("ds", *extra)), "ds", "left").select("unique_id", "ds", *features)


def progress(rows: DataFrame, spine: DataFrame) -> DataFrame:
    """Fold rows with weeks_in_month and weeks_actualized of their origin and month. A row that the spine lacks is an error, as is an
    origin and month that it has twice."""
    keys = ["forecast_origin_date", "predicted_fiscal_year_month"]
    gates.enforce(gates.unique_keys(spine, keys), "spine keys")
    gates.enforce(gates.unmatched(rows.select(*keys).distinct(), spine, keys), "folds that the spine lacks")
    return rows.join(F.broadcast(spine), keys)


def additional_exogenous(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """Holidays and yearly harmonics for each series and each calendar week from its first one on."""
    angle = 2 * F.pi() * F.dayofyear("ds") / 365.25
    weeks = calendar.select("ds", "holiday_days_in_week", F.sin(angle).alias("week_sin"), F.cos(angle).alias("week_cos"))
    first = panel.groupBy("unique_id").agg(F.min("ds").alias("first_ds"))
    return first.join(F.broadcast(weeks), F.col("ds") >= F.col("first_ds")).drop("first_ds")
