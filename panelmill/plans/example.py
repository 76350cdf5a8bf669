"""The given tables in the engine's terms: trips, zones, dates, sales, the weekly panel and what is built on it."""

from __future__ import annotations

from functools import cached_property, partial, reduce
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.functions import calendar as C
from panelmill.operators import features, forecast, gates, metrics, origins, panel, rollup, trips
from panelmill.session import read, written


#: Trips that a task of ``raw_trips`` holds at most, about, where it is asked to bound them: some 100 MB of sort.
TASK_TRIPS = 1 << 20


def raw_trips(spark: SparkSession, sf: str, bounded: bool = False) -> DataFrame:
    """lineitem with its order's customer's nation as the pickup zone; customers and nations are dimension tables. ``bounded`` deals
    the trips out by order to tasks of about ``TASK_TRIPS``, however many there are."""
    t = partial(read, spark, sf)
    lines = t("lineitem")
    heads = t("orders").select("o_orderkey", "o_custkey").join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    if bounded:
        parts = max(spark.sparkContext.defaultParallelism, -(-lines.count() // TASK_TRIPS))
        lines, heads = lines.repartition(parts, "l_orderkey"), heads.repartition(parts, "o_orderkey")
    rows = lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
    k = F.col("l_orderkey")
    shift = F.when(k % 50 == 0, 4).when(k % 50 == 1, -4).when(k % 50 == 2, 1).when(k % 50 == 3, -1).otherwise(0)
    seconds = F.col("l_quantity").cast("long") * 60 - F.when(k % 53 == 0, 3600).otherwise(0)
    month = F.add_months(F.trunc(F.to_date("l_shipdate"), "month"), shift)
    return rows.select(
        k.alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("vendor_id"),
        F.col("c_nationkey").alias("pu_zone"),
        F.when(k % 41 != 7, (F.col("l_partkey") % 25).cast("int")).alias("do_zone"),
        F.col("l_shipdate").alias("pickup_ts"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))).alias("dropoff_ts"),
        F.when(k % 89 == 0, 0.0).otherwise(F.col("l_quantity")).alias("trip_distance"),
        F.when(k % 97 == 0, 0.0).otherwise(F.col("l_extendedprice")).alias("fare_amount"),
        F.when(k % 83 == 0, -1.0).otherwise(F.col("l_extendedprice") + 10).alias("total_amount"),
        F.concat(F.lit("trips_"), F.date_format(month, "yyyy-MM"), F.lit(".parquet")).alias("sourcefile_name"),
    )


def zones(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "nation").join(read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("zone_id"), F.col("n_name").alias("zone"), F.col("r_name").alias("borough"))


def silver_trips(spark: SparkSession, sf: str, bounded: bool = False) -> DataFrame:
    return trips.date_sanity(raw_trips(spark, sf, bounded))


def clean_trips(spark: SparkSession, sf: str) -> DataFrame:
    return trips.valid_fares(trips.with_trip_columns(silver_trips(spark, sf)))


def sales(spark: SparkSession, sf: str) -> DataFrame:
    o, c = read(spark, sf, "orders"), read(spark, sf, "customer")
    return o.join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").cast("long").alias("unique_id"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount")
    )


def bounds(spark: SparkSession, sf: str) -> DataFrame:
    """One row: the first and the last date of the facts."""
    ends = lambda t, c: read(spark, sf, t).agg(F.min(c).alias("a"), F.max(c).alias("b"))
    both = ends("orders", "o_orderdate").unionByName(ends("lineitem", "l_shipdate"))
    return both.agg(F.to_date(F.min("a")).alias("first"), F.to_date(F.max("b")).alias("last"))


def years(spark: SparkSession, sf: str) -> DataFrame:
    """The fiscal years that the facts reach into."""
    return Study.of(spark, sf).years


def dates(spark: SparkSession, sf: str) -> DataFrame:
    """The date dimension of the facts' years."""
    return Study.of(spark, sf).dates


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    return Study.of(spark, sf).calendar


#: The benchmark and its challengers.
MODELS = ("naive", "recent_mean", "recent_quarter")
#: Numbers of boosting rounds that calibration compares: 64, as many as the reference has; there 25 trees apart at a lower rate.
ROUNDS = list(range(1, 65))


class Study:
    """The chain from sales to scored forecasts. Each step is written once and shared by the steps that read it, so plans stay
    short; all origins, series and models go through each step together."""

    known: ClassVar[dict[tuple[str, str], Study]] = {}

    def __init__(self, spark: SparkSession, sf: str, fiscal: DataFrame | None = None) -> None:
        """``fiscal``: the fiscal years as ``calendar.given_years`` has them; without it the rule holds for the years of the facts."""
        self.spark, self.sf, self.fiscal = spark, sf, fiscal

    @classmethod
    def of(cls, spark: SparkSession, sf: str) -> Study:
        """The study of an input within one application: its written steps serve all queries. ``Study(...)`` is a new one."""
        return cls.known.setdefault((spark.sparkContext.applicationId, sf), cls(spark, sf))

    @cached_property
    def years(self) -> DataFrame:
        return self.dates.select("fiscal_year").distinct()

    @cached_property
    def dates(self) -> DataFrame:
        years = C.fiscal_years(bounds(self.spark, self.sf)) if self.fiscal is None else self.fiscal
        return written(C.date_dimension(years).coalesce(1), "dates")

    @cached_property
    def calendar(self) -> DataFrame:
        return written(C.indexed(C.weekly_calendar(self.dates)).coalesce(1), "calendar")

    @cached_property
    def daily_facts(self) -> DataFrame:
        return written(trips.daily_facts(silver_trips(self.spark, self.sf)), "daily-facts")

    @cached_property
    def panel(self) -> DataFrame:
        made = written(panel.weekly_panel(sales(self.spark, self.sf)), "panel")
        twice = gates.unique_keys(self.calendar, ["ds"]).select("ds")
        gates.enforce(gates.uncovered_weeks(made, self.calendar).union(twice), "weeks that the calendar lacks or has twice")
        return made

    @cached_property
    def last(self) -> DataFrame:
        return written(origins.last_complete_month(self.panel, self.calendar), "last-month")

    @cached_property
    def origins(self) -> DataFrame:
        return written(origins.origins_for(self.starts, self.calendar, horizon_months=2).coalesce(1), "origins")

    @cached_property
    def history(self) -> DataFrame:
        """All weeks up to each origin, for what needs them all; the others read ``recent``."""
        return forecast.history(self.panel, self.origins, self.calendar)

    @cached_property
    def recent(self) -> DataFrame:
        return forecast.history(self.panel, self.origins, self.calendar, 52)

    @cached_property
    def future(self) -> DataFrame:
        return forecast.future_weeks(self.panel, self.origins, self.calendar)

    @cached_property
    def forecasts(self) -> DataFrame:
        each = [forecast.FORECASTERS[m](self.recent, self.future).withColumn("model", F.lit(m)) for m in MODELS]
        return written(reduce(DataFrame.unionByName, each), "forecasts")

    @cached_property
    def mtd(self) -> DataFrame:
        return rollup.month_to_date(self.panel, self.origins, self.calendar)

    @cached_property
    def remaining(self) -> DataFrame:
        return rollup.predicted_remaining(self.forecasts, self.calendar)

    @cached_property
    def components(self) -> DataFrame:
        return written(rollup.combine(self.mtd, self.remaining), "components")

    @cached_property
    def totals(self) -> DataFrame:
        return panel.monthly_totals(self.panel, self.calendar)

    @cached_property
    def series(self) -> DataFrame:
        made = rollup.monthly_series(self.components, self.totals, rollup.tiers(self.recent), rollup.weights(self.recent), self.origins, self.calendar, self.last)
        return written(made, "monthly-series")

    @cached_property
    def base(self) -> DataFrame:
        return written(metrics.base_frame(self.series.where("model = 'recent_mean'"), self.series.where("model = 'naive'")), "base")

    @cached_property
    def scores(self) -> DataFrame:
        return written(metrics.fold_scores(metrics.both_models(self.base, "recent_mean", "naive")), "fold-scores")

    @cached_property
    def starts(self) -> DataFrame:
        return origins.start_months(self.calendar, self.last, n=4, step=1, horizon_months=2)

    @cached_property
    def calibration_origins(self) -> DataFrame:
        """Origins of the two start months whose target months all lie before the backtest's, at month ends."""
        first = self.starts.agg(F.min("month_index").alias("i"))
        before = origins.months(self.calendar).crossJoin(F.broadcast(first)).where("month_index IN (i - 3, i - 2)").select(F.col("fiscal_year_month").alias("start_month"), "month_index")
        return written(origins.origins_for(before, self.calendar, horizon_months=2).where("fraction = 1").coalesce(1), "calibration-origins")

    @cached_property
    def calibration_months(self) -> DataFrame:
        """Held-out months: one fit at most rounds for each calibration origin, all in the same jobs; forecasts of every number of rounds in
        one pass, and what came true."""
        fits, of = forecast.shared_fits(self.calibration_origins, refit_every=1)
        forest = forecast.fit_boosted(self.panel, self.calendar, fits, rounds=max(ROUNDS))
        rows = forecast.predict_boosted(forest, self.panel, self.calendar, of, ROUNDS)
        components = rollup.combine(rollup.month_to_date(self.panel, self.calibration_origins, self.calendar), rollup.predicted_remaining(rows.withColumn("model", F.col("rounds").cast("string")), self.calendar))
        past = forecast.history(self.panel, self.calibration_origins, self.calendar, 52)
        made = rollup.monthly_series(components, self.totals, rollup.tiers(past), rollup.weights(past), self.calibration_origins, self.calendar, self.last)
        return written(made.withColumn("rounds", F.col("model").cast("int")), "calibration-months")

    @cached_property
    def curve(self) -> DataFrame:
        return written(forecast.rounds_curve(self.calibration_months), "rounds-curve")

    @cached_property
    def spine(self) -> DataFrame:
        return origins.spine(self.calendar)

    @cached_property
    def complete_pairs(self) -> DataFrame:
        return panel.trim_incomplete(self.panel, self.calendar)[0].select("unique_id", "fiscal_year_month").distinct()

    @cached_property
    def grid(self) -> DataFrame:
        return written(features.origin_series_grid(self.spine, self.totals, self.complete_pairs), "grid")

    @cached_property
    def weekly_features(self) -> DataFrame:
        return written(features.weekly_features(self.panel, [1, 2, 52], {1: 4}), "weekly-features")

    @cached_property
    def table(self) -> DataFrame:
        """The grid with month-to-date revenue and the previous month's total."""
        return written(features.attach_last_month(features.attach_mtd(self.grid, self.panel, self.calendar), self.totals, self.calendar), "origin-table")

    @cached_property
    def modelling_table(self) -> DataFrame:
        return written(features.attach_weekly_features(self.table, self.weekly_features), "modelling-table")


def weekly_panel(spark: SparkSession, sf: str) -> DataFrame:
    return Study.of(spark, sf).panel


def components(spark: SparkSession, sf: str) -> DataFrame:
    return Study.of(spark, sf).components


def monthly_series(spark: SparkSession, sf: str) -> DataFrame:
    return Study.of(spark, sf).series
