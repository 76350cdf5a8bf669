"""Queries: panel, origins, roll-up, tiers and weights, modelling table, forecasts (B8, C8-C25, D7-D26, E1-E8, F, G, H14, K)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelmill.operators import features as FE
from panelmill.operators import forecast as FC
from panelmill.operators import gates as G
from panelmill.operators import origins as O
from panelmill.operators import panel as P
from panelmill.operators import rollup as R
from panelmill.plans import example as X
from panelmill.plans.catalog import query


def q(name: str, sql: str | None = None, r: tuple[str, ...] = ()):
    """A query over the study."""

    def keep(f):
        query(name, sql, r)(lambda spark, sf: f(X.Study.of(spark, sf)))
        return f

    return keep


@q("d7_weekly_panel", "SELECT unique_id, ds, y FROM panel")
def d7(s):
    return s.panel


@q("d8_weekly_calendar", "SELECT ds, fiscal_year, fiscal_week, fiscal_year_week, fiscal_month, fiscal_year_month, count_workdays, holiday_days_in_week, fiscal_week_of_month, weeks_in_month, origin_month_fraction_elapsed FROM cal", r=("origin_month_fraction_elapsed",))
def d8(s):
    return s.calendar.drop("week_index", "month_index")


@q("e1_weeks_in_month", "SELECT ds, fiscal_week_of_month, weeks_in_month, origin_month_fraction_elapsed FROM cal", r=("origin_month_fraction_elapsed",))
def e1(s):
    return s.calendar.select("ds", "fiscal_week_of_month", "weeks_in_month", "origin_month_fraction_elapsed")


@q("d9_weekly_fiscal_frame", "SELECT unique_id, ds, y, fiscal_year_week, fiscal_week_of_month FROM pc")
def d9(s):
    return P.on_calendar(s.panel, s.calendar).select("unique_id", "ds", "y", "fiscal_year_week", "fiscal_week_of_month")


@q("c8_panel_calendar_join", "SELECT unique_id, ds, y, fiscal_year_month, count_workdays FROM pc")
def c8(s):
    return P.on_calendar(s.panel, s.calendar).select("unique_id", "ds", "y", "fiscal_year_month", "count_workdays")


@q("d10_monthly_totals", "SELECT * FROM month_totals")
def d10(s):
    return s.totals


@q("c9_target_month_join", "SELECT unique_id, ds, y FROM pc WHERE fiscal_year_month IN (SELECT fiscal_year_month FROM months, last_complete l WHERE months.month_index > l.i - 3)")
def c9(s):
    months = O.months(s.calendar).crossJoin(F.broadcast(s.last)).where("month_index > last_index - 3").select("fiscal_year_month")
    return P.on_calendar(s.panel, s.calendar).join(F.broadcast(months), "fiscal_year_month").select("unique_id", "ds", "y")


@q("d11_predicted_remaining", "SELECT model, forecast_origin_date, unique_id, predicted_fiscal_year_month, CAST(predicted_remaining AS DOUBLE) AS predicted_remaining FROM remaining")
def d11(s):
    return s.remaining.withColumn("predicted_remaining", F.col("predicted_remaining").cast("double"))


@q("d12_month_to_date", "SELECT forecast_origin_date, unique_id, predicted_fiscal_year_month, CAST(mtd_revenue AS DOUBLE) AS mtd_revenue FROM mtd")
def d12(s):
    return s.mtd.withColumn("mtd_revenue", F.col("mtd_revenue").cast("double"))


@q("c10_combine_mtd_remaining", "SELECT * FROM components")
def c10(s):
    return s.components


@q("d13_forecast_vs_actual", "SELECT k.model, k.forecast_origin_date, k.unique_id, k.predicted_fiscal_year_month, monthly_forecast, actual_monthly_total FROM components k JOIN month_totals a ON a.unique_id = k.unique_id AND a.fiscal_year_month = k.predicted_fiscal_year_month")
def d13(s):
    return s.components.join(s.totals.withColumnRenamed("fiscal_year_month", "predicted_fiscal_year_month"), ["unique_id", "predicted_fiscal_year_month"]).select("model", *R.KEYS, "monthly_forecast", "actual_monthly_total")


@q("c11_realised_months", "SELECT model, forecast_origin_date, unique_id, predicted_fiscal_year_month FROM ms")
def c11(s):
    return s.series.select("model", *R.KEYS)


@q("c12_tier_and_weight", "SELECT forecast_origin_date, unique_id, tier, series_weight FROM named_tiers JOIN weights USING (forecast_origin_date, unique_id)", r=("series_weight",))
def c12(s):
    keys = ["forecast_origin_date", "unique_id"]
    return R.tiers(s.history).drop("tier_rank").join(R.weights(s.history), keys)


@q("d14_tiers", "SELECT forecast_origin_date, unique_id, tier_rank, tier FROM named_tiers")
def d14(s):
    return R.tiers(s.history)


@q("d15_weights", "SELECT * FROM weights", r=("series_weight",))
def d15(s):
    return R.weights(s.history)


MS = "model, forecast_origin_date, unique_id, predicted_fiscal_year_month, tier, tier_rank, monthly_forecast, actual_monthly_total, series_weight, origin_month_fraction_elapsed, horizon, mtd_revenue"


@q("d16_monthly_series", f"SELECT {MS} FROM ms", r=("series_weight", "origin_month_fraction_elapsed"))
def d16(s):
    return s.series


@q("d17_last_complete_month", "SELECT m AS last_month FROM last_complete")
def d17(s):
    return s.last.select("last_month")


@q("d18_trim_incomplete", "SELECT unique_id, ds, y, fiscal_year_month FROM trimmed")
def d18(s):
    return P.trim_incomplete(s.panel, s.calendar)[0].select("unique_id", "ds", "y", "fiscal_year_month")


@q("d18_dropped_pairs", "SELECT unique_id, fiscal_year_month, CAST(count(DISTINCT fiscal_week_of_month) AS INTEGER) AS present, max(weeks_in_month) AS expected FROM pc WHERE (unique_id, fiscal_year_month) NOT IN (SELECT (unique_id, fiscal_year_month) FROM complete) GROUP BY ALL")
def d18_dropped(s):
    return P.trim_incomplete(s.panel, s.calendar)[1]


@q("d19_expected_counts", "SELECT count(DISTINCT target_month) AS n_months, count(DISTINCT forecast_origin_date) AS n_origins, count(DISTINCT unique_id) AS n_series, count(*) AS n_events FROM grid")
def d19(s):
    return s.grid.agg(F.countDistinct("target_month").alias("n_months"), F.countDistinct("forecast_origin_date").alias("n_origins"), F.countDistinct("unique_id").alias("n_series"), F.count("*").alias("n_events"))


BELOW = ", ".join(f"sum((mtd_revenue > {c})::INT)::BIGINT AS n_{n}_below, avg((mtd_revenue > {c})::INT) AS share_{n}_below, avg(CASE WHEN mtd_revenue > {c} THEN mtd_revenue - {c} END) AS mean_{n}_gap, max(CASE WHEN mtd_revenue > {c} THEN mtd_revenue - {c} END) AS max_{n}_gap" for n, c in (("forecast", "monthly_forecast"), ("actual", "actual_monthly_total")))


@q("d20_below_mtd", f"SELECT model, forecast_origin_date, predicted_fiscal_year_month, count(*) AS n, {BELOW} FROM ms GROUP BY ALL", r=tuple(f"{a}_{n}_{b}" for n in ("forecast", "actual") for a, b in (("share", "below"), ("mean", "gap"), ("max", "gap"))))
def d20(s):
    return R.below_mtd(s.series)


@q("d26_distinct_counts", "SELECT count(DISTINCT unique_id) AS n_series, count(DISTINCT forecast_origin_date) AS n_origins, count(DISTINCT (forecast_origin_date, predicted_fiscal_year_month)) AS n_folds FROM ms")
def d26(s):
    return s.series.agg(F.countDistinct("unique_id").alias("n_series"), F.countDistinct("forecast_origin_date").alias("n_origins"), F.countDistinct("forecast_origin_date", "predicted_fiscal_year_month").alias("n_folds"))


@q("e2_origin_spine", "SELECT target_month, forecast_origin_date, weeks_actualized, weeks_in_month FROM spine")
def e2(s):
    return s.spine


PROGRESS = "SELECT s.*, t.workdays_total, coalesce(c.done, 0)::BIGINT AS workdays_to_date, (t.workdays_total - coalesce(c.done, 0))::BIGINT AS workdays_remaining FROM spine s JOIN (SELECT fiscal_year_month AS m, sum(count_workdays)::BIGINT AS workdays_total FROM cal GROUP BY 1) t ON t.m = s.target_month LEFT JOIN (SELECT fiscal_year_month AS m, fiscal_week_of_month AS w, sum(count_workdays) OVER (PARTITION BY fiscal_year_month ORDER BY fiscal_week_of_month) AS done FROM cal) c ON c.m = s.target_month AND c.w = s.weeks_actualized"


@q("e3_workday_progress", PROGRESS)
def e3(s):
    return O.workday_progress(s.spine, s.calendar)


@q("c16_origin_series_grid", "SELECT target_month, unique_id, actual_monthly_total, forecast_origin_date, weeks_actualized, weeks_in_month FROM grid")
def c16(s):
    return s.grid


MTD = "SELECT g.*, CAST(coalesce((SELECT sum(CAST(y AS DECIMAL(18,2))) FROM pc WHERE pc.unique_id = g.unique_id AND pc.fiscal_year_month = g.target_month AND pc.fiscal_week_of_month <= g.weeks_actualized), 0) AS DOUBLE) AS mtd_revenue FROM grid g"


@q("e4_mtd_revenue", MTD)
def e4(s):
    return FE.attach_mtd(s.grid, s.panel, s.calendar)


FEAT = "SELECT unique_id, ds, y, lag1, lag2, lag52, CASE WHEN count(lag1) OVER w = 4 THEN CAST(sum(CAST(lag1 AS DECIMAL(18,2))) OVER w AS DOUBLE) / 4 END AS rolling_mean_lag1_window_size4 FROM (SELECT unique_id, ds, y, lag(y, 1) OVER p AS lag1, lag(y, 2) OVER p AS lag2, lag(y, 52) OVER p AS lag52 FROM panel WINDOW p AS (PARTITION BY unique_id ORDER BY ds)) WINDOW w AS (PARTITION BY unique_id ORDER BY ds ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"


@q("e5_lags", f"SELECT unique_id, ds, lag1, lag2, lag52 FROM ({FEAT})")
def e5(s):
    return FE.weekly_features(s.panel, [1, 2, 52]).drop("y")


@q("e6_rolling_mean", f"SELECT unique_id, ds, rolling_mean_lag1_window_size4 FROM ({FEAT})", r=("rolling_mean_lag1_window_size4",))
def e6(s):
    return s.weekly_features.select("unique_id", "ds", "rolling_mean_lag1_window_size4")


@q("c17_weekly_features_at_origin", f"SELECT g.unique_id, g.forecast_origin_date, lag1, lag2, lag52, rolling_mean_lag1_window_size4 FROM grid g JOIN ({FEAT}) f ON f.unique_id = g.unique_id AND f.ds = CAST(g.forecast_origin_date + INTERVAL 7 DAY AS DATE)", r=("rolling_mean_lag1_window_size4",))
def c17(s):
    return s.modelling_table.select("unique_id", "forecast_origin_date", "lag1", "lag2", "lag52", "rolling_mean_lag1_window_size4")


@q("c18_future_calendar", "SELECT unique_id, ds, CAST(row_number() OVER (PARTITION BY unique_id ORDER BY ds) AS INTEGER) AS step FROM (SELECT DISTINCT unique_id FROM panel), (SELECT ds FROM cal WHERE ds > (SELECT max(ds) FROM panel) ORDER BY ds LIMIT 8)")
def c18(s):
    return s.panel.select("unique_id").distinct().crossJoin(F.broadcast(O.future_weeks(s.calendar, s.panel.agg(F.max("ds").alias("last_ds")), 8)))


EXOG = "SELECT p.unique_id, c.ds, c.holiday_days_in_week, sin(2 * pi() * dayofyear(c.ds) / 365.25) AS week_sin, cos(2 * pi() * dayofyear(c.ds) / 365.25) AS week_cos, c.count_workdays FROM (SELECT unique_id, min(ds) AS a FROM panel GROUP BY 1) p JOIN cal c ON c.ds >= p.a"


@q("c19_exogenous", EXOG, r=("week_sin", "week_cos"))
def c19(s):
    return FE.exogenous(s.panel, s.calendar, FE.additional_exogenous(s.panel, s.calendar), ["holiday_days_in_week", "week_sin", "week_cos", "count_workdays"])


@q("c20_progress_join", "SELECT b.forecast_origin_date, b.predicted_fiscal_year_month, b.unique_id, s.weeks_in_month, s.weeks_actualized FROM base b JOIN spine s ON s.forecast_origin_date = b.forecast_origin_date AND s.target_month = b.predicted_fiscal_year_month")
def c20(s):
    at = s.spine.withColumnRenamed("target_month", "predicted_fiscal_year_month")
    return FE.progress(s.base.where("horizon = 'horizon_1'"), at).select("forecast_origin_date", "predicted_fiscal_year_month", "unique_id", "weeks_in_month", "weeks_actualized")


@q("c22_anti_join", "SELECT DISTINCT ds FROM weekly_sales WHERE ds NOT IN (SELECT ds FROM cal WHERE fiscal_year < 2001)")
def c22(s):
    return G.uncovered_weeks(P.weekly_sums(X.sales(s.spark, s.sf)), s.calendar.where("fiscal_year < 2001"))


@q("c23_semi_join", "SELECT unique_id, ds, y FROM panel WHERE ds IN (SELECT forecast_origin_date FROM origins)")
def c23(s):
    return s.panel.join(F.broadcast(s.origins.select(F.col("forecast_origin_date").alias("ds"))), "ds", "left_semi").select("unique_id", "ds", "y")


@q("c24_weeks_after_origin", "SELECT g.unique_id, g.forecast_origin_date, pc.fiscal_week_of_month, pc.y FROM grid g JOIN pc ON pc.unique_id = g.unique_id AND pc.fiscal_year_month = g.target_month AND pc.fiscal_week_of_month > g.weeks_actualized")
def c24(s):
    weeks = G.fiscal_position(s.panel, s.calendar).withColumnRenamed("fiscal_year_month", "target_month")
    return s.grid.join(weeks, ["unique_id", "target_month"]).where("fiscal_week_of_month > weeks_actualized").select("unique_id", "forecast_origin_date", "fiscal_week_of_month", "y")


@q("c25_last_month_revenue", "SELECT g.unique_id, g.forecast_origin_date, t.actual_monthly_total AS last_completed_month_revenue FROM grid g JOIN months m ON m.fiscal_year_month = g.target_month LEFT JOIN months b ON b.month_index = m.month_index - 1 LEFT JOIN month_totals t ON t.unique_id = g.unique_id AND t.fiscal_year_month = b.fiscal_year_month")
def c25(s):
    return FE.attach_last_month(s.grid, s.totals, s.calendar).select("unique_id", "forecast_origin_date", "last_completed_month_revenue")


ROLES = FE.ColumnRoles(keys=("unique_id", "forecast_origin_date"), progress=("weeks_in_month", "weeks_actualized"), features=("mtd_revenue", "lag1", "last_completed_month_revenue"), target="actual_monthly_total", passthrough=("target_month",))


@q("b8_column_roles", f"SELECT m.unique_id, m.forecast_origin_date, m.weeks_in_month, m.weeks_actualized, m.mtd_revenue, f.lag1, t.actual_monthly_total AS last_completed_month_revenue, m.target_month, m.actual_monthly_total FROM ({MTD}) m JOIN ({FEAT}) f ON f.unique_id = m.unique_id AND f.ds = CAST(m.forecast_origin_date + INTERVAL 7 DAY AS DATE) JOIN months x ON x.fiscal_year_month = m.target_month LEFT JOIN months b ON b.month_index = x.month_index - 1 LEFT JOIN month_totals t ON t.unique_id = m.unique_id AND t.fiscal_year_month = b.fiscal_year_month")
def b8(s):
    out = ROLES.select(s.modelling_table)
    ROLES.validate(out)
    return out


@q("b6_required_columns", "SELECT 'unique_id' AS column_name, count(*) AS n FROM panel UNION ALL SELECT 'ds', count(*) FROM panel UNION ALL SELECT 'y', count(*) FROM panel")
def b6(s):
    G.require_columns(s.panel, ["unique_id", "ds", "y"], "panel")
    return s.panel.select(F.explode(F.array(*[F.lit(c) for c in ("unique_id", "ds", "y")])).alias("column_name")).groupBy("column_name").agg(F.count("*").alias("n"))


@q("b9_model_view", "SELECT forecast_origin_date, predicted_fiscal_year_month, unique_id, fb AS monthly_forecast FROM base")
def b9(s):
    return s.base.select("forecast_origin_date", "predicted_fiscal_year_month", "unique_id", F.col("fb").alias("monthly_forecast"))


@q("b10_history_and_horizon", "SELECT forecast_origin_date, count(*) AS n_history, count(DISTINCT unique_id) AS n_series, max(ds) AS last_ds FROM trail GROUP BY ALL")
def b10(s):
    return s.history.groupBy("forecast_origin_date").agg(F.count("*").alias("n_history"), F.countDistinct("unique_id").alias("n_series"), F.max("ds").alias("last_ds"))


@q("c15_map_lookup", "SELECT DISTINCT forecast_origin_date, horizon, predicted_fiscal_year_month FROM ms")
def c15(s):
    return s.series.select("forecast_origin_date", "horizon", "predicted_fiscal_year_month").distinct()


@q("e7_mtd_increments", f"SELECT unique_id, target_month, weeks_actualized, mtd_revenue - lag(mtd_revenue) OVER (PARTITION BY unique_id, target_month ORDER BY weeks_actualized) AS grown FROM ({MTD})", r=("grown",))
def e7(s):
    return G.mtd_increments(s.table, s.panel, s.calendar).select("unique_id", "target_month", "weeks_actualized", "grown")


@q("e8_weight_shares", "SELECT forecast_origin_date, predicted_fiscal_year_month, unique_id, w / sum(w) OVER (PARTITION BY forecast_origin_date, predicted_fiscal_year_month) AS share FROM base", r=("share",))
def e8(s):
    total = F.sum("w").over(Window.partitionBy("forecast_origin_date", "predicted_fiscal_year_month"))
    return s.base.select("forecast_origin_date", "predicted_fiscal_year_month", "unique_id", (F.col("w") / total).alias("share"))


@q("e13_last_values", "SELECT unique_id, max_by(tier, forecast_origin_date) AS last_tier, count(*) AS n FROM (SELECT DISTINCT unique_id, forecast_origin_date, tier FROM ms) GROUP BY ALL")
def e13(s):
    return s.series.select("unique_id", "forecast_origin_date", "tier").distinct().groupBy("unique_id").agg(F.max_by("tier", "forecast_origin_date").alias("last_tier"), F.count("*").alias("n"))


@q("e16_week_index", "SELECT ds, week_index, month_index FROM cal")
def e16(s):
    return s.calendar.select("ds", "week_index", "month_index")


@q("f1_ordered_result", "SELECT unique_id, ds, y FROM panel ORDER BY unique_id, ds")
def f1(s):
    return s.panel.orderBy("unique_id", "ds")


@q("f2_top_series", "SELECT unique_id, total FROM (SELECT unique_id, CAST(sum(CAST(y AS DECIMAL(18,2))) AS DOUBLE) AS total FROM panel GROUP BY 1) ORDER BY total DESC, unique_id LIMIT 20")
def f2(s):
    return s.panel.groupBy("unique_id").agg(P.money().cast("double").alias("total")).orderBy(F.desc("total"), "unique_id").limit(20)


@q("f3_trailing_weeks", "SELECT o.forecast_origin_date, c.ds FROM origins o JOIN cal c ON c.week_index BETWEEN o.origin_week - 51 AND o.origin_week")
def f3(s):
    return O.trailing_weeks(s.calendar, s.origins, 52)


@q("f4_future_dates", "SELECT ds, CAST(row_number() OVER (ORDER BY ds) AS INTEGER) AS step FROM cal WHERE ds > (SELECT max(ds) FROM panel) ORDER BY ds LIMIT 8")
def f4(s):
    return O.future_weeks(s.calendar, s.panel.agg(F.max("ds").alias("last_ds")), 8)


@q("g1_union_of_models", "SELECT model, forecast_origin_date, unique_id, ds, round(ypred, 2) AS ypred FROM forecasts")
def g1(s):
    return s.forecasts


@q("g3_symmetric_difference", "SELECT unique_id, ds, 'left_only' AS side FROM panel WHERE (unique_id, ds) NOT IN (SELECT (unique_id, ds) FROM weekly_sales)")
def g3(s):
    return G.same_keys(s.panel, P.weekly_sums(X.sales(s.spark, s.sf)), ["unique_id", "ds"])


@q("g4_set_equality", "SELECT (SELECT count(*) FROM complete k WHERE NOT EXISTS (SELECT 1 FROM grid g WHERE g.unique_id = k.unique_id AND g.target_month = k.fiscal_year_month)) AS only_left, (SELECT count(*) FROM (SELECT DISTINCT unique_id, target_month FROM grid) g WHERE NOT EXISTS (SELECT 1 FROM complete k WHERE k.unique_id = g.unique_id AND k.fiscal_year_month = g.target_month)) AS only_right")
def g4(s):
    a, b = s.complete_pairs, s.grid.select("unique_id", F.col("target_month").alias("fiscal_year_month")).distinct()
    keys = ["unique_id", "fiscal_year_month"]
    return G.unmatched(a, b, keys).agg(F.count("*").alias("only_left")).crossJoin(G.unmatched(b, a, keys).agg(F.count("*").alias("only_right")))


@q("g5_merged_parts", "SELECT model, forecast_origin_date, count(*) AS n FROM ms GROUP BY ALL")
def g5(s):
    half = s.origins.agg(F.percentile_approx("origin_week", 0.5).alias("h"))
    weeks = s.series.join(F.broadcast(s.origins.select("forecast_origin_date", "origin_week")), "forecast_origin_date").crossJoin(F.broadcast(half))
    first, second = weeks.where("origin_week <= h").drop("origin_week", "h"), weeks.where("origin_week > h").drop("origin_week", "h")
    return G.merge_parts(first, second).groupBy("model", "forecast_origin_date").agg(F.count("*").alias("n"))


@q("g5_parameter_difference", "SELECT a.o_orderpriority AS key, CAST(a.n AS VARCHAR) AS a, CAST(b.n AS VARCHAR) AS b FROM (SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a FULL JOIN (SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) b USING (o_orderpriority) WHERE a.n IS DISTINCT FROM b.n")
def g5_parameters(s):
    o = s.spark.read.parquet(f"{s.sf}/orders.parquet")
    table = lambda x: o.where(F.col("o_orderstatus") == x).groupBy(F.col("o_orderpriority").alias("key")).agg(F.count("*").cast("string").alias("value"))
    return G.parameter_difference(table("F"), table("O"))


@q("h14_horizon_labels", "SELECT horizon, origin_month_fraction_elapsed = 1 AS at_month_end, count(*) AS n FROM ms GROUP BY ALL")
def h14(s):
    return s.series.groupBy("horizon", (F.col("origin_month_fraction_elapsed") == 1).alias("at_month_end")).agg(F.count("*").alias("n"))


@q("k1_start_months", "SELECT start_month FROM starts")
def k1(s):
    return O.start_months(s.calendar, s.last, 4, 1, 2).select("start_month")


@q("k2_origins", "SELECT forecast_origin_date, horizon FROM origins")
def k2(s):
    return s.origins.select("forecast_origin_date", "horizon")


@q("k3_fold_ids", "SELECT forecast_origin_date, horizon, CAST(row_number() OVER (ORDER BY forecast_origin_date, horizon) AS INTEGER) AS fold_id FROM origins")
def k3(s):
    return O.fold_ids(s.origins)


@q("k4_expanding_folds", "SELECT o.forecast_origin_date, (SELECT count(*) FROM trail t WHERE t.forecast_origin_date = o.forecast_origin_date) AS n_train, (SELECT count(*) FROM future f WHERE f.forecast_origin_date = o.forecast_origin_date) AS n_validation FROM origins o")
def k4(s):
    a = s.history.groupBy("forecast_origin_date").agg(F.count("*").alias("n_train"))
    return a.join(s.future.groupBy("forecast_origin_date").agg(F.count("*").alias("n_validation")), "forecast_origin_date")


K5_TEST, K5_STEP, K5_WINDOWS = 28, 28, 5


@q(
    "k5_fixed_step_folds",
    f"""SELECT part, fold, train_end, validation_end, (SELECT count(*) FROM sales WHERE day <= train_end) AS n_train, (SELECT count(*) FROM sales WHERE day > train_end AND day <= validation_end) AS n_validation FROM (
  SELECT 'validation' AS part, CAST(k AS INTEGER) AS fold, CAST(m - CAST({K5_TEST} + {K5_STEP} * (k + 1) AS INTEGER) AS DATE) AS train_end, CAST(m - CAST({K5_TEST} + {K5_STEP} * k AS INTEGER) AS DATE) AS validation_end FROM (SELECT max(day) AS m FROM sales), generate_series(0, {K5_WINDOWS - 1}) g(k)
  UNION ALL SELECT 'test', -1, CAST(max(day) - {K5_TEST} AS DATE), max(day) FROM sales)""",
)
def k5(s):
    return O.fixed_step_folds(X.sales(s.spark, s.sf).select("day"), K5_STEP, K5_STEP, K5_WINDOWS, K5_TEST)


@q("k6_month_block_folds", "SELECT v.fiscal_year_month AS validation_month, sum((g.target_month < v.fiscal_year_month)::INT)::BIGINT AS n_train, sum((g.target_month = v.fiscal_year_month)::INT)::BIGINT AS n_validation FROM (SELECT m.fiscal_year_month FROM months m, last_complete l WHERE m.month_index BETWEEN l.i - 2 AND l.i) v CROSS JOIN grid g GROUP BY ALL")
def k6(s):
    v = O.months(s.calendar).crossJoin(F.broadcast(s.last)).where("month_index between last_index - 2 and last_index").select(F.col("fiscal_year_month").alias("validation_month"))
    counted = s.grid.groupBy("target_month").agg(F.count("*").alias("n"))
    rows = counted.crossJoin(F.broadcast(v))
    return rows.groupBy("validation_month").agg(F.sum(F.when(F.col("target_month") < F.col("validation_month"), F.col("n")).otherwise(0)).alias("n_train"), F.sum(F.when(F.col("target_month") == F.col("validation_month"), F.col("n")).otherwise(0)).alias("n_validation"))


@q("k7_naive", "SELECT forecast_origin_date, unique_id, ds, ypred FROM naive")
def k7(s):
    return FC.naive(s.history, s.future)


@q("k8_seasonal_naive", "SELECT f.forecast_origin_date, f.unique_id, f.ds, t.y AS ypred FROM future f LEFT JOIN trail t ON t.forecast_origin_date = f.forecast_origin_date AND t.unique_id = f.unique_id AND t.week_index = f.week_index - 4 * ceil(f.step / 4)")
def k8(s):
    return FC.seasonal_naive(s.history, s.future, 4)


@q("k18_weekly_forecasts", "SELECT model, forecast_origin_date, unique_id, ds, round(ypred, 2) AS ypred FROM forecasts")
def k18(s):
    return s.forecasts.select("model", "forecast_origin_date", "unique_id", "ds", F.round("ypred", 2).alias("ypred"))


@q("k19_month_end_forecast", "SELECT model, forecast_origin_date, unique_id, predicted_fiscal_year_month, monthly_forecast FROM components")
def k19(s):
    return s.components.select("model", *R.KEYS, "monthly_forecast")


@q("k11_remaining_target", f"SELECT unique_id, forecast_origin_date, CAST(CAST(actual_monthly_total AS DECIMAL(18,2)) - CAST(mtd_revenue AS DECIMAL(18,2)) AS DOUBLE) AS remaining_target FROM ({MTD})")
def k11(s):
    return FE.remaining_target(s.table).select("unique_id", "forecast_origin_date", "remaining_target")


@q("j1_per_series_forecaster", "SELECT f.forecast_origin_date, f.unique_id, f.ds, l.m AS ypred FROM future f JOIN (SELECT forecast_origin_date, unique_id, max(y) AS m FROM trail WHERE week_index > origin_week - 8 GROUP BY ALL) l USING (forecast_origin_date, unique_id)")
def j1(s):
    return FC.per_series(s.history, s.future, FC.recent_peak)


@q("j2_dampening_by_name", "SELECT forecast_origin_date, unique_id, sqrt(greatest(CAST(sum(CAST(y AS DECIMAL(18,2))) AS DOUBLE), 0)) AS series_weight FROM trail WHERE week_index > origin_week - 26 GROUP BY ALL", r=("series_weight",))
def j2(s):
    return R.weights(s.history, dampening="sqrt")


RATE_WEEKS = 6
RATES = f"SELECT forecast_origin_date, unique_id, sum(y) / greatest(1, sum(count_workdays)) AS rate FROM trail JOIN cal USING (ds) WHERE trail.week_index > origin_week - {RATE_WEEKS} GROUP BY ALL"


@q("j1_future_regressor", f"SELECT f.forecast_origin_date, f.unique_id, f.ds, rate * c.count_workdays AS ypred FROM future f JOIN cal c ON c.ds = f.ds JOIN ({RATES}) r ON r.forecast_origin_date = f.forecast_origin_date AND r.unique_id = f.unique_id", r=("ypred",))
def j1_regressor(s):
    """A per-series forecaster with a regressor that is known ahead and a hyper-parameter by name."""
    workdays = s.calendar.select("ds", "count_workdays")
    return FC.per_series(s.recent, s.future, FC.workday_rate, workdays, {"weeks": RATE_WEEKS})


@q("j1_fitted_values", f"SELECT t.forecast_origin_date, t.unique_id, t.ds, rate * c.count_workdays AS fitted FROM trail t JOIN cal c ON c.ds = t.ds JOIN ({RATES}) r ON r.forecast_origin_date = t.forecast_origin_date AND r.unique_id = t.unique_id WHERE t.week_index > t.origin_week - {RATE_WEEKS}", r=("fitted",))
def j1_fitted(s):
    workdays = s.calendar.select("ds", "count_workdays")
    return FC.per_series_fitted(s.recent, s.future, FC.workday_rate, workdays, {"weeks": RATE_WEEKS})
