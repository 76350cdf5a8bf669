"""Hand-computed answers of the panel engine's operators."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from panelmill.functions import calendar as C
from panelmill.operators import features, forecast, gates, metrics, monitor, origins, panel, profile, rollup, trips
from panelmill.sources import files

D = dt.date.fromisoformat
SUNDAY = D("2023-04-02")


def week(k: int) -> dt.date:
    return SUNDAY + dt.timedelta(weeks=k)


@pytest.fixture(scope="module")
def cal(spark):
    """16 weeks, four months of four weeks, five workdays each."""
    rows = [(week(k), 202501 + k // 4, k % 4 + 1, 4, (k % 4 + 1) / 4, 5, k + 1, k // 4 + 1) for k in range(16)]
    return spark.createDataFrame(rows, "ds date, fiscal_year_month int, fiscal_week_of_month int, weeks_in_month int, origin_month_fraction_elapsed double, count_workdays int, week_index int, month_index int")


def frame(spark, values: dict[int, list[float]]):
    return spark.createDataFrame([(i, week(k), float(v)) for i, vs in values.items() for k, v in enumerate(vs)], "unique_id long, ds date, y double")


# -- calendar -----------------------------------------------------------------------------------


def test_fiscal_months_are_445_and_long_years_end_in_six_weeks(spark):
    bounds = spark.createDataFrame([(D("1996-05-01"), D("2001-02-03"))], "first date, last date")
    dates = C.date_dimension(C.fiscal_years(bounds))
    weekly = {r.fiscal_year_month: r.weeks_in_month for r in C.weekly_calendar(dates).collect()}
    assert [weekly[199500 + m] for m in range(1, 13)] == [4, 4, 5] * 4 and weekly[199712] == 6 and weekly[199812] == 5 and weekly[200212] == 5
    assert dates.where("week_start > date OR date > date_add(week_start, 6)").count() == 0
    assert dates.count() == dates.select("date").distinct().count() == 7 * sum(weekly.values())
    row = dates.where("date = date'2000-07-04'").first()
    assert row.is_holiday and row.is_dst and row.day_of_week == 2 and row.day_name == "Tuesday"
    assert dates.where("fiscal_week_of_month = 1 AND day_of_week = 0 AND day_of_fiscal_month <> 1").count() == 0 and dates.agg(F.max("day_of_fiscal_month")).first()[0] == 42


def test_no_fact_is_lost_to_the_calendar(spark):
    facts = spark.createDataFrame([(1, D("1994-01-07"), 9.0), (1, D("2001-03-04"), 5.0), (2, D("2003-12-31"), 7.0)], "unique_id long, day date, amount double")
    made = panel.weekly_panel(facts)
    assert made.agg(F.sum("y")).first()[0] == 21.0
    years = C.fiscal_years(facts.agg(F.min("day").alias("first"), F.max("day").alias("last")))
    cal = C.weekly_calendar(C.date_dimension(years))
    assert gates.uncovered_weeks(made, cal).count() == 0 and panel.on_calendar(made, cal).count() == made.count()
    assert gates.uncovered_weeks(made, cal.where("fiscal_year > 1996")).count() > 0


def test_calendar_by_table(spark):
    table = C.year_table(spark, range(2018, 2028), (2020, 2026))
    dates = C.date_dimension(C.given_years(table, "2017-12-31"))
    starts = {r.fiscal_year: str(r.a) for r in dates.groupBy("fiscal_year").agg(F.min("date").alias("a")).collect()}
    assert starts == {2018: "2017-12-31", 2019: "2018-12-30", 2020: "2019-12-29", 2021: "2021-01-03", 2022: "2022-01-02", 2023: "2023-01-01", 2024: "2023-12-31", 2025: "2024-12-29", 2026: "2025-12-28", 2027: "2027-01-03"}
    weeks = {r.fiscal_year_month: r.weeks_in_month for r in C.weekly_calendar(dates).collect()}
    assert weeks[202012] == weeks[202612] == 6 and weeks[202512] == 5 and len(weeks) == 120
    ruled = C.ruled_years(spark.createDataFrame([(2025,), (2026,)], "fiscal_year int"))  # the rule puts the long year elsewhere
    assert [str(r.start) for r in ruled.orderBy("fiscal_year").collect()] == ["2024-12-29", "2026-01-04"]
    broken = spark.createDataFrame([(2018, [28, 29, 35])], "fiscal_year int, month_days array<int>")
    for bad, day in ((broken, "2017-12-31"), (table, "2018-01-01"), (table.where("fiscal_year <> 2020"), "2017-12-31"), (table.union(table), "2017-12-31"), (table.where("false"), "2017-12-31")):
        with pytest.raises(ValueError, match="whole weeks"):
            C.given_years(bad, day)


def test_week_start_is_sunday(spark):
    got = spark.range(14).select(C.week_start(F.date_add(F.lit(SUNDAY), F.col("id").cast("int"))).alias("d")).collect()
    assert [r.d for r in got] == [SUNDAY] * 7 + [week(1)] * 7


# -- trips ----------------------------------------------------------------------------------------


def test_date_sanity_keeps_both_ends(spark):
    rows = [("2025-02-01", True), ("2025-01-31", False), ("2025-05-01", True), ("2025-05-02", False)]
    df = spark.createDataFrame([(d + " 00:00:00", "trips_2025-03.parquet") for d, _ in rows], "p string, sourcefile_name string").select(F.col("p").cast("timestamp_ntz").alias("pickup_ts"), "sourcefile_name")
    assert {str(r.pickup_date) for r in trips.date_sanity(df).collect()} == {d for d, ok in rows if ok}
    assert trips.date_sanity(df, keep=False).count() == 2


def test_fare_filter_drops_nulls_as_sql_does(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (0.0, 1.0, 1.0), (1.0, 0.0, 1.0), (1.0, -1.0, 0.0), (1.0, 1.0, 0.0), (None, 1.0, 1.0)], "fare_amount double, total_amount double, trip_distance double")
    assert trips.valid_fares(df).count() == 2


def test_ingest_demands_the_exact_columns(spark, tmp_path):
    cols = [F.lit(None).cast(t).alias(c.upper()) for c, t in files.TRIP_COLUMNS.items() if c not in files.LATER_COLUMNS]
    for k in range(3):
        spark.range(2).select(*cols).write.parquet(f"{tmp_path}/a{k}")
    spark.range(2).select(*cols, F.lit(1.5).alias("congestion_fee")).write.parquet(f"{tmp_path}/later")
    got = files.ingest_trip_files(spark, [*(f"{tmp_path}/a{k}" for k in range(3)), f"{tmp_path}/later"])
    assert got.columns[:11] == list(files.TRIP_COLUMNS) and got.count() == 8 and got.where("congestion_fee = 1.5").count() == 2
    assert got._jdf.queryExecution().analyzed().toString().count("Union") == 1  # as many branches as schemas
    spark.range(2).select(*cols, F.lit(1).alias("odd")).write.parquet(f"{tmp_path}/b")
    with pytest.raises(ValueError, match="odd"):
        files.ingest_trip_files(spark, [f"{tmp_path}/b"])


@pytest.mark.parametrize("footers", [True, False])
def test_schemas_are_found_file_by_file(spark, tmp_path, footers):
    cols = [F.lit(None).cast(t).alias(c.upper()) for c, t in files.TRIP_COLUMNS.items() if c not in files.LATER_COLUMNS]
    folder = f"{tmp_path}/year=2024/month=01"
    spark.range(2).select(*cols).coalesce(1).write.parquet(folder)
    spark.range(3).select(*cols, F.lit(1.5).alias("Congestion_Fee")).coalesce(1).write.mode("append").parquet(folder)
    spark.range(1).select(*[c.cast("string") if k == 1 else c for k, c in enumerate(cols)]).coalesce(1).write.mode("append").parquet(folder)
    kinds = files.file_schemas(spark, [str(tmp_path)], footers).collect()
    assert len(kinds) == 3 and len({r["kind"] for r in kinds}) == 3
    got = files.ingest_trip_files(spark, [str(tmp_path)], footers)
    assert got.count() == 6 and got.where("congestion_fee = 1.5").count() == 3 and got.columns[:11] == list(files.TRIP_COLUMNS)
    assert got.select("sourcefile_path").distinct().count() == 3


def test_stored_sketches_merge(spark):
    rows = spark.range(60_000).selectExpr("date_add(date'2024-01-01', cast(id % 60 as int)) AS day", "id % 9000 AS who", "cast((id * 7919) % 60000 as double) AS v")
    daily = profile.daily_sketches(rows, "day", "who", "v")
    whole = profile.sketch_figures(profile.merged_sketches(daily), [0.0, 0.25, 0.5, 0.9, 1.0]).first()
    assert whole.n == 60_000 and abs(whole.distinct - 9000) <= 0.03 * 9000
    assert all(abs(q - p * 60_000) <= 0.02 * 60_000 for q, p in zip(whole.q, [0.0, 0.25, 0.5, 0.9, 1.0]))
    monthly = profile.merged_sketches(daily, F.trunc("day", "month").alias("month"))
    again = profile.sketch_figures(profile.merged_sketches(monthly), [0.5]).first()  # merges of merges
    assert again.n == 60_000 and abs(again.distinct - 9000) <= 0.03 * 9000 and abs(again.q[0] - 30_000) <= 0.02 * 60_000
    assert {str(r.month): r.n for r in monthly.collect()} == {"2024-01-01": 31_000, "2024-02-01": 29_000}


def test_first_in_group_counts_distinct_identities(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (None, "b"), (None, "b"), (3, None), (3, None)], "who long, g string")
    made = profile.first_in_group(rows, "who", "g")
    assert made.count() == 8 and {r.g: r.n for r in made.groupBy("g").agg(F.count_if("is_first").alias("n")).collect()} == {"a": 2, "b": 1, None: 1}


def test_curated_trips_are_local_and_unnamed_ones_do_not_count(spark):
    rows = [(1, 4, 7, "2024-03-10 06:59:00", "2024-03-10 07:01:00"), (1, 4, None, "2024-07-01 03:30:00", "2024-07-01 04:30:00"), (None, 4, 7, "2024-01-01 00:00:00", "2024-01-01 00:00:30")]
    df = spark.createDataFrame(rows, "vendor_id long, pu_zone int, do_zone int, p string, d string")
    df = df.select("vendor_id", "pu_zone", "do_zone", F.col("p").cast("timestamp_ntz").alias("pickup_ts"), F.col("d").cast("timestamp_ntz").alias("dropoff_ts"), F.lit("f_2024-03.parquet").alias("sourcefile_name"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", session)
            got = {str(r.pickup_ts): r for r in trips.curated(df).collect()}
            a, b, c = (got[r[3]] for r in rows)
            assert (str(a.pickup_date), str(a.dropoff_hour), str(b.pickup_date), str(b.dropoff_date), str(c.pickup_date)) == ("2024-03-10", "2024-03-10 07:00:00", "2024-06-30", "2024-07-01", "2023-12-31")
            assert a.trip_id is not None and b.trip_id is None and c.trip_id is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r.n for r in trips.daily_counts(trips.with_trip_columns(df)).orderBy("pickup_date").collect()] == [0, 1, 0]


def test_spine_and_cutoff_of_late_zones_and_half_months(spark):
    end = spark.createDataFrame([(D("2025-02-15"),)], "covered_end date")
    seen = lambda *days: spark.createDataFrame([(z, D(d), f"{z}{d}") for z, d in days], "pu_zone int, pickup_date date, trip_id string")
    daily = trips.daily_counts(seen((1, "2025-02-13"), (2, "2025-02-18"), (1, "2025-02-15"), (1, "2025-02-16")), end)
    assert sorted((r.pu_zone, str(r.pickup_date), r.n) for r in daily.collect()) == [(1, "2025-02-13", 1), (1, "2025-02-15", 1)]
    late = seen((1, "2025-02-14"), (2, "2025-02-18")).withColumn("n", F.lit(1).cast("long"))
    assert sorted((r.pu_zone, str(r.pickup_date)) for r in trips.zone_spine(late, end).collect()) == [(1, "2025-02-14"), (1, "2025-02-15")]
    dates = C.date_dimension(C.fiscal_years(spark.createDataFrame([(D("2025-01-01"), D("2025-03-01"))], "first date, last date")))
    last_day = dates.where("fiscal_year_month = 202501").agg(F.max("date")).first()[0]
    cut = lambda d: trips.month_cutoff(spark.createDataFrame([(1, d, 1)], "pu_zone int, pickup_date date, n long"), dates).first().cutoff_month
    assert [cut(last_day), cut(last_day - dt.timedelta(1)), cut(last_day + dt.timedelta(1))] == [202501, 202412, 202501]


def test_empty_extract_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no rows"):
        files.extract(spark, "SELECT 1 AS x WHERE :a = 2", {"a": 1}, f"{tmp_path}/x")


# -- panel and roll-up --------------------------------------------------------------------------------


def test_month_to_date_and_remainder(spark, cal):
    rows = frame(spark, {31: [9, 9, 9, 9, 40, 85], 47: [3, 0, 3, 0, 6, 15]})
    o = spark.createDataFrame([(week(5), 6, 2, 202502, 2, 0.5)], "forecast_origin_date date, origin_week int, horizon int, origin_month int, origin_month_index int, fraction double")
    made = [(week(5), i, week(k), v, "m") for i, vs in {31: (12.5, 20.0), 47: (7.0, 0.25)}.items() for k, v in zip((6, 7), vs)]
    fc = spark.createDataFrame(made, "forecast_origin_date date, unique_id long, ds date, ypred double, model string")
    got = {r.unique_id: (r.mtd_revenue, r.predicted_remaining, r.monthly_forecast) for r in rollup.combine(rollup.month_to_date(rows, o, cal), rollup.predicted_remaining(fc, cal)).collect()}
    assert got == {31: (125.0, 32.5, 157.5), 47: (21.0, 7.25, 28.25)}


def test_trim_drops_pairs_with_missing_or_doubled_weeks(spark, cal):
    rows = frame(spark, {31: [1] * 8, 47: [1] * 7})
    kept, dropped = panel.trim_incomplete(rows, cal)
    assert kept.count() == 12 and [(r.unique_id, r.fiscal_year_month, r.present, r.expected) for r in dropped.collect()] == [(47, 202502, 3, 4)]
    doubled = rows.union(rows.where(f"unique_id = 31 AND ds = date'{week(1)}'"))
    assert panel.trim_incomplete(doubled, cal)[0].where("unique_id = 31 AND fiscal_year_month = 202501").count() == 0


def test_origins_of_one_month(spark, cal):
    rows = frame(spark, {1: [1] * 8})
    last = origins.last_complete_month(rows, cal)
    assert last.first().last_month == 202502
    assert origins.last_complete_month(frame(spark, {1: [1] * 7}), cal).first().last_month == 202501
    starts = origins.start_months(cal, last, 1, 1, 1)
    got = [(r.forecast_origin_date, r.horizon) for r in origins.origins_for(starts, cal, 1).orderBy("forecast_origin_date").collect()]
    assert got == [(week(3), 4), (week(4), 3), (week(5), 2), (week(6), 1)]


def test_horizon_labels_shift_at_a_month_end(spark):
    rows = spark.createDataFrame([(3, 2, 0.5), (3, 2, 1.0), (2, 2, 0.5)], "p int, o int, f double")
    got = [r[0] for r in rows.select(origins.horizon_label(F.col("p"), F.col("o"), F.col("f"))).collect()]
    assert got == ["horizon_2", "horizon_1", "horizon_1"]


def test_tiers_are_right_closed_bins_of_positive_means(spark, cal):
    o = spark.createDataFrame([(week(7), 8)], "forecast_origin_date date, origin_week int")
    rows = frame(spark, {1: [10] * 8, 2: [5] * 8, 3: [1] * 8, 4: [0] * 8})
    got = {r.unique_id: r.tier for r in rollup.tiers(forecast.history(rows, o, cal)).collect()}
    assert got == {3: "very_low", 2: "low", 1: "middle", 4: "very_low"}
    w = {r.unique_id: r.series_weight for r in rollup.weights(forecast.history(rows, o, cal), weeks=4).collect()}
    assert abs(w[1] - 40 ** (1 / 3)) < 1e-12 and w[4] == 0


def test_reindex_shows_gaps(spark, cal):
    rows = frame(spark, {1: [5, 6, 7, 8]}).where(f"ds <> date'{week(1)}'").union(frame(spark, {2: [1] * 8}))
    got = {(r.unique_id, r.ds): r.y for r in panel.reindexed(rows, cal).collect()}
    assert got[1, week(1)] is None and got[1, week(7)] is None and len(got) == 16
    ragged = spark.createDataFrame([(3, week(k), 2.0) for k in range(1, 8)], "unique_id long, ds date, y double")
    monthly = monitor.monthly_status(ragged, cal)
    one_origin = ragged.select("unique_id", F.lit(week(7)).alias("forecast_origin_date"))
    both = {r.fiscal_year_month: (r.status, r.total) for r in monitor.global_monthly(monthly, one_origin).collect()}
    assert both == {202501: ("incomplete", None), 202502: ("complete", 8.0)}  # a month that no member has whole
    status = {(r.unique_id, r.fiscal_year_month): (r.status, r.total) for r in monitor.monthly_status(panel.reindexed(rows, cal), cal).collect()}
    assert status[1, 202501] == ("gapped", None) and status[2, 202502] == ("complete", 4.0)


def test_recursive_hook_and_naive(spark, cal):
    o = spark.createDataFrame([(week(5), 6, 2)], "forecast_origin_date date, origin_week int, horizon int")
    rows = frame(spark, {1: [1, 2, 3, 4, 5, 9, 100]})
    h, f = forecast.history(rows, o, cal), forecast.future_weeks(rows, o, cal)
    assert [r.ypred for r in forecast.naive(h, f).collect()] == [9.0, 9.0]
    assert [r.ypred for r in forecast.per_series(h, f, lambda t, n: [float(len(t))] * n).collect()] == [6.0, 6.0]
    assert sorted(r.ypred for r in forecast.seasonal_naive(h, f, 2).collect()) == [5.0, 9.0]


def test_global_follows_the_members_of_each_origin(spark, cal):
    rows = frame(spark, {1: [1] * 8, 2: [10] * 8, 3: [100] * 8, 4: [1000] * 8}).where(f"NOT (unique_id = 3 AND ds = date'{week(1)}')")
    rows = rows.union(spark.createDataFrame([(3, week(1), None)], "unique_id long, ds date, y double"))
    at = {5: [1, 2], 6: [1], 7: [1, 2, 3], 9: [4], 10: [1, 2]}  # a member that goes and comes back, one with a gap, an origin of one alone
    members = spark.createDataFrame([(week(o), i) for o, ids in at.items() for i in ids], "forecast_origin_date date, unique_id long")
    assert sorted((r.unique_id, r.first, r.last) for r in monitor.member_runs(members).collect()) == [(1, 0, 2), (1, 4, 4), (2, 0, 0), (2, 2, 2), (2, 4, 4), (3, 2, 2), (4, 3, 3)]
    weekly = {(r.forecast_origin_date, r.ds): r.y for r in monitor.weekly_sum(rows, members).collect()}
    size = {1: 1, 2: 10, 3: 100, 4: 1000}
    assert len(weekly) == 5 * 8 and all(weekly[week(o), week(k)] == (None if 3 in ids and k == 1 else sum(size[i] for i in ids)) for o, ids in at.items() for k in range(8))
    monthly = {(r.forecast_origin_date, r.fiscal_year_month): (r.status, r.total) for r in monitor.global_monthly(monitor.monthly_status(rows, cal), members).collect()}
    assert monthly[week(7), 202501] == ("gapped", None) and monthly[week(7), 202502] == ("complete", 444.0) and monthly[week(6), 202501] == ("complete", 4.0) and monthly[week(9), 202502] == ("complete", 4000.0)


def test_facets_hold_the_origins_own_folds(spark, cal):
    rows = frame(spark, {1: [1] * 8, 2: [10] * 8})
    folds = [(week(5), 202502, 1, "horizon_1", 7.0, 8.0), (week(5), 202502, 2, "horizon_1", 70.0, 80.0), (week(6), 202502, 1, "horizon_1", 9.0, 9.5)]
    comparison = spark.createDataFrame(folds, "forecast_origin_date date, predicted_fiscal_year_month int, unique_id long, horizon string, fc double, fb double")
    ahead = [("m", week(o), i, week(k), 10.0 * i) for o in (5, 6) for i in (1, 2) for k in range(o + 1, 8)]
    forecasts = spark.createDataFrame(ahead, "model string, forecast_origin_date date, unique_id long, ds date, ypred double")
    lines = monitor.facets(rows, monitor.monthly_status(rows, cal), comparison, forecasts, cal)
    of = lambda name, o, grain: {(r.line, r.ds): r.y for r in monitor.facet(lines, name, F.lit(week(o)), grain).collect()}
    assert of("global", 5, "month") == {("actual", week(3)): 44.0, ("actual", week(7)): 44.0, ("challenger", week(7)): 77.0, ("benchmark", week(7)): 88.0}
    assert of("global", 6, "month") == {("actual", week(3)): 4.0, ("actual", week(7)): 4.0, ("challenger", week(7)): 9.0, ("benchmark", week(7)): 9.5}
    assert of("global", 6, "week") == {**{("actual", week(k)): 1.0 for k in range(8)}, ("m", week(7)): 10.0}
    assert of("2", 6, "week") == {("actual", week(k)): 10.0 for k in range(8)}  # no fold there: history and no forecast
    assert of("2", 5, "week") == {**{("actual", week(k)): 10.0 for k in range(8)}, ("m", week(6)): 20.0, ("m", week(7)): 20.0}


def test_progress_refuses_lost_folds(spark, cal, scored):
    spine = spark.createDataFrame([(202502, week(0), 2, 4), (202502, week(1), 3, 4)], "target_month int, forecast_origin_date date, weeks_actualized int, weeks_in_month int")
    got = {(r.weeks_in_month, r.weeks_actualized): (r.value, r.n_events) for r in metrics.by_progress(scored, spine).collect()}
    assert got == {(4, 2): (12 / 30, 2), (4, 3): (6 / 18, 2)}
    for wrong in (spine.where("weeks_actualized = 2"), spine.union(spine)):
        with pytest.raises(gates.GateError):
            metrics.by_progress(scored, wrong)


def test_scans_see_committed_runs_alone(spark, tmp_path):
    root = str(tmp_path)
    files.write_run({"t": spark.range(3), "u": spark.range(1)}, root, "r1", "a")
    files.write_run({"t": spark.range(4)}, root, "r1", "b")
    spark.range(50).write.parquet(f"{root}/t/run_id=r2/model=a")  # cut off before its manifest
    spark.range(60).write.parquet(f"{root}/t/run_id=r1/model=c")
    rows = files.scan_runs(spark, root, "t")
    assert {(r.run_id, r.model): r["count"] for r in rows.groupBy("run_id", "model").count().collect()} == {("r1", "a"): 3, ("r1", "b"): 4}
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString().lower()
    assert [r.run_id for r in files.completed_runs(spark, root).collect()] == ["r1"] and files.read_committed(spark, root, "t", "r1").count() == 7
    spark.range(1).write.mode("append").parquet(f"{root}/t/run_id=r1/model=b")
    for run in ("r1", "r2"):
        with pytest.raises(ValueError, match=run):
            files.read_committed(spark, root, "t", run)


def test_forecasters_with_regressors_and_hyper_parameters(spark, cal):
    o = spark.createDataFrame([(week(5), 6, 2), (week(4), 5, 1)], "forecast_origin_date date, origin_week int, horizon int")
    rows = frame(spark, {1: [5, 10, 5, 10, 5, 9, 100], 2: [1] * 7})
    days = spark.createDataFrame([(week(k), 5 if k % 2 else 2) for k in range(16)], "ds date, count_workdays int")
    h, f = forecast.history(rows, o, cal), forecast.future_weeks(rows, o, cal)
    got = {(r.forecast_origin_date, r.unique_id, r.ds): r.ypred for r in forecast.per_series(h, f, forecast.workday_rate, days, {"weeks": 4}).collect()}
    assert got[week(5), 1, week(6)] == 29 / 14 * 2 and got[week(5), 1, week(7)] == 29 / 14 * 5 and got[week(4), 1, week(5)] == 30 / 14 * 5 and len(got) == 6
    fitted = {(r.forecast_origin_date, r.unique_id, r.ds): r.fitted for r in forecast.per_series_fitted(h, f, forecast.workday_rate, days, {"weeks": 2}).collect()}
    assert fitted == {(week(a), i, week(k)): v / 7 * (5 if k % 2 else 2) for a in (5, 4) for i, v in ((1, 14 if a == 5 else 15), (2, 2)) for k in (a - 1, a)}
    own = days.crossJoin(spark.createDataFrame([(1,), (2,)], "unique_id long")).withColumn("count_workdays", F.col("count_workdays") * F.col("unique_id"))
    by_series = forecast.per_series(h, f, forecast.workday_rate, own, {"weeks": 4})
    assert {(r.forecast_origin_date, r.unique_id, r.ds): round(r.ypred, 9) for r in by_series.collect()} == {k: round(v, 9) for k, v in got.items()}
    with pytest.raises(TypeError, match="week"):
        forecast.per_series(h, f, forecast.workday_rate, days, {"week": 4})


# -- metrics --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def scored(spark):
    rows = []
    for k, (ca, cb, ba, bb) in enumerate([(44, 168, 50, 180), (42, 164, 46, 172)]):
        for i, a, c, b, t in ((1, 40, ca, ba, "low"), (2, 160, cb, bb, "high")):
            rows.append((week(k), 202502, i, "horizon_1", t, 0, 1.0, float(a), float(c), float(b), 0.5))
    return spark.createDataFrame(rows, "forecast_origin_date date, predicted_fiscal_year_month int, unique_id long, horizon string, tier string, tier_rank int, w double, a double, fc double, fb double, origin_month_fraction_elapsed double")


def value(df):
    return df.first().value


def test_fold_metrics(scored):
    # the folds' errors: 12 against 30, then 6 against 18, on actuals of 40 and 160
    want = {"wrmae_pooled": (12 / 30 + 6 / 18) / 2, "wrmae_per_series": (0.4 + 1 / 3) / 2, "wape": 0.045, "signed_bias_pooled": 0.045, "signed_bias_per_series": 0.05625, "weighted_signed_bias": 0.045}
    for m, v in want.items():
        assert abs(value(metrics.overall(scored, m)) - v) < 1e-12, m


def test_horizon_shares_name_the_tiers_held(scored):
    later = scored.where("unique_id = 1").withColumns({"tier": F.lit("middle"), "tier_rank": F.lit(2), "forecast_origin_date": F.lit(week(9))})
    first = scored.where("unique_id = 1").limit(1).withColumns({"tier": F.lit("very_low"), "tier_rank": F.lit(-1), "forecast_origin_date": F.lit(week(8))})
    got = {r.unique_id: r for r in metrics.horizon_shares(scored.unionByName(later.limit(1)).unionByName(first)).collect()}
    assert got[1].tier == "middle" and got[1].label == "middle at last origin (very_low in 1 of 4 folds; low in 2 of 4 folds)" and got[2].label == "high"
    assert all(abs(r.net - (r.y - r.x)) < 1e-12 for r in got.values()) and abs(sum(r.x for r in got.values()) - 1) < 1e-10


def test_base_frame_and_leaderboard(spark):
    row = lambda m, i, fc, tier="low", w=1.0, a=10.0: (m, week(0), 202502, i, tier, 1, fc, a, w, 0.5, "horizon_1", 0.0)
    schema = "model string, forecast_origin_date date, predicted_fiscal_year_month int, unique_id long, tier string, tier_rank int, monthly_forecast double, actual_monthly_total double, series_weight double, origin_month_fraction_elapsed double, horizon string, mtd_revenue double"
    c = spark.createDataFrame([row("c", 1, 11.0), row("c", 2, 12.0), row("c", 3, 13.0)], schema)
    b = spark.createDataFrame([row("b", 1, 14.0), row("b", 2, 9.0, "high", 2.0), row("b", 4, 9.0)], schema)
    got = {r.unique_id: (r._merge, r.differs) for r in metrics.base_frame(c, b).collect()}
    assert got == {1: ("both", []), 2: ("both", ["tier", "series_weight"]), 3: ("left_only", []), 4: ("right_only", [])}
    board = metrics.leaderboard(c.union(b).union(c.withColumn("model", F.lit("d")).withColumn("monthly_forecast", F.lit(10.0))), "b")
    at = {(r.grain, r.model, r.tier): r.value for r in board.where("metric = 'wrmae_pooled'").collect()}
    assert at["summary", "b", "global"] == 1.0 and at["fold", "d", "global"] == 0.0 and at["period", "c", "global"] == (1 + 2) / (4 + 1)


def test_shares_add_up(scored):
    got = metrics.shares(scored).agg(F.sum("x"), F.sum("y")).first()
    assert abs(got[0] - 1) < 1e-10 and abs(got[1] - value(metrics.overall(scored, "wrmae_pooled"))) < 1e-10


def test_scores_have_empty_slices_and_a_benchmark_of_one(scored):
    s = metrics.fold_scores(metrics.both_models(scored.where("NOT (tier = 'high' AND fc = 164)"), "c", "b"))
    empty = s.where("tier = 'high' AND value IS NULL")
    assert empty.count() == 12 and empty.where("n_obs = 0").count() == 12
    self_score = s.where("model = 'b' AND metric IN ('wrmae_pooled', 'wrmae_per_series') AND value IS NOT NULL")
    assert {round(r.value, 12) for r in self_score.collect()} == {1.0}
    summary = metrics.summary_scores(s).where("model = 'c' AND tier = 'global' AND metric = 'wape'").first()
    assert summary.n_folds == 2


def test_undefined_is_null_not_zero(scored):
    none = scored.withColumn("w", F.lit(0.0))
    assert value(metrics.overall(none, "wrmae_pooled")) is None and value(metrics.overall(none, "wrmae_per_series")) is None
    with pytest.raises(ValueError, match="unknown metric"):
        metrics.hero(scored, "mape", "horizon_1")


def test_parsimony(spark):
    def pick(scores, at=10, window=3):
        rows = [(0, at * (k + 1), float(v)) for k, v in enumerate(scores)]
        return forecast.parsimonious(spark.createDataFrame(rows, "g int, rounds int, score double"), ["g"], window).first()

    assert pick([7, 4, 3, 3.5, 6, 9]).rounds == 30  # smoothed over neighbours
    assert pick([2.0] * 5).rounds == 10 and not pick([2.0] * 5).inconclusive
    assert pick([9, 8, 7, 6, 5, 3]).rounds == 60 and pick([9, 8, 7, 6, 5, 3]).inconclusive
    assert pick([7, 4, 3.02, 3, 6], window=1).rounds == 30


def test_calibration_scores_by_the_given_function(spark):
    rows = spark.createDataFrame([(week(0), "horizon_1", k, 10.0, 10.0 + e, w) for k, e, w in ((2, 4.0, 1.0), (2, -1.0, 3.0), (4, 2.0, 0.0), (4, 5.0, 0.0))], "forecast_origin_date date, horizon string, rounds int, actual_monthly_total double, monthly_forecast double, series_weight double")
    assert {r.rounds: r.score for r in forecast.rounds_curve(rows).collect()} == {2: 7 / 4, 4: None}
    assert {r.rounds: r.score for r in forecast.rounds_curve(rows, lambda a, f, w: F.max(F.abs(f - a))).collect()} == {2: 4.0, 4: 5.0}


# -- modelling table and gates ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def modelling(spark, cal):
    rows = frame(spark, {11: [7.0 * k for k in range(1, 9)], 23: [k * k for k in range(1, 9)]})
    totals = panel.monthly_totals(rows, cal)
    pairs = totals.select("unique_id", "fiscal_year_month")
    spine = origins.spine(cal)
    table = features.attach_mtd(features.origin_series_grid(spine, totals, pairs), rows, cal)
    return rows, table, spine


def test_mtd_of_the_gate_fixture(modelling):
    _, table, _ = modelling
    got = {(r.unique_id, r.weeks_actualized): (r.mtd_revenue, r.actual_monthly_total) for r in table.where("target_month = 202502").collect()}
    assert [got[11, k][0] for k in range(4)] == [0, 35, 77, 126] and [got[23, k][0] for k in range(4)] == [0, 25, 61, 110]
    assert got[11, 0][1] == 182 and got[23, 0][1] == 174


def test_gates_see_one_unit_in_amounts_of_billions(spark, cal):
    rows = frame(spark, {11: [7e9 * k + 0.07 for k in range(1, 9)]})
    totals = panel.monthly_totals(rows, cal)
    table = features.attach_mtd(features.origin_series_grid(origins.spine(cal), totals, totals.select("unique_id", "fiscal_year_month")), rows, cal)
    left, plus = features.remaining_target(table), lambda df, c: df.withColumn(c, F.col(c) + 1)
    bad = lambda df: df.where("NOT ok").count()
    n = table.count()
    assert n == 4
    assert (bad(gates.mtd_increments(table, rows, cal)), bad(gates.total_reconciliation(table, rows, cal)), bad(gates.remaining_identity(left, rows, cal))) == (0, 0, 0)
    assert bad(gates.total_reconciliation(plus(table, "actual_monthly_total"), rows, cal)) == 1
    assert bad(gates.remaining_identity(plus(left, "remaining_target"), rows, cal)) == n
    late = table.withColumn("mtd_revenue", F.col("mtd_revenue") + F.when(F.col("weeks_actualized") == 2, 1).otherwise(0))
    assert bad(gates.mtd_increments(late, rows, cal)) == 2
    lost = left.withColumn("remaining_target", F.lit(None).cast("double"))
    assert bad(gates.remaining_identity(lost, rows, cal)) == n


def test_gates_pass_and_fail(spark, cal, modelling):
    rows, table, _ = modelling
    totals = panel.monthly_totals(rows, cal)
    assert gates.week_zero_coverage(table, totals).count() == 0 and gates.week_zero_coverage(table.where("weeks_actualized > 0"), totals).count() == 2
    assert gates.mtd_increments(table.where("weeks_actualized <> 1"), rows, cal).where("NOT ok").count() == 2 * 1
    ok = lambda df: df.where("NOT ok").count() == 0 and df.count() > 0
    assert ok(gates.mtd_increments(table, rows, cal)) and ok(gates.total_reconciliation(table, rows, cal))
    assert ok(gates.remaining_identity(features.remaining_target(table), rows, cal))
    wrong = table.withColumn("mtd_revenue", F.when((F.col("unique_id") == 11) & (F.col("weeks_actualized") == 2), F.col("mtd_revenue") + 1).otherwise(F.col("mtd_revenue")))
    assert not ok(gates.mtd_increments(wrong, rows, cal))
    assert not ok(gates.total_reconciliation(table.withColumn("actual_monthly_total", F.col("actual_monthly_total") + 1), rows, cal))
    feats = features.weekly_features(rows, [1, 2])
    assert gates.lag_alignment(feats, rows, 2).count() == 0
    assert gates.lag_alignment(feats.withColumn("lag1", F.col("lag2")), rows, 1).count() > 0
    with pytest.raises(gates.GateError):
        gates.enforce(gates.unique_keys(rows.union(rows), ["unique_id", "ds"]), "keys")
    assert not gates.check("none", rows.where("false"), F.lit(False)).first().ok


def test_leakage_gate_sees_a_leak(spark, modelling):
    rows, _, _ = modelling
    clean = lambda p: features.weekly_features(p, [1]).select("unique_id", "ds", "lag1")
    leaky = lambda p: features.weekly_features(p, [-1]).select("unique_id", "ds", F.col("lag-1").alias("lag1"))
    run = lambda f: gates.leakage(rows, f, ["unique_id", "ds"], ["lag1"], "ds", F.lit(week(4))).first()
    assert run(clean).changed_before == 0 and run(clean).changed_after > 0
    assert run(leaky).changed_before > 0
    made = clean(rows)
    assert gates.feature_partition(made, ["unique_id", "ds"], {"y": ["lag1"]}) == [] and gates.feature_partition(made, ["unique_id", "ds"], {"y": [], "calendar": ["workdays"]}) == ["lag1", "workdays"]


def test_lineage_parity_merge(spark, modelling):
    rows, _, _ = modelling
    stamped = files.with_lineage(rows, "r1")
    assert gates.single_lineage(stamped, expected="r1").count() == 0
    assert gates.single_lineage(stamped.union(files.with_lineage(rows, "r2"))).count() == 1
    assert gates.parity(rows, rows.withColumn("y", F.col("y") + (F.col("unique_id") == 11).cast("int")), ["unique_id", "ds"], [], ["y"]).count() == 8
    a = rows.withColumnRenamed("ds", "forecast_origin_date")
    with pytest.raises(gates.GateError, match="overlap"):
        gates.merge_parts(a, a)
    with pytest.raises(ValueError, match="more than one role"):
        features.ColumnRoles(("a",), ("a",), "t")


# -- profile --------------------------------------------------------------------------------------


def test_rank_buckets_differ_from_ntile(spark):
    rows = spark.createDataFrame([(k, float(k)) for k in range(1, 8)], "unique_id long, total double")
    got = [r.bucket for r in profile.first_rank_buckets(rows, "total").orderBy("unique_id").collect()]
    assert got == [max(1, math.ceil(5 * (k - 1) / 6)) for k in range(1, 8)]


def test_autocorrelation_of_an_alternating_series(spark):
    acf = profile.autocorrelation(frame(spark, {1: [1, -1] * 4, 2: [3] * 8}), 2)
    got = {(r.unique_id, r.lag): r.acf for r in acf.collect()}
    assert abs(got[1, 1] + 7 / 8) < 1e-12 and got[2, 1] is None
    pacf = {(r.unique_id, r.lag): r.pacf for r in profile.partial_autocorrelation(acf).collect()}
    assert pacf[1, 0] == 1.0 and abs(pacf[1, 1] + 7 / 8) < 1e-12


def test_partial_autocorrelation_solves_the_normal_equations(spark):
    r = [1.0, 0.6, 0.1, -0.3, 0.2]
    acf = spark.createDataFrame([(1, k, v) for k, v in enumerate(r)], "unique_id long, lag int, acf double")
    got = {x.lag: x.pacf for x in profile.partial_autocorrelation(acf).collect()}
    import numpy as np

    for k in range(1, 5):
        want = np.linalg.solve([[r[abs(i - j)] for j in range(k)] for i in range(k)], r[1 : k + 1])[-1]
        assert abs(got[k] - want) < 1e-12


def test_global_ranks_over_many_parts(spark):
    rows = spark.createDataFrame([(k, float((k * 37) % 50)) for k in range(300)], "unique_id long, total double").repartition(7)
    got = {x.unique_id: x.rank_total for x in profile.ranks(rows, ["total"]).collect()}
    values = {k: (k * 37) % 50 for k in range(300)}
    assert all(got[k] == 1 + sum(o > v for o in values.values()) for k, v in values.items())
    curve = sorted((x.position, x.cumulative_share) for x in profile.concentration(rows, "total").collect())
    order = sorted(values.values(), reverse=True)
    assert [p for p, _ in curve] == list(range(1, 301)) and all(abs(s - sum(order[:p]) / sum(order)) < 1e-12 for p, s in curve)


@pytest.mark.parametrize("by", [["g"], []])
def test_quantiles_of_groups_in_many_parts(spark, by):
    import numpy as np

    r = np.random.default_rng(4)
    values = [("big", float(v)) for v in r.integers(0, 400, 3000) / 8] + [("small", 2.5), ("two", 1.0), ("two", 2.0), ("same", 7.0), ("same", 7.0)] + [("big", None)]
    rows = spark.createDataFrame(values, "g string, v double").repartition(9)
    at = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = {tuple(x[c] for c in by): (x.n, x.q) for x in profile.exact_quantiles(rows, by, "v", at).collect()}
    groups: dict = {}
    for g, v in values:
        groups.setdefault((g,) if by else (), []).extend([] if v is None else [v])
    assert got.keys() == groups.keys() and all(n == len(groups[k]) and np.allclose(q, np.quantile(groups[k], at)) for k, (n, q) in got.items())
    near = {tuple(x[c] for c in by): x.q for x in profile.group_quantiles(rows, by, "v", at, exact=False).collect()}
    assert all(np.abs(np.searchsorted(np.sort(groups[k]), q) - np.array(at) * len(groups[k])).max() <= 15 for k, q in near.items())


def test_guerrero_lambda(spark):
    import numpy as np

    r = np.random.default_rng(6)
    base = np.repeat(np.array([1.0, 4, 2, 9, 3, 7]), 5)
    shape = {1: base + 0.1 * np.tile([1, -1, 2, -2, 0], 6), 2: base * (1 + 0.1 * np.tile([1, -1, 2, -2, 0], 6)), 3: r.random(33) + 1, 4: np.zeros(20), 5: np.ones(7)}
    grid = [-1.0, 0.0, 0.5, 1.0, 2.0]
    got = {x.unique_id: (x.power, x.variation) for x in profile.guerrero_lambda(frame(spark, {i: list(v) for i, v in shape.items()}), grid, 5).collect()}
    assert got[1][0] == 1.0 and got[2][0] == 0.0 and 4 not in got and 5 not in got
    for i in (1, 2, 3):
        x = shape[i][len(shape[i]) % 5 :].reshape(-1, 5)
        ratio = {g: x.std(axis=1, ddof=1) / x.mean(axis=1) ** (1 - g) for g in grid}
        want = {g: v.std() / v.mean() for g, v in ratio.items()}
        assert abs(got[i][1] - min(want.values())) < 1e-12 and want[got[i][0]] == pytest.approx(min(want.values()))


def test_shared_folder_is_an_error_on_a_cluster(spark):
    from types import SimpleNamespace

    from panelmill import session

    conf = SimpleNamespace(get=lambda k, d=None: d)
    with pytest.raises(RuntimeError, match="checkpoint"):
        session.shared_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn")))
    table = session.written(spark.range(3), "short-lived")
    assert table.count() == 3
    session.spent(table)
    import os

    assert not os.path.exists(table.written_path.removeprefix("file://"))


def test_results_do_not_depend_on_partitioning(spark, cal):
    rows = frame(spark, {i: [i * k % 7 for k in range(8)] for i in range(1, 9)})
    a, b = (panel.monthly_totals(r, cal) for r in (rows.repartition(5), rows.coalesce(1)))
    assert gates.same_rows(a, b).first() == (0, 0)
