"""Queries: sources and sinks (A), row operators (B), joins of facts (C), daily aggregates (D), date functions (H)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelmill.functions import calendar as C
from panelmill.operators import panel as P
from panelmill.operators import profile as PR
from panelmill.operators import trips as T
from panelmill.plans import example as X
from panelmill.plans.catalog import query
from panelmill.session import read, shared_dir, written
from panelmill.sources import files as S


def _dir(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


TRIP = "order_id, line, vendor_id, pu_zone, do_zone, pickup_ts, dropoff_ts, trip_distance, fare_amount, total_amount"


@query("a1_trip_ingest", f"SELECT {TRIP}, CASE WHEN order_id % 2 = 0 THEN total_amount END AS congestion_fee, CASE WHEN order_id % 2 = 0 THEN 'new' ELSE 'old' END AS era FROM trips")
def a1(spark, sf):
    rows, root = X.raw_trips(spark, sf).drop("sourcefile_name"), _dir(spark, "trips")
    new = rows.where("order_id % 2 = 0").withColumn("Congestion_Fee", F.col("total_amount"))
    new.toDF(*[c.upper() for c in new.columns]).write.parquet(f"{root}/era=new")
    rows.where("order_id % 2 <> 0").write.parquet(f"{root}/era=old")
    got = S.ingest_trip_files(spark, [root])
    return got.withColumn("era", F.regexp_extract("sourcefile_path", "era=(\\w+)", 1)).drop("sourcefile_path", "load_timestamp_utc")


@query("a2_zone_csv", "SELECT zone_id, zone, borough FROM zones")
def a2(spark, sf):
    root = _dir(spark, "zones")
    X.zones(spark, sf).write.csv(root, header=True)
    return S.read_zones(spark, root).drop("load_timestamp_utc")


@query("a3_truncate_load", "SELECT pu_zone, pickup_date, count(trip_id) AS n FROM clean GROUP BY ALL")
def a3(spark, sf):
    root, daily = _dir(spark, "daily"), T.daily_counts(X.clean_trips(spark, sf))
    S.truncate_and_load(daily.withColumn("n", F.lit(0).cast("long")), root, ["pu_zone"])
    S.truncate_and_load(daily, root, ["pu_zone"])
    return spark.read.parquet(root)


A4 = "SELECT pu_zone, count(*) AS n FROM panelmill_clean WHERE pickup_date >= CAST(:since AS DATE) GROUP BY pu_zone"


@query("a4_extract", "SELECT pu_zone, count(*) AS n FROM clean WHERE pickup_date >= DATE '1998-01-01' GROUP BY ALL")
def a4(spark, sf):
    X.clean_trips(spark, sf).createOrReplaceTempView("panelmill_clean")
    return S.extract(spark, A4, {"since": "1998-01-01"}, _dir(spark, "extract")).drop("query_sha256")


@query("a4_extract_metadata", f"SELECT sha256('{A4}' || '[(''since'', ''1998-01-01'')]') AS query_sha256, count(DISTINCT pu_zone) AS n_rows FROM clean WHERE pickup_date >= DATE '1998-01-01'")
def a4_metadata(spark, sf):
    X.clean_trips(spark, sf).createOrReplaceTempView("panelmill_clean")
    path = _dir(spark, "extract")
    S.extract(spark, A4, {"since": "1998-01-01"}, path)
    return S.extract_metadata(spark, path)


A5 = "SELECT o_orderpriority AS priority, count(*) AS n FROM panelmill_orders WHERE o_totalprice > :least GROUP BY o_orderpriority"


@query("a5_prepared_sql", f"SELECT o_orderpriority AS priority, count(*) AS n, sha256('{A5}' || '[(''least'', 50000.0)]') AS digest FROM orders WHERE o_totalprice > 50000 GROUP BY ALL")
def a5(spark, sf):
    read(spark, sf, "orders").createOrReplaceTempView("panelmill_orders")
    params = {"least": 50000.0}
    text, digest = S.prepare_sql(A5, params)
    return spark.sql(text, args=params).withColumn("digest", F.lit(digest))


@query("a6_clustered_layout", "SELECT CAST(year(pickup_date) AS INTEGER) AS pickup_year, count(*) AS n, min(pickup_date) AS first_date, max(pickup_date) AS last_date FROM silver GROUP BY 1")
def a6(spark, sf):
    root = _dir(spark, "silver")
    rows = T.date_sanity(X.raw_trips(spark, sf)).withColumn("pickup_year", F.year("pickup_date"))
    S.clustered(rows, "pickup_date", ["pu_zone", "do_zone", "pickup_ts"]).write.partitionBy("pickup_year").parquet(root)
    return spark.read.parquet(root).groupBy("pickup_year").agg(F.count("*").alias("n"), F.min("pickup_date").alias("first_date"), F.max("pickup_date").alias("last_date"))


@query("a7_panel_publish", "SELECT 'run-1' AS feature_run_id, count(*) AS n_rows, count(DISTINCT unique_id) AS n_series, min(ds) AS first_ds, max(ds) AS last_ds FROM panel")
def a7(spark, sf):
    return S.publish_summary(S.with_lineage(X.weekly_panel(spark, sf), "run-1"))


@query(
    "a8_backtest_sink",
    """SELECT 'r1' AS run_id, 'recent_mean' AS model, table_name, n_rows FROM (
  SELECT 'monthly_series' AS table_name, count(*) AS n_rows FROM ms WHERE model = 'recent_mean' UNION ALL SELECT 'monthly_forecast_components', count(*) FROM components WHERE model = 'recent_mean'
  UNION ALL SELECT 'raw_cv_forecasts', count(*) FROM forecasts WHERE model = 'recent_mean' UNION ALL SELECT 'metrics', count(*) FROM (SELECT DISTINCT forecast_origin_date, predicted_fiscal_year_month FROM ms WHERE model = 'recent_mean')
  UNION ALL SELECT 'fiscal_calendar', count(*) FROM cal UNION ALL SELECT 'time_series_snapshot', count(*) FROM panel
  UNION ALL SELECT 'additional_exog', count(*) FROM (SELECT unique_id, min(ds) AS a FROM panel GROUP BY 1) p JOIN cal ON cal.ds >= p.a)""",
)
def a8(spark, sf):
    """Four outputs and three snapshots of a model's run; the manifest comes last."""
    from panelmill.operators import features as FE
    from panelmill.operators import metrics as M
    from panelmill.operators import origins as O

    root, study = _dir(spark, "runs"), X.Study.of(spark, sf)
    of = lambda df: df.where("model = 'recent_mean'").drop("model")
    folds = O.fold_ids(study.origins).groupBy("forecast_origin_date").agg(F.min("fold_id").cast("string").alias("fold_id"))
    raw = of(study.forecasts).join(F.broadcast(folds), "forecast_origin_date").select("forecast_origin_date", "unique_id", "ds", "ypred", "fold_id")
    frames = {"monthly_series": of(study.series), "monthly_forecast_components": of(study.components), "metrics": M.fold_values(M.against_benchmark(study.series, "naive").where("model = 'recent_mean'"), []), "raw_cv_forecasts": raw}
    frames |= {"fiscal_calendar": study.calendar, "time_series_snapshot": study.panel, "additional_exog": FE.additional_exogenous(study.panel, study.calendar)}
    S.write_run(frames, root, "r1", "recent_mean")
    return spark.read.parquet(f"{root}/manifest")


@query("a10_lineage", "SELECT unique_id, ds, y, 'r' AS run_id, 'f' AS feature_run_id, 'c' AS challenger_model, 'b' AS benchmark_model, 'g' AS git_commit, 'h' AS config_hash FROM panel")
def a10(spark, sf):
    return S.stamp_lineage(X.weekly_panel(spark, sf), dict(zip(S.LINEAGE, "rfcbgh")))


@query("a11_leaderboard_scan", "SELECT 'r1' AS run_id, model, count(*) AS n FROM ms GROUP BY model")
def a11(spark, sf):
    """A second run was cut off before its manifest: its rows stay out."""
    root, ms = _dir(spark, "runs"), X.monthly_series(spark, sf)
    for m in X.MODELS:
        S.write_run({"monthly_series": ms.where(F.col("model") == m).drop("model")}, root, "r1", m)
    ms.where("model = 'naive'").drop("model").write.parquet(f"{root}/monthly_series/run_id=r2/model=naive")
    return S.scan_runs(spark, root, "monthly_series").groupBy("run_id", "model").agg(F.count("*").alias("n"))


@query("a12_run_discovery", "SELECT 'r2' AS run_id FROM (SELECT count(*) AS n FROM panel) WHERE n > 0")
def a12(spark, sf):
    root = _dir(spark, "runs")
    rows = X.weekly_panel(spark, sf)
    for r in ("r1", "r2", "r3"):
        S.write_run({"panel": rows}, root, r, "m")
    return S.default_run(S.completed_runs(spark, root), "r2")


@query("a13_daily_stitch", "SELECT strftime(pickup_date, '%Y-%m') AS source_month, sum(n)::BIGINT AS n FROM (SELECT pu_zone, pickup_date, count(trip_id) AS n FROM clean GROUP BY ALL) GROUP BY 1")
def a13(spark, sf):
    root = _dir(spark, "aggregated")
    T.daily_counts(X.clean_trips(spark, sf)).withColumn("m", F.date_format("pickup_date", "yyyy-MM")).repartition("m").write.partitionBy("m").parquet(root)
    return S.stitch_daily(spark, [root]).groupBy("source_month").agg(F.sum("n").alias("n"))


@query("a14_daily_sink", "SELECT pickup_date, count(*) AS n FROM clean GROUP BY ALL")
def a14(spark, sf):
    root = _dir(spark, "daily-total")
    X.clean_trips(spark, sf).groupBy("pickup_date").agg(F.count("*").alias("n")).write.parquet(root)
    return spark.read.parquet(root)


KEY = "order_id, line, vendor_id, pickup_date, sourcefile_name"


@query("b1_date_sanity", f"SELECT {KEY} FROM silver")
def b1(spark, sf):
    return T.date_sanity(X.raw_trips(spark, sf)).select(*KEY.split(", "))


@query("b2_strict_date_sanity", "SELECT order_id, line, vendor_id, sourcefile_name FROM filed WHERE pickup_ts > file_month - INTERVAL 1 MONTH AND pickup_ts < file_month + INTERVAL 2 MONTH")
def b2(spark, sf):
    return T.strict_date_sanity(X.raw_trips(spark, sf)).select("order_id", "line", "vendor_id", "sourcefile_name")


@query("b2_rejected_rows", "SELECT sourcefile_name, count(*) AS n FROM filed WHERE NOT pickup_date BETWEEN CAST(file_month - INTERVAL 1 MONTH AS DATE) AND CAST(file_month + INTERVAL 2 MONTH AS DATE) GROUP BY ALL")
def b2_rejected(spark, sf):
    return T.date_sanity(X.raw_trips(spark, sf), keep=False).groupBy("sourcefile_name").agg(F.count("*").alias("n"))


HOUR = "CAST(date_trunc('hour', {} AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York') AT TIME ZONE 'America/New_York' AT TIME ZONE 'UTC' AS TIMESTAMP)"


@query(
    "b3_curated_trips",
    f"SELECT order_id, line, trip_id, vendor_id, pickup_ts, dropoff_ts, pu_zone AS pickup_zone_id, do_zone AS dropoff_zone_id, pickup_date, {HOUR.format('pickup_ts')} AS pickup_hour, dropoff_date, {HOUR.format('dropoff_ts')} AS dropoff_hour, file_month, epoch(dropoff_ts - pickup_ts) / 60 AS duration_minutes, epoch(pickup_ts - file_month) / 60 AS offset_minutes, fare_amount, total_amount, trip_distance, sourcefile_name FROM curated",
    r=("duration_minutes", "offset_minutes"),
)
def b3(spark, sf):
    return T.curated(X.silver_trips(spark, sf))


@query("b4_valid_fares", f"SELECT {KEY} FROM clean")
def b4(spark, sf):
    return X.clean_trips(spark, sf).select(*KEY.split(", "))


@query("b5_borough_trips", "SELECT zone, pickup_date, count(*) AS n FROM clean JOIN zones ON pu_zone = zone_id WHERE borough = 'AMERICA' GROUP BY ALL")
def b5(spark, sf):
    z = X.zones(spark, sf).where("borough = 'AMERICA'")
    return X.clean_trips(spark, sf).join(z, F.col("pu_zone") == F.col("zone_id")).groupBy("zone", "pickup_date").agg(F.count("*").alias("n"))


@query("b7_allowlist", "SELECT order_id, pickup_ts, total_amount FROM trips")
def b7(spark, sf):
    from panelmill.operators.gates import trim_to_allowlist

    return trim_to_allowlist(X.raw_trips(spark, sf), ["order_id", "pickup_ts"], ["total_amount", "not_there"], "trips")


@query("b11_melt", "SELECT order_id, line, vendor_id, metric, value FROM (SELECT order_id, line, vendor_id, fare_amount, total_amount FROM trips) UNPIVOT (value FOR metric IN (fare_amount, total_amount))")
def b11(spark, sf):
    return X.raw_trips(spark, sf).unpivot(["order_id", "line", "vendor_id"], ["fare_amount", "total_amount"], "metric", "value")


@query("b12_pivot", "SELECT pickup_date, " + ", ".join(f"sum(CASE WHEN pu_zone = {z} THEN 1 END)::BIGINT AS zone_{z}" for z in range(25)) + " FROM clean GROUP BY ALL")
def b12(spark, sf):
    zones = [r[0] for r in X.zones(spark, sf).select("zone_id").orderBy("zone_id").collect()]  # a dimension: 25 rows
    rows = X.clean_trips(spark, sf).groupBy("pickup_date").pivot("pu_zone", zones).agg(F.count("order_id"))
    return rows.toDF("pickup_date", *[f"zone_{z}" for z in zones])


@query(
    "b13_quality_shares",
    "SELECT avg((dropoff_ts <= pickup_ts)::INT) AS share_no_duration, avg((total_amount < 0)::INT) AS share_negative_total, avg((trip_distance <= 0)::INT) AS share_no_distance, avg((trip_distance = 0 AND fare_amount = 0)::INT) AS share_nothing, count(*) AS n FROM trips",
    r=("share_no_duration", "share_negative_total", "share_no_distance", "share_nothing"),
)
def b13(spark, sf):
    share = lambda c: F.avg(F.expr(c).cast("double"))
    return X.raw_trips(spark, sf).agg(share("dropoff_ts <= pickup_ts").alias("share_no_duration"), share("total_amount < 0").alias("share_negative_total"), share("trip_distance <= 0").alias("share_no_distance"), share("trip_distance = 0 AND fare_amount = 0").alias("share_nothing"), F.count("*").alias("n"))


@query("b14_durations", "SELECT vendor_id, avg(epoch(dropoff_ts - pickup_ts) / 60) AS mean_minutes, min(epoch(dropoff_ts - pickup_ts) / 60) AS least_minutes FROM trips GROUP BY ALL", r=("mean_minutes", "least_minutes"))
def b14(spark, sf):
    rows = T.curated(X.raw_trips(spark, sf))
    return rows.groupBy("vendor_id").agg(F.avg("duration_minutes").alias("mean_minutes"), F.min("duration_minutes").alias("least_minutes"))


@query("c1_trip_zone_join", "SELECT borough, zone, count(*) AS n FROM trips LEFT JOIN zones ON pu_zone = zone_id GROUP BY ALL")
def c1(spark, sf):
    return X.raw_trips(spark, sf).join(X.zones(spark, sf), F.col("pu_zone") == F.col("zone_id"), "left").groupBy("borough", "zone").agg(F.count("*").alias("n"))


@query("c2_zone_centroids", "SELECT z.*, c.balance FROM zones z LEFT JOIN (SELECT s_nationkey, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM supplier GROUP BY 1) c ON zone_id = s_nationkey")
def c2(spark, sf):
    extra = read(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("zone_id")).agg(P.money("s_acctbal").cast("double").alias("balance"))
    return X.zones(spark, sf).join(extra, "zone_id", "left")


DAILY = "SELECT pu_zone, pickup_date, count(trip_id) AS n FROM clean WHERE pickup_date <= (SELECT covered_end FROM covered) GROUP BY ALL"
SPINE = f"SELECT pu_zone, CAST(d AS DATE) AS pickup_date FROM (SELECT pu_zone, min(pickup_date) AS a FROM ({DAILY}) GROUP BY 1) s, covered, generate_series(a::TIMESTAMP, covered_end::TIMESTAMP, INTERVAL 1 DAY) g(d) WHERE a <= covered_end"
LAST = f"(SELECT max(pickup_date) FROM ({DAILY}))"
CUTOFF = f"""SELECT {LAST} AS last_date, CAST(CASE WHEN {LAST} = max(date) THEN fiscal_year_month
  ELSE CAST(strftime(make_date(fiscal_year_month // 100, fiscal_year_month % 100, 1) - INTERVAL 1 MONTH, '%Y%m') AS INTEGER) END AS INTEGER) AS cutoff_month
  FROM date_dim WHERE fiscal_year_month = (SELECT fiscal_year_month FROM date_dim WHERE date = {LAST}) GROUP BY fiscal_year_month"""


def _daily(spark, sf):
    facts = X.Study.of(spark, sf).daily_facts
    end = T.covered_end(facts)
    return T.daily_of(facts, end), end


@query("c3_calendar_spine", SPINE)
def c3(spark, sf):
    return T.zone_spine(*_daily(spark, sf))


@query("c4_zero_fill", f"SELECT s.pu_zone, s.pickup_date, coalesce(n, 0) AS n FROM ({SPINE}) s LEFT JOIN ({DAILY}) d ON s.pu_zone = d.pu_zone AND s.pickup_date = d.pickup_date")
def c4(spark, sf):
    daily, end = _daily(spark, sf)
    return T.zero_filled(daily, T.zone_spine(daily, end))


def _of_borough(sql: str) -> str:
    return sql.replace("FROM clean", "FROM clean JOIN zones ON pu_zone = zone_id AND borough = 'AMERICA'")


@query(
    "d4_daily_extract",
    f"""SELECT s.pu_zone, s.pickup_date, coalesce(n, 0) AS number_ride_pickups, d.day_of_fiscal_month, d.fiscal_week, d.fiscal_week_of_month, d.fiscal_month, d.fiscal_year, d.fiscal_year_month, d.day_of_week, d.day_name,
  d.is_weekend, d.is_holiday, d.holiday_name, d.is_dst, d.week_start AS fiscal_week_start_date, d.fiscal_year * 100 + d.fiscal_week AS fiscal_year_week
  FROM ({_of_borough(SPINE)}) s JOIN date_dim d ON d.date = s.pickup_date LEFT JOIN ({_of_borough(DAILY)}) n ON n.pu_zone = s.pu_zone AND n.pickup_date = s.pickup_date
  WHERE d.fiscal_year_month <= (SELECT cutoff_month FROM ({_of_borough(CUTOFF)}))""",
)
def d4_extract(spark, sf):
    z = X.zones(spark, sf).where("borough = 'AMERICA'").select("zone_id")
    daily, end = _daily(spark, sf)
    return T.daily_extract(daily.join(F.broadcast(z), F.col("pu_zone") == F.col("zone_id"), "left_semi"), end, X.dates(spark, sf))


@query("c5_zero_fill_union", f"SELECT z.pu_zone, t.pickup_date, coalesce(n, 0) AS n FROM (SELECT DISTINCT pu_zone FROM clean) z CROSS JOIN (SELECT DISTINCT pickup_date FROM clean) t LEFT JOIN ({DAILY}) d ON d.pu_zone = z.pu_zone AND d.pickup_date = t.pickup_date")
def c5(spark, sf):
    return T.zero_filled_by_union(_daily(spark, sf)[0])


@query("c6_scalar_cross_join", "SELECT count(*) AS n FROM clean, (SELECT max(pickup_date) AS m FROM clean) WHERE pickup_date >= m - INTERVAL 365 DAY")
def c6(spark, sf):
    rows = X.clean_trips(spark, sf)
    return rows.crossJoin(F.broadcast(rows.agg(F.max("pickup_date").alias("m")))).where(F.col("pickup_date") >= F.date_sub("m", 365)).agg(F.count("*").alias("n"))


@query("c7_daily_dates", f"SELECT d.pu_zone, d.pickup_date, d.n, x.fiscal_year_month, x.day_name, x.is_holiday FROM ({DAILY}) d JOIN date_dim x ON x.date = d.pickup_date")
def c7(spark, sf):
    dates = X.dates(spark, sf).select(F.col("date").alias("pickup_date"), "fiscal_year_month", "day_name", "is_holiday")
    return _daily(spark, sf)[0].join(F.broadcast(dates), "pickup_date")


@query("c26_nulls_by_vendor", "SELECT vendor_id, sum((do_zone IS NULL OR do_zone > 20)::INT)::BIGINT AS null_zone, sum((trip_distance = 0)::INT)::BIGINT AS null_distance, count(*) AS n FROM trips GROUP BY ALL")
def c26(spark, sf):
    rows = X.raw_trips(spark, sf).withColumns({"z": F.when(F.col("do_zone") <= 20, F.col("do_zone")), "t": F.nullif("trip_distance", F.lit(0.0))})
    return rows.groupBy("vendor_id").agg(F.count_if(F.col("z").isNull()).alias("null_zone"), F.count_if(F.col("t").isNull()).alias("null_distance"), F.count("*").alias("n"))


@query("d1_daily_counts", DAILY)
def d1(spark, sf):
    return _daily(spark, sf)[0]


@query("d2_first_active", f"SELECT pu_zone, min(pickup_date) AS first_date FROM ({DAILY}) GROUP BY ALL")
def d2(spark, sf):
    return _daily(spark, sf)[0].groupBy("pu_zone").agg(F.min("pickup_date").alias("first_date"))


@query("d3_covered_end", "SELECT covered_end FROM covered")
def d3(spark, sf):
    return _daily(spark, sf)[1]


@query("d4_month_cutoff", CUTOFF)
def d4(spark, sf):
    return T.month_cutoff(_daily(spark, sf)[0], X.dates(spark, sf))


@query("d5_complete_calendar", "SELECT date, fiscal_year_month FROM date_dim WHERE fiscal_year_month < (SELECT max(fiscal_year_month) FROM date_dim WHERE date <= (SELECT max(pickup_date) FROM clean))")
def d5(spark, sf):
    dates = X.dates(spark, sf).select("date", "fiscal_year_month")
    last = X.clean_trips(spark, sf).agg(F.max("pickup_date").alias("d"))
    month = dates.crossJoin(F.broadcast(last)).where("date <= d").agg(F.max("fiscal_year_month").alias("m"))
    return dates.crossJoin(F.broadcast(month)).where("fiscal_year_month < m").drop("m")


@query("d6_totals", f"SELECT 'day' AS grain, CAST(pickup_date AS VARCHAR) AS period, sum(n)::BIGINT AS n FROM ({DAILY}) GROUP BY ALL UNION ALL SELECT 'week', CAST(x.fiscal_year_week AS VARCHAR), sum(n)::BIGINT FROM ({DAILY}) JOIN date_dim x ON x.date = pickup_date GROUP BY ALL")
def d6(spark, sf):
    daily = _daily(spark, sf)[0].groupBy("pickup_date").agg(F.sum("n").alias("n"))
    dates = X.dates(spark, sf).select(F.col("date").alias("pickup_date"), "fiscal_year_week")
    weekly = daily.join(F.broadcast(dates), "pickup_date").groupBy("fiscal_year_week").agg(F.sum("n").alias("n"))
    return daily.select(F.lit("day").alias("grain"), F.col("pickup_date").cast("string").alias("period"), "n").unionByName(weekly.select(F.lit("week").alias("grain"), F.col("fiscal_year_week").cast("string").alias("period"), "n"))


ORDER_COLUMNS = {"o_orderkey": "", "o_custkey": "", "o_orderstatus": "", "o_totalprice": "", "o_orderdate": "", "o_orderpriority": ""}


@query("d25_null_counts", "SELECT column_name, nulls, n FROM (SELECT count(*) AS n, " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in ORDER_COLUMNS) + " FROM orders) UNPIVOT (nulls FOR column_name IN (" + ", ".join(ORDER_COLUMNS) + "))")
def d25(spark, sf):
    return PR.null_counts(read(spark, sf, "orders"))


@query(
    "d25_describe",
    "SELECT c AS column_name, count(v) AS n, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS least, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75, max(v) AS most FROM (SELECT c, v FROM (SELECT l_quantity, l_extendedprice, l_discount FROM lineitem) UNPIVOT (v FOR c IN (l_quantity, l_extendedprice, l_discount))) GROUP BY ALL",
    r=("mean", "std", "least", "q25", "q50", "q75", "most"),
)
def d25_describe(spark, sf):
    return PR.describe(read(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@query(
    "d26_trip_sketches",
    "SELECT strftime(pickup_date, '%Y-%m') AS month, count(*) AS n, true AS orders_within_error, true AS amounts_within_error FROM silver GROUP BY 1",
)
def d26_sketches(spark, sf):
    """Months from daily sketches that were stored and merged, held against the exact figures: distinct orders within 3 %, and quantiles of
    the amount within 2 % of the rank."""
    at = [0.1, 0.5, 0.9]
    month = F.date_format("pickup_date", "yyyy-MM").alias("month")
    trips = PR.first_in_group(X.silver_trips(spark, sf, bounded=True).select("pickup_date", month, "order_id", "total_amount"), "order_id", "month")
    trips = written(trips, "sketch-trips")  # the trips are joined once
    path = _dir(spark, "sketches")
    dealt = trips.repartition(max(spark.sparkContext.defaultParallelism, -(-trips.count() // X.TASK_TRIPS)), "order_id")
    PR.daily_sketches(dealt, "pickup_date", "order_id", "total_amount").write.parquet(path)
    merged = written(PR.sketch_figures(PR.merged_sketches(spark.read.parquet(path), month), at), "sketch-months")  # a row a month
    side = lambda k, test: F.count_if(test(F.col("total_amount"), F.get("q", F.lit(k))))
    exact = [F.count("*").alias("rows"), F.count_if("is_first").alias("orders"), F.count("total_amount").alias("amounts")]
    places = [*[side(k, lambda v, q: v < q).alias(f"below{k}") for k in range(3)], *[side(k, lambda v, q: v <= q).alias(f"upto{k}") for k in range(3)]]
    rows = trips.join(F.broadcast(merged.select("month", "q")), "month")
    both = merged.join(rows.groupBy("month").agg(*exact, *places), "month")
    near = lambda k, p: (F.col(f"below{k}") <= (p + 0.02) * F.col("amounts") + 1) & (F.col(f"upto{k}") >= (p - 0.02) * F.col("amounts") - 1)
    return both.select("month", F.when(F.col("n") == F.col("rows"), F.col("n")).alias("n"), (F.abs(F.col("distinct") - F.col("orders")) <= 0.03 * F.col("orders") + 1).alias("orders_within_error"), (near(0, 0.1) & near(1, 0.5) & near(2, 0.9)).alias("amounts_within_error"))


@query("d27_daily_from_clean", "SELECT pickup_date, pu_zone, count(*) AS n FROM filed WHERE pickup_ts > file_month - INTERVAL 1 MONTH AND pickup_ts < file_month + INTERVAL 2 MONTH AND NOT (fare_amount = 0 OR total_amount = 0) GROUP BY ALL")
def d27(spark, sf):
    rows = T.strict_date_sanity(X.raw_trips(spark, sf)).where("NOT (fare_amount = 0 OR total_amount = 0)")
    return T.daily_counts(rows.withColumn("pickup_date", F.to_date("pickup_ts")), measure=F.lit(1))


@query("e14_gaps", "SELECT user_id, ts, previous FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS previous FROM (SELECT DISTINCT user_id, date_trunc('hour', ts)::TIMESTAMP AS ts FROM events)) WHERE ts > previous + INTERVAL 1 DAY")
def e14(spark, sf):
    hours = read(spark, sf, "events").select("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).distinct()
    return T.gaps(hours, "user_id", "ts", "interval 1 day")


@query("weather_hourly_to_daily", "SELECT user_id AS station, CAST(ts AS DATE) AS date, CAST(avg(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS mean_value, min(value) AS least, max(value) AS most, count(DISTINCT date_trunc('hour', ts)) AS hours FROM events GROUP BY ALL", r=("mean_value",))
def weather(spark, sf):
    e = read(spark, sf, "events")
    return e.groupBy(F.col("user_id").alias("station"), F.to_date("ts").alias("date")).agg((F.sum(F.col("value").cast("decimal(18,4)")).cast("double") / F.count("value")).alias("mean_value"), F.min("value").alias("least"), F.max("value").alias("most"), F.countDistinct(F.date_trunc("hour", "ts")).alias("hours"))


@query("g2_distinct_files", "SELECT DISTINCT sourcefile_name, file_month FROM filed")
def g2(spark, sf):
    return X.raw_trips(spark, sf).select("sourcefile_name", T.file_month(F.col("sourcefile_name")).alias("file_month")).distinct()


@query("h1_file_month", "SELECT regexp_extract(sourcefile_name, '(\\d{4}-\\d{2})', 1) AS month, count(*) AS n FROM trips GROUP BY ALL")
def h1(spark, sf):
    return X.raw_trips(spark, sf).groupBy(F.regexp_extract("sourcefile_name", r"(\d{4}-\d{2})", 1).alias("month")).agg(F.count("*").alias("n"))


@query("h2_period_strings", "SELECT DISTINCT year || right('0' || month, 2) AS yyyymm, year * 100 + month AS number FROM date_dim")
def h2(spark, sf):
    d = X.dates(spark, sf)
    return d.select(F.concat(F.col("year"), F.lpad(F.col("month").cast("string"), 2, "0")).alias("yyyymm"), (F.col("year") * 100 + F.col("month")).alias("number")).distinct()


@query("h3_trip_ids", "SELECT trip_id, count(*) AS n FROM curated GROUP BY ALL")
def h3(spark, sf):
    return T.with_trip_columns(X.silver_trips(spark, sf)).groupBy("trip_id").agg(F.count("*").alias("n"))


@query("h4_local_hours", "SELECT CAST(t AS DATE) AS local_date, CAST(date_trunc('hour', t) AS TIMESTAMP) AS local_hour, count(*) AS n FROM (SELECT ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS t FROM events) GROUP BY ALL")
def h4(spark, sf):
    local = T.local(F.col("ts"), "America/New_York")
    return read(spark, sf, "events").groupBy(F.to_date(local).alias("local_date"), F.date_trunc("hour", local).cast("timestamp_ntz").alias("local_hour")).agg(F.count("*").alias("n"))


@query("h5_week_start", "SELECT day, ds, count(*) AS n FROM sales GROUP BY ALL")
def h5(spark, sf):
    return X.sales(spark, sf).groupBy("day", C.week_start(F.col("day")).alias("ds")).agg(F.count("*").alias("n"))


@query("h6_month_arithmetic", "SELECT DISTINCT day, CAST(date_trunc('month', day) AS DATE) AS first_day, last_day(day) AS last_day, CAST(date_trunc('month', day) + INTERVAL 2 MONTH AS DATE) AS later FROM sales")
def h6(spark, sf):
    first = F.trunc("day", "month")
    return X.sales(spark, sf).select("day", first.alias("first_day"), F.last_day("day").alias("last_day"), F.add_months(first, 2).alias("later")).distinct()


@query("h7_date_dimension", "SELECT date, week_start, fiscal_year, fiscal_week, fiscal_year_week, fiscal_month, fiscal_year_month, fiscal_week_of_month, day_of_fiscal_month, year, month, month_name, day, day_of_week, day_name, is_weekend, is_holiday, holiday_name, is_dst FROM date_dim")
def h7(spark, sf):
    return X.dates(spark, sf)


@query("h8_dst", "SELECT is_dst, min(date) AS first_date, count(*) AS n FROM date_dim GROUP BY ALL")
def h8(spark, sf):
    return X.dates(spark, sf).groupBy("is_dst").agg(F.min("date").alias("first_date"), F.count("*").alias("n"))


@query("h9_holiday_sales", "SELECT holiday_name, count(*) AS n FROM sales JOIN date_dim d ON d.date = sales.day WHERE d.is_holiday GROUP BY ALL")
def h9(spark, sf):
    return X.sales(spark, sf).join(F.broadcast(C.holiday_table(X.years(spark, sf))), F.col("day") == F.col("date")).groupBy("holiday_name").agg(F.count("*").alias("n"))


@query("h10_fiscal_months", "SELECT fiscal_year_month, count(*) AS weeks, min(ds) AS first_ds FROM cal GROUP BY ALL")
def h10(spark, sf):
    return X.calendar(spark, sf).groupBy("fiscal_year_month").agg(F.count("*").alias("weeks"), F.min("ds").alias("first_ds"))


#: The reference's years, long ones and first day; sales are moved by whole weeks into its years.
TABLE_YEARS, LONG_YEARS, FIRST_SUNDAY, MOVED_DAYS = range(2018, 2028), (2020, 2026), "2017-12-31", 7 * 1486
BY_TABLE = "(SELECT y AS fiscal_year, CAST(m AS INTEGER) AS fiscal_month, n, CAST(DATE '2017-12-31' + CAST(sum(n) OVER (ORDER BY y, m) - n AS INTEGER) AS DATE) AS first_date FROM (SELECT y, unnest(generate_series(1, 12)) AS m, unnest(l) AS n FROM (VALUES " + ", ".join(
    f"({y}, {[28, 28, 35, 28, 28, 35, 28, 28, 35, 28, 28, 42 if y in (2020, 2026) else 35]})" for y in range(2018, 2028)
) + ") t(y, l)))"


@query(
    "h10_calendar_by_table",
    f"""SELECT CAST(fiscal_year * 100 + fiscal_month AS INTEGER) AS fiscal_year_month, CAST(any_value(n) // 7 AS BIGINT) AS weeks, any_value(first_date) AS first_date, CAST(any_value(first_date) + any_value(n) - 1 AS DATE) AS last_date, count(day) AS n_sales, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS total
  FROM {BY_TABLE} c LEFT JOIN sales s ON s.day + {MOVED_DAYS} BETWEEN first_date AND first_date + n - 1 GROUP BY fiscal_year, fiscal_month""",
)
def h10_table(spark, sf):
    """All months of a calendar given as a table, with the sales of each."""
    dates = C.date_dimension(C.given_years(C.year_table(spark, TABLE_YEARS, LONG_YEARS), FIRST_SUNDAY)).select("date", "week_start", "fiscal_year_month")
    daily = X.sales(spark, sf).groupBy(F.date_add("day", MOVED_DAYS).alias("date")).agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
    return dates.join(daily, "date", "left").groupBy("fiscal_year_month").agg(F.countDistinct("week_start").alias("weeks"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_sales"), F.coalesce(F.sum("amount"), F.lit(0)).cast("double").alias("total"))


@query("h11_year_weeks", "SELECT fiscal_year_week, count(*) AS n FROM sales s JOIN cal c ON c.ds = s.ds GROUP BY ALL")
def h11(spark, sf):
    rows = X.sales(spark, sf).withColumn("ds", C.week_start(F.col("day")))
    return rows.join(F.broadcast(X.calendar(spark, sf)), "ds").groupBy("fiscal_year_week").agg(F.count("*").alias("n"))


@query("h12_harmonics", "SELECT DISTINCT day, sin(2 * pi() * dayofyear(day) / 365.25) AS week_sin, cos(2 * pi() * dayofyear(day) / 365.25) AS week_cos FROM sales", r=("week_sin", "week_cos"))
def h12(spark, sf):
    s, c = C.harmonics(F.col("day"))
    return X.sales(spark, sf).select("day").distinct().select("day", s.alias("week_sin"), c.alias("week_cos"))


@query("h13_dampening", "SELECT o_orderkey, cbrt(o_totalprice) AS by_cbrt, sqrt(o_totalprice) AS by_sqrt, ln(1 + o_totalprice) AS by_log FROM orders", r=("by_cbrt", "by_sqrt", "by_log"))
def h13(spark, sf):
    from panelmill.operators.rollup import DAMPENING

    p = F.col("o_totalprice")
    return read(spark, sf, "orders").select("o_orderkey", DAMPENING["cbrt"](p).alias("by_cbrt"), DAMPENING["sqrt"](p).alias("by_sqrt"), DAMPENING["log1p"](p).alias("by_log"))


@query("h15_clip_case", "SELECT l_orderkey, l_linenumber, l_partkey, greatest(l_quantity - 25, 0) AS clipped, abs(l_quantity - 25) AS off, CASE WHEN l_quantity > 25 THEN 'high' ELSE 'low' END AS side FROM lineitem")
def h15(spark, sf):
    d = F.col("l_quantity") - 25
    return read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.greatest(d, F.lit(0.0)).alias("clipped"), F.abs(d).alias("off"), F.when(d > 0, "high").otherwise("low").alias("side"))
