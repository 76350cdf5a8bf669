"""Common table expressions of the oracle SQL (DuckDB); a query only runs those that it reads."""

CTES = r"""
WITH trips AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, l_suppkey AS vendor_id, c_nationkey AS pu_zone, CASE WHEN l_orderkey % 41 = 7 THEN NULL ELSE CAST(l_partkey % 25 AS INTEGER) END AS do_zone,
    l_shipdate AS pickup_ts,
    l_shipdate + to_seconds(CAST(l_quantity AS BIGINT) * 60 - CASE WHEN l_orderkey % 53 = 0 THEN 3600 ELSE 0 END) AS dropoff_ts,
    CASE WHEN l_orderkey % 89 = 0 THEN 0.0 ELSE l_quantity END AS trip_distance,
    CASE WHEN l_orderkey % 97 = 0 THEN 0.0 ELSE l_extendedprice END AS fare_amount,
    CASE WHEN l_orderkey % 83 = 0 THEN -1.0 ELSE l_extendedprice + 10 END AS total_amount,
    'trips_' || strftime(CAST(date_trunc('month', l_shipdate) AS DATE) + to_months(CAST(CASE l_orderkey % 50 WHEN 0 THEN 4 WHEN 1 THEN -4 WHEN 2 THEN 1 WHEN 3 THEN -1 ELSE 0 END AS INTEGER)), '%Y-%m') || '.parquet' AS sourcefile_name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
), filed AS (
  SELECT *, CAST(pickup_ts AS DATE) AS pickup_date, CAST(regexp_extract(sourcefile_name, '(\d{4}-\d{2})', 1) || '-01' AS DATE) AS file_month FROM trips
), silver AS (
  SELECT * FROM filed WHERE pickup_date BETWEEN CAST(file_month - INTERVAL 1 MONTH AS DATE) AND CAST(file_month + INTERVAL 2 MONTH AS DATE)
), curated AS (
  SELECT * REPLACE (CAST(pickup_ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS DATE) AS pickup_date), CAST(dropoff_ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS DATE) AS dropoff_date,
    md5(vendor_id || '|' || strftime(pickup_ts, '%Y-%m-%d %H:%M:%S') || '+00:00|' || pu_zone || '|' || do_zone || '|' || sourcefile_name) AS trip_id
  FROM silver
), clean AS (
  SELECT * FROM curated WHERE NOT (fare_amount = 0 OR total_amount = 0) AND NOT (trip_distance = 0 AND total_amount <= 0)
), covered AS (
  SELECT last_day(max(file_month)) AS covered_end FROM silver
), zones AS (
  SELECT n_nationkey AS zone_id, n_name AS zone, r_name AS borough FROM nation JOIN region ON n_regionkey = r_regionkey
), bounds AS (
  SELECT CAST(year(min(d)) AS INTEGER) - 1 AS lo, CAST(year(max(d)) AS INTEGER) + 1 AS hi
  FROM (SELECT min(o_orderdate) AS d FROM orders UNION ALL SELECT max(o_orderdate) FROM orders UNION ALL SELECT min(l_shipdate) FROM lineitem UNION ALL SELECT max(l_shipdate) FROM lineitem)
), each_year AS (
  SELECT CAST(y AS INTEGER) AS y FROM (SELECT unnest(generate_series((SELECT lo - 1 FROM bounds), (SELECT hi + 1 FROM bounds))) AS y)
), year_starts AS (
  SELECT y, CAST(make_date(y, 1, 1) + to_days(CAST(CASE WHEN dayofweek(make_date(y, 1, 1)) <= 3 THEN -dayofweek(make_date(y, 1, 1)) ELSE 7 - dayofweek(make_date(y, 1, 1)) END AS INTEGER)) AS DATE) AS a FROM each_year
), fiscal_weeks AS (
  SELECT s.y AS fiscal_year, CAST(w AS INTEGER) AS fiscal_week, CAST(s.a + to_days(CAST(7 * (w - 1) AS INTEGER)) AS DATE) AS week_start
  FROM year_starts s JOIN year_starts n ON n.y = s.y + 1 JOIN bounds ON s.y BETWEEN lo AND hi, generate_series(1, (n.a - s.a) // 7) g(w)
), fiscal_named AS (
  SELECT *, CAST(CASE WHEN fiscal_week = 53 THEN 12 ELSE 3 * ((fiscal_week - 1) // 13) + least(3, ((fiscal_week - 1) % 13) // 4 + 1) END AS INTEGER) AS fiscal_month FROM fiscal_weeks
), holidays AS (
  SELECT make_date(y, m, d) AS date, name AS holiday_name
  FROM each_year, (VALUES (1, 1, 'New Year'), (7, 4, 'Independence Day'), (12, 25, 'Christmas Day')) h(m, d, name)
), dst_days AS (
  SELECT y, (SELECT min(x) FROM generate_series(make_date(y, 4, 1)::TIMESTAMP, make_date(y, 4, 30)::TIMESTAMP, INTERVAL 1 DAY) s(x) WHERE dayofweek(x) = 0) AS a,
    (SELECT max(x) FROM generate_series(make_date(y, 10, 1)::TIMESTAMP, make_date(y, 10, 31)::TIMESTAMP, INTERVAL 1 DAY) s(x) WHERE dayofweek(x) = 0) AS b
  FROM each_year
), dates AS (
  SELECT CAST(week_start + to_days(CAST(k AS INTEGER)) AS DATE) AS date, week_start, fiscal_year, fiscal_week, CAST(fiscal_year * 100 + fiscal_week AS INTEGER) AS fiscal_year_week,
    fiscal_month, CAST(fiscal_year * 100 + fiscal_month AS INTEGER) AS fiscal_year_month,
    CAST(dense_rank() OVER (PARTITION BY fiscal_year, fiscal_month ORDER BY week_start) AS INTEGER) AS fiscal_week_of_month,
    CAST(row_number() OVER (PARTITION BY fiscal_year, fiscal_month ORDER BY week_start, k) AS INTEGER) AS day_of_fiscal_month
  FROM fiscal_named, generate_series(0, 6) g(k)
), date_dim AS (
  SELECT d.*, CAST(year(d.date) AS INTEGER) AS year, CAST(month(d.date) AS INTEGER) AS month, monthname(d.date) AS month_name, CAST(day(d.date) AS INTEGER) AS day,
    CAST(dayofweek(d.date) AS INTEGER) AS day_of_week, dayname(d.date) AS day_name, dayofweek(d.date) IN (0, 6) AS is_weekend, holiday_name IS NOT NULL AS is_holiday, holiday_name,
    (d.date > dst_days.a AND d.date <= dst_days.b) AS is_dst
  FROM dates d LEFT JOIN holidays h ON d.date = h.date JOIN dst_days ON dst_days.y = year(d.date)
), weekly AS (
  SELECT week_start AS ds, fiscal_year, fiscal_week, fiscal_year_week, fiscal_month, fiscal_year_month,
    CAST(sum(CASE WHEN NOT is_weekend AND NOT is_holiday THEN 1 ELSE 0 END) AS INTEGER) AS count_workdays, CAST(sum(CASE WHEN NOT is_weekend AND is_holiday THEN 1 ELSE 0 END) AS INTEGER) AS holiday_days_in_week
  FROM date_dim GROUP BY ALL
), cal AS (
  SELECT *, fiscal_week_of_month / weeks_in_month AS origin_month_fraction_elapsed FROM (
    SELECT *, CAST(count(*) OVER (PARTITION BY fiscal_year_month) AS INTEGER) AS weeks_in_month, CAST(row_number() OVER (PARTITION BY fiscal_year_month ORDER BY ds) AS INTEGER) AS fiscal_week_of_month,
      CAST(row_number() OVER (ORDER BY ds) AS INTEGER) AS week_index, CAST(dense_rank() OVER (ORDER BY fiscal_year_month) AS INTEGER) AS month_index FROM weekly)
), sales AS (
  SELECT c_nationkey AS unique_id, CAST(o_orderdate AS DATE) AS day, CAST(CAST(o_orderdate AS DATE) - CAST(dayofweek(o_orderdate) AS INTEGER) AS DATE) AS ds, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey
), weekly_sales AS (
  SELECT CAST(unique_id AS BIGINT) AS unique_id, ds, CAST(sum(amount) AS DOUBLE) AS y FROM sales GROUP BY ALL
), panel AS (
  SELECT s.unique_id, c.ds, coalesce(w.y, 0.0) AS y
  FROM (SELECT unique_id, min(ds) AS first_ds FROM weekly_sales GROUP BY 1) s
  JOIN cal c ON c.ds BETWEEN s.first_ds AND (SELECT max(ds) FROM weekly_sales)
  LEFT JOIN weekly_sales w ON w.unique_id = s.unique_id AND w.ds = c.ds
), pc AS (
  SELECT p.unique_id, p.y, c.* FROM panel p JOIN cal c ON p.ds = c.ds
), month_totals AS (
  SELECT unique_id, fiscal_year_month, CAST(sum(CAST(y AS DECIMAL(18,2))) AS DOUBLE) AS actual_monthly_total FROM pc GROUP BY ALL
), months AS (
  SELECT fiscal_year_month, month_index, max(ds) AS last_ds, min(ds) AS first_ds, max(weeks_in_month) AS weeks_in_month, min(week_index) AS first_week, max(week_index) AS last_week FROM cal GROUP BY ALL
), last_complete AS (
  SELECT max(fiscal_year_month) AS m, max(month_index) AS i FROM months WHERE last_ds <= (SELECT max(ds) FROM panel)
), starts AS (
  SELECT m.fiscal_year_month AS start_month, m.month_index FROM months m, last_complete l WHERE m.month_index BETWEEN l.i - 1 - 3 AND l.i - 1
), origins AS (
  SELECT c.ds AS forecast_origin_date, max(c.week_index) AS origin_week, CAST(max(e.last_week - c.week_index) AS INTEGER) AS horizon
  FROM starts s JOIN months p ON p.month_index = s.month_index - 1 JOIN months e ON e.month_index = s.month_index + 1
  JOIN cal c ON c.week_index BETWEEN p.last_week AND e.last_week - 1 GROUP BY c.ds
), o AS (
  SELECT o.*, c.fiscal_year_month AS origin_month, c.month_index AS origin_month_index, c.origin_month_fraction_elapsed AS fraction FROM origins o JOIN cal c ON c.ds = o.forecast_origin_date
), trail AS (
  SELECT o.forecast_origin_date, o.origin_week, p.unique_id, p.ds, p.y, p.week_index FROM o JOIN pc p ON p.week_index <= o.origin_week
), future AS (
  SELECT o.forecast_origin_date, s.unique_id, c.ds, c.fiscal_year_month, c.month_index, c.week_index, c.week_index - o.origin_week AS step, o.origin_week
  FROM o JOIN cal c ON c.week_index BETWEEN o.origin_week + 1 AND o.origin_week + o.horizon CROSS JOIN (SELECT DISTINCT unique_id FROM panel) s
), naive AS (
  SELECT f.forecast_origin_date, f.unique_id, f.ds, f.fiscal_year_month, l.y AS ypred FROM future f
  JOIN (SELECT forecast_origin_date, unique_id, max_by(y, ds) AS y FROM trail GROUP BY ALL) l USING (forecast_origin_date, unique_id)
), recent AS (
  SELECT f.forecast_origin_date, f.unique_id, f.ds, f.fiscal_year_month, l.y AS ypred FROM future f
  JOIN (SELECT forecast_origin_date, unique_id, CAST(sum(CAST(y AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS y FROM trail WHERE week_index > origin_week - 7 GROUP BY ALL) l USING (forecast_origin_date, unique_id)
), quarter AS (
  SELECT f.forecast_origin_date, f.unique_id, f.ds, f.fiscal_year_month, l.y AS ypred FROM future f
  JOIN (SELECT forecast_origin_date, unique_id, CAST(sum(CAST(y AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS y FROM trail WHERE week_index > origin_week - 13 GROUP BY ALL) l USING (forecast_origin_date, unique_id)
), forecasts AS (
  SELECT 'naive' AS model, * FROM naive UNION ALL SELECT 'recent_mean' AS model, * FROM recent UNION ALL SELECT 'recent_quarter' AS model, * FROM quarter
), remaining AS (
  SELECT model, forecast_origin_date, unique_id, fiscal_year_month AS predicted_fiscal_year_month, sum(round(ypred, 2)::DECIMAL(18,2)) AS predicted_remaining FROM forecasts GROUP BY ALL
), mtd AS (
  SELECT o.forecast_origin_date, p.unique_id, p.fiscal_year_month AS predicted_fiscal_year_month, sum(CAST(p.y AS DECIMAL(18,2))) AS mtd_revenue
  FROM o JOIN pc p ON p.fiscal_year_month = o.origin_month AND p.ds <= o.forecast_origin_date WHERE o.fraction < 1 GROUP BY ALL
), components AS (
  SELECT r.model, r.forecast_origin_date, r.unique_id, r.predicted_fiscal_year_month, CAST(coalesce(m.mtd_revenue, 0) AS DOUBLE) AS mtd_revenue, CAST(r.predicted_remaining AS DOUBLE) AS predicted_remaining,
    CAST(coalesce(m.mtd_revenue, 0) + r.predicted_remaining AS DOUBLE) AS monthly_forecast
  FROM remaining r LEFT JOIN mtd m USING (forecast_origin_date, unique_id, predicted_fiscal_year_month)
), trailing_means AS (
  SELECT forecast_origin_date, unique_id, CAST(coalesce(sum(CASE WHEN y > 0 THEN CAST(y AS DECIMAL(18,2)) END), 0) AS DOUBLE) / greatest(1, count(CASE WHEN y > 0 THEN 1 END)) AS m
  FROM trail WHERE week_index > origin_week - 52 GROUP BY ALL
), edges AS (
  SELECT forecast_origin_date, quantile_cont(m, [0.2, 0.4, 0.6, 0.8]) AS q FROM trailing_means WHERE m > 0 GROUP BY ALL
), tiers AS (
  SELECT t.forecast_origin_date, t.unique_id, CASE WHEN m <= 0 THEN 0 ELSE (m > q[1])::INT + (m > q[2])::INT + (m > q[3])::INT + (m > q[4])::INT END AS tier_rank
  FROM trailing_means t LEFT JOIN edges e USING (forecast_origin_date)
), named_tiers AS (
  SELECT *, ['very_low', 'low', 'middle', 'high', 'very_high'][tier_rank + 1] AS tier FROM tiers
), weights AS (
  SELECT forecast_origin_date, unique_id, cbrt(greatest(CAST(sum(CAST(y AS DECIMAL(18,2))) AS DOUBLE), 0)) AS series_weight FROM trail WHERE week_index > origin_week - 26 GROUP BY ALL
), ms AS (
  SELECT k.model, k.forecast_origin_date, k.predicted_fiscal_year_month, k.unique_id, t.tier, t.tier_rank, k.monthly_forecast, a.actual_monthly_total, w.series_weight, o.fraction AS origin_month_fraction_elapsed,
    'horizon_' || CAST(pm.month_index - o.origin_month_index + CASE WHEN o.fraction = 1 THEN 0 ELSE 1 END AS VARCHAR) AS horizon, k.mtd_revenue
  FROM components k JOIN month_totals a ON a.unique_id = k.unique_id AND a.fiscal_year_month = k.predicted_fiscal_year_month
  JOIN last_complete lc ON k.predicted_fiscal_year_month <= lc.m
  JOIN named_tiers t ON t.forecast_origin_date = k.forecast_origin_date AND t.unique_id = k.unique_id
  JOIN weights w ON w.forecast_origin_date = k.forecast_origin_date AND w.unique_id = k.unique_id
  JOIN o ON o.forecast_origin_date = k.forecast_origin_date JOIN months pm ON pm.fiscal_year_month = k.predicted_fiscal_year_month
), base AS (
  SELECT c.forecast_origin_date, c.predicted_fiscal_year_month, c.unique_id, c.horizon, c.tier, c.tier_rank, c.series_weight AS w, c.actual_monthly_total AS a, c.monthly_forecast AS fc, b.monthly_forecast AS fb,
    c.origin_month_fraction_elapsed
  FROM ms c JOIN ms b USING (forecast_origin_date, predicted_fiscal_year_month, unique_id) WHERE c.model = 'recent_mean' AND b.model = 'naive'
), spine AS (
  SELECT CASE WHEN origin_month_fraction_elapsed = 1 THEN next_month ELSE fiscal_year_month END AS target_month, ds AS forecast_origin_date,
    CASE WHEN origin_month_fraction_elapsed = 1 THEN 0 ELSE fiscal_week_of_month END AS weeks_actualized, CASE WHEN origin_month_fraction_elapsed = 1 THEN next_weeks ELSE weeks_in_month END AS weeks_in_month
  FROM (SELECT *, lead(fiscal_year_month) OVER (ORDER BY ds) AS next_month, lead(weeks_in_month) OVER (ORDER BY ds) AS next_weeks FROM cal)
  WHERE (CASE WHEN origin_month_fraction_elapsed = 1 THEN next_month ELSE fiscal_year_month END) > (SELECT min(fiscal_year_month) FROM cal)
), complete AS (
  SELECT unique_id, fiscal_year_month FROM pc GROUP BY ALL HAVING count(DISTINCT fiscal_week_of_month) = max(weeks_in_month) AND count(*) = max(weeks_in_month)
), trimmed AS (
  SELECT pc.* FROM pc JOIN complete USING (unique_id, fiscal_year_month)
), grid AS (
  SELECT s.*, t.unique_id, t.actual_monthly_total FROM spine s JOIN month_totals t ON t.fiscal_year_month = s.target_month JOIN complete k ON k.unique_id = t.unique_id AND k.fiscal_year_month = t.fiscal_year_month
)
"""
