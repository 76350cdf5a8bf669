"""Queries: profiles of the panel (O), ranks and correlation (E9-E11, E17, E18), transforms (H16-H18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelmill.operators import panel as P
from panelmill.operators import profile as PR
from panelmill.plans import example as X
from panelmill.plans.queries_panel import q

STATS = "SELECT unique_id, CAST(sum(CAST(y AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean, median(y) AS median, CAST(sum(CAST(y AS DECIMAL(18,2))) AS DOUBLE) AS total, CAST(coalesce(sum(CASE WHEN y > 0 THEN CAST(y AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS positive_total, CAST(sum(CASE WHEN y > 0 THEN CAST(y AS DECIMAL(18,2)) END) AS DOUBLE) / count(CASE WHEN y > 0 THEN 1 END) AS mean_positive, median(CASE WHEN y > 0 THEN y END) AS median_positive, min(CASE WHEN y <> 0 THEN ds END) AS start_ds, CAST((max(ds) - min(CASE WHEN y <> 0 THEN ds END)) // 7 + 1 AS BIGINT) AS length_weeks FROM {} GROUP BY unique_id"
TRAIL52 = "(SELECT * FROM panel WHERE ds > (SELECT max(ds) FROM panel) - 364)"


@q("o1_series_stats", STATS.format("panel"), r=("mean", "median", "mean_positive", "median_positive"))
def o1(s):
    return PR.series_stats(s.panel)


@q("o1_trailing_stats", STATS.format(TRAIL52), r=("mean", "median", "mean_positive", "median_positive"))
def o1_trailing(s):
    return PR.series_stats(PR.trailing(s.panel, 52))


@q("o2_series_starts", f"SELECT unique_id, start_ds, length_weeks FROM ({STATS.format('panel')})")
def o2(s):
    return PR.series_stats(s.panel).select("unique_id", "start_ds", "length_weeks")


SHARE = f"(SELECT t.*, CASE WHEN month_total > 0 THEN mtd / month_total END AS mtd_share, month_total >= core AS is_core FROM (SELECT unique_id, ds, fiscal_year_month, fiscal_week_of_month, weeks_in_month, CAST(sum(CAST(y AS DECIMAL(18,2))) OVER (PARTITION BY unique_id, fiscal_year_month ORDER BY ds) AS DOUBLE) AS mtd, CAST(sum(CAST(y AS DECIMAL(18,2))) OVER (PARTITION BY unique_id, fiscal_year_month) AS DOUBLE) AS month_total FROM pc) t JOIN (SELECT unique_id, greatest(1000, 0.25 * (CAST(sum(CAST(y AS DECIMAL(18,2))) AS DOUBLE) / count(*))) AS core FROM {TRAIL52} WHERE y > 0 GROUP BY 1) c USING (unique_id))"


@q("o3_mtd_shares", f"SELECT unique_id, ds, fiscal_year_month, fiscal_week_of_month, weeks_in_month, mtd, month_total, mtd_share, is_core FROM {SHARE}", r=("mtd_share",))
def o3(s):
    return PR.mtd_shares(s.panel, s.calendar)


@q("o4_share_distribution", f"SELECT weeks_in_month, fiscal_week_of_month, count(*) AS n, " + ", ".join(f"quantile_cont(mtd_share, {p}) AS {c}" for p, c in ((0.0, "least"), (0.25, "q25"), (0.5, "q50"), (0.75, "q75"), (1.0, "most"))) + f" FROM {SHARE} WHERE is_core AND mtd_share IS NOT NULL GROUP BY ALL", r=("least", "q25", "q50", "q75", "most"))
def o4(s):
    return PR.share_distribution(PR.mtd_shares(s.panel, s.calendar))


DOWN = "(SELECT unique_id, ds, y - 100000 AS y FROM panel)"


@q("o5_negative_weeks", f"SELECT unique_id, count(CASE WHEN y < 0 THEN 1 END) AS n_negative, count(CASE WHEN y < 0 THEN 1 END) / count(*) AS share_negative, CAST(coalesce(sum(CASE WHEN y < 0 THEN CAST(y AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS negative_sum, -CAST(coalesce(sum(CASE WHEN y < 0 THEN CAST(y AS DECIMAL(18,2)) END), 0) AS DOUBLE) / CAST(sum(CASE WHEN y > 0 THEN CAST(y AS DECIMAL(18,2)) END) AS DOUBLE) AS materiality FROM {DOWN} GROUP BY ALL", r=("share_negative", "materiality"))
def o5(s):
    return PR.negative_weeks(s.panel.withColumn("y", F.col("y") - 100000))


INTER = "SELECT *, CASE WHEN adi < 1.32 AND cv2 < 0.49 THEN 'Smooth' WHEN adi < 1.32 THEN 'Erratic' WHEN cv2 < 0.49 THEN 'Intermittent' ELSE 'Lumpy' END AS demand_class FROM (SELECT unique_id, count(CASE WHEN y = 0 THEN 1 END) / count(*) AS zero_share, count(*) / count(CASE WHEN y > 0 THEN 1 END) AS adi, pow(stddev_samp(CASE WHEN y > 0 THEN y END) / avg(CASE WHEN y > 0 THEN y END), 2) AS cv2 FROM {} GROUP BY ALL)"


@q("o6_intermittency", INTER.format("panel"), r=("zero_share", "adi", "cv2"))
def o6(s):
    return PR.intermittency(s.panel)


@q("o6_trailing_intermittency", INTER.format("(SELECT * FROM panel WHERE ds > (SELECT max(ds) FROM panel) - 728)"), r=("zero_share", "adi", "cv2"))
def o6_trailing(s):
    return PR.intermittency(PR.trailing(s.panel, 104))


@q("h16_demand_classes", f"SELECT demand_class, count(*) AS n FROM ({INTER.format('panel')}) GROUP BY ALL")
def h16(s):
    return PR.intermittency(s.panel).groupBy("demand_class").agg(F.count("*").alias("n"))


@q("o7_spread", "SELECT unique_id, stddev_samp(y) AS std, quantile_cont(y, 0.75) - quantile_cont(y, 0.25) AS iqr, any_value(m) AS mad, stddev_samp(y) / avg(y) AS cv FROM panel JOIN (SELECT unique_id, mad(y) AS m FROM panel GROUP BY 1) USING (unique_id) GROUP BY ALL", r=("std", "iqr", "mad", "cv"))
def o7(s):
    return PR.spread(s.panel)


@q("o8_dispersion_ratios", f"SELECT weeks_in_month, fiscal_week_of_month, count(*) AS n, CASE WHEN quantile_cont(f, 0.75) <> quantile_cont(f, 0.25) THEN (quantile_cont(r, 0.75) - quantile_cont(r, 0.25)) / (quantile_cont(f, 0.75) - quantile_cont(f, 0.25)) END AS iqr_ratio, CASE WHEN mad(f) <> 0 THEN mad(r) / mad(f) END AS mad_ratio, CASE WHEN quantile_cont(f, 0.9) <> quantile_cont(f, 0.1) THEN (quantile_cont(r, 0.9) - quantile_cont(r, 0.1)) / (quantile_cont(f, 0.9) - quantile_cont(f, 0.1)) END AS p90_p10_ratio FROM (SELECT *, month_total - mtd AS r, month_total AS f FROM {SHARE}) GROUP BY ALL", r=("iqr_ratio", "mad_ratio", "p90_p10_ratio"))
def o8(s):
    return PR.dispersion_ratios(PR.mtd_shares(s.panel, s.calendar), ["weeks_in_month", "fiscal_week_of_month"])


@q("o9_length_histogram", f"SELECT length_weeks, count(*) AS n_series FROM ({STATS.format('panel')}) GROUP BY ALL")
def o9(s):
    return PR.length_histogram(PR.series_stats(s.panel))


@q("o10_year_over_year", "SELECT * FROM (PIVOT (SELECT fiscal_week, 'y' || fiscal_year AS named, CAST(y AS DECIMAL(18,2)) AS y FROM pc) ON named USING CAST(sum(y) AS DOUBLE) GROUP BY fiscal_week)")
def o10(s):
    made = PR.year_over_year(s.panel, s.calendar)
    return made.toDF("fiscal_week", *[f"y{c}" for c in made.columns[1:]])


@q("o11_trailing_months", "SELECT DISTINCT fiscal_year_month FROM pc WHERE ds > (SELECT max(ds) FROM panel) - 728 AND weeks_in_month >= 5")
def o11(s):
    return P.on_calendar(PR.trailing(s.panel, 104), s.calendar).where("weeks_in_month >= 5").select("fiscal_year_month").distinct()


@q("e9_ranks", f"SELECT unique_id, CAST(rank() OVER (ORDER BY total DESC) AS INTEGER) AS rank_total, CAST(rank() OVER (ORDER BY mean_positive DESC) AS INTEGER) AS rank_mean_positive FROM ({STATS.format('panel')})")
def e9(s):
    return PR.ranks(PR.series_stats(s.panel), ["total", "mean_positive"])


@q("e10_rank_buckets", f"SELECT unique_id, total, CAST(greatest(1, ceil(5 * (row_number() OVER (ORDER BY total, unique_id) - 1) / (count(*) OVER () - 1))) AS INTEGER) AS bucket FROM ({STATS.format('panel')})")
def e10(s):
    return PR.first_rank_buckets(PR.series_stats(s.panel), "total")


@q("e11_concentration", f"SELECT unique_id, CAST(row_number() OVER w AS INTEGER) AS position, sum(total) OVER w / sum(total) OVER () AS cumulative_share FROM ({STATS.format('panel')}) WINDOW w AS (ORDER BY total DESC, unique_id ROWS UNBOUNDED PRECEDING)", r=("cumulative_share",))
def e11(s):
    return PR.concentration(PR.series_stats(s.panel), "total")


ACF = "SELECT a.unique_id, CAST(l.lag AS INTEGER) AS lag, sum(a.d * b.d) / any_value(v.c0) AS acf FROM (SELECT unique_id, row_number() OVER (PARTITION BY unique_id ORDER BY ds) AS k, y - avg(y) OVER (PARTITION BY unique_id) AS d FROM panel) a CROSS JOIN generate_series(0, 12) l(lag) JOIN (SELECT unique_id, row_number() OVER (PARTITION BY unique_id ORDER BY ds) AS k, y - avg(y) OVER (PARTITION BY unique_id) AS d FROM panel) b ON b.unique_id = a.unique_id AND b.k = a.k - l.lag JOIN (SELECT unique_id, sum(d * d) AS c0 FROM (SELECT unique_id, y - avg(y) OVER (PARTITION BY unique_id) AS d FROM panel) GROUP BY 1) v ON v.unique_id = a.unique_id GROUP BY a.unique_id, l.lag"


@q("e17_autocorrelation", ACF, r=("acf",))
def e17(s):
    return PR.autocorrelation(s.panel, 12)


@q(
    "e18_partial_autocorrelation",
    f"""SELECT unique_id, CAST(k AS INTEGER) AS lag, pacf FROM (
  WITH RECURSIVE lists AS (SELECT unique_id, list(acf ORDER BY lag) AS r FROM ({ACF}) WHERE lag <= 8 GROUP BY unique_id),
  steps AS (
    SELECT unique_id, r, 0 AS k, []::DOUBLE[] AS phi, 1.0::DOUBLE AS pacf FROM lists
    UNION ALL
    SELECT unique_id, r, k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - last * phi[k + 1 - j]), last), last FROM (
      SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 2 - j])), 0)) / (1 - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[j + 1])), 0)) AS last FROM steps WHERE k < 8)
  ) SELECT * FROM steps)""",
    r=("pacf",),
)
def e18(s):
    return PR.partial_autocorrelation(PR.autocorrelation(s.panel, 8))


@q("h17_box_cox", "SELECT unique_id, ds, ln(y) AS log_y, (pow(y, 0.5) - 1) / 0.5 AS root_y FROM panel WHERE y > 0", r=("log_y", "root_y"))
def h17(s):
    y = F.col("y")
    return s.panel.where("y > 0").select("unique_id", "ds", PR.box_cox(y, F.lit(0.0)).alias("log_y"), PR.box_cox(y, F.lit(0.5)).alias("root_y"))


LIKE = "SELECT unique_id, l AS power, -count(*) / 2 * ln(var_pop(CASE WHEN l = 0 THEN ln(y) ELSE (pow(y, l) - 1) / l END)) + (l - 1) * sum(ln(y)) AS likelihood FROM panel, (SELECT unnest([0.0, 0.25, 0.5, 0.75, 1.0])::DOUBLE AS l) WHERE y > 0 GROUP BY unique_id, l"


@q("h18_choose_lambda", f"SELECT unique_id, max_by(power, likelihood) AS power, max(likelihood) AS likelihood FROM ({LIKE}) GROUP BY ALL", r=("likelihood",))
def h18(s):
    return PR.choose_lambda(s.panel, [0.0, 0.25, 0.5, 0.75, 1.0])


GUERRERO = """SELECT unique_id, power, stddev_pop(r) / avg(r) AS variation FROM (
  SELECT unique_id, l AS power, s / pow(m, 1 - l) AS r FROM (
    SELECT unique_id, (k - n % 13) // 13 AS block, avg(y) AS m, stddev_samp(y) AS s FROM (SELECT unique_id, y, row_number() OVER (PARTITION BY unique_id ORDER BY ds) - 1 AS k, count(*) OVER (PARTITION BY unique_id) AS n FROM panel) WHERE k >= n % 13 GROUP BY ALL HAVING avg(y) > 0),
    (SELECT unnest([-1.0, -0.5, 0.0, 0.25, 0.5, 0.75, 1.0, 1.5, 2.0])::DOUBLE AS l)) GROUP BY ALL HAVING count(*) > 1 AND avg(r) <> 0"""


@q("h18_guerrero_lambda", f"SELECT unique_id, min_by(power, (round(variation, 9), power)) AS power, min(variation) AS variation FROM ({GUERRERO}) GROUP BY ALL", r=("variation",))
def h18_guerrero(s):
    """Seasons of a quarter."""
    return PR.guerrero_lambda(s.panel, [-1.0, -0.5, 0.0, 0.25, 0.5, 0.75, 1.0, 1.5, 2.0], 13)
