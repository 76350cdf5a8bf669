"""Queries: joins of forecasts (C13, C14, C21), scores (D21-D24, L), gates (M), monitoring (N), models (K9-K17)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelmill.operators import boosting as B
from panelmill.operators import features as FE
from panelmill.operators import forecast as FC
from panelmill.operators import gates as G
from panelmill.operators import metrics as M
from panelmill.operators import monitor as N
from panelmill.operators import origins as O
from panelmill.operators import panel as P
from panelmill.operators import rollup as R
from panelmill.plans import example as X
from panelmill.plans.queries_panel import q
from panelmill.session import read, shared_dir
from panelmill.sources import files as S

#: SQL of the fold sums and metrics over rows (w, a, fc, fb).
SUMS = """sum(w * abs(fc - a)) AS w_ec, sum(w * abs(fb - a)) AS w_eb, sum(w) AS w_sum,
  sum(CASE WHEN abs(fb - a) > 1e-12 AND w > 1e-12 THEN w * abs(fc - a) / abs(fb - a) END) AS ps_num, sum(CASE WHEN abs(fb - a) > 1e-12 AND w > 1e-12 THEN w END) AS ps_den,
  sum(w * (fc - a)) AS wb_num, sum(w * abs(a)) AS wb_den,
  sum(CASE WHEN abs(a) > 1e-12 AND w > 1e-12 THEN w * (fc - a) / abs(a) END) AS sb_num, sum(CASE WHEN abs(a) > 1e-12 AND w > 1e-12 THEN w END) AS sb_den,
  sum(abs(fc - a)) AS ae, sum(fc - a) AS se, sum(abs(a)) AS aa, count(*) AS n_obs"""
DEFINED = {
    "weighted_mae": "CASE WHEN w_sum > 1e-12 THEN w_ec / w_sum END",
    "wrmae_pooled": "CASE WHEN w_eb > 1e-12 THEN w_ec / w_eb END",
    "wrmae_per_series": "CASE WHEN ps_den > 1e-12 THEN ps_num / ps_den END",
    "signed_bias_pooled": "CASE WHEN wb_den > 1e-12 THEN wb_num / wb_den END",
    "signed_bias_per_series": "CASE WHEN sb_den > 1e-12 THEN sb_num / sb_den END",
    "wape": "CASE WHEN aa > 1e-12 THEN ae / aa END",
    "weighted_signed_bias": "CASE WHEN aa > 1e-12 THEN se / aa END",
}
FOLD = "forecast_origin_date, predicted_fiscal_year_month"
VALUES = ", ".join(f"{x} AS {n}" for n, x in DEFINED.items())
FOLDS = f"SELECT {FOLD}, {VALUES}, n_obs FROM (SELECT {FOLD}, {SUMS} FROM base GROUP BY ALL)"
SCORED = ", ".join(f"{DEFINED[m]} AS {m}" for m in M.SCORED)
SCORES = f"""
SELECT g.model, g.horizon, g.forecast_origin_date, g.predicted_fiscal_year_month, g.tier, u.metric, u.value, coalesce(u.n_obs, (SELECT count(*) FROM rows2 r WHERE r.model = g.model AND r.horizon = g.horizon AND r.forecast_origin_date = g.forecast_origin_date AND r.predicted_fiscal_year_month = g.predicted_fiscal_year_month AND (g.tier = 'global' OR r.tier = g.tier))) AS n_obs
FROM (SELECT DISTINCT model, horizon, {FOLD}, t.tier FROM rows2, (SELECT DISTINCT tier FROM rows2 UNION SELECT 'global') t(tier)) g
CROSS JOIN (SELECT unnest([{", ".join(repr(m) for m in M.SCORED)}]) AS metric) k
LEFT JOIN (SELECT * FROM (SELECT model, horizon, {FOLD}, tier, n_obs, {SCORED} FROM (
  SELECT model, horizon, {FOLD}, tier, {SUMS} FROM rows2 GROUP BY ALL UNION ALL SELECT model, horizon, {FOLD}, 'global', {SUMS} FROM rows2 GROUP BY model, horizon, {FOLD}))
  UNPIVOT (value FOR metric IN ({", ".join(M.SCORED)}))) u
ON u.model = g.model AND u.horizon = g.horizon AND u.forecast_origin_date = g.forecast_origin_date AND u.predicted_fiscal_year_month = g.predicted_fiscal_year_month AND u.tier = g.tier AND u.metric = k.metric"""
SCORES = SCORES.replace("g.tier, u.metric,", "g.tier, k.metric,")
ALL_SCORES = SCORES.replace("rows2", f"(SELECT c.model, {FOLD}, unique_id, c.horizon, c.tier, c.series_weight AS w, c.actual_monthly_total AS a, c.monthly_forecast AS fc, b.monthly_forecast AS fb FROM ms c JOIN ms b USING ({FOLD}, unique_id) WHERE b.model = 'naive')")
SCORES = SCORES.replace("rows2", "(SELECT 'recent_mean' AS model, * FROM base UNION ALL SELECT 'naive' AS model, * REPLACE (fb AS fc) FROM base)")


@q("c13_challenger_benchmark", f"SELECT {FOLD}, unique_id, fc, fb, a, w FROM base", r=("w",))
def c13(s):
    return s.base.select(*M.KEYS, "fc", "fb", "a", "w")


@q("c14_match_indicator", f"SELECT {FOLD}, coalesce(c.unique_id, b.unique_id) AS unique_id, CASE WHEN c.model IS NULL THEN 'right_only' WHEN b.model IS NULL THEN 'left_only' ELSE 'both' END AS _merge FROM (SELECT * FROM ms WHERE model = 'recent_mean') c FULL JOIN (SELECT * FROM ms WHERE model = 'naive') b USING ({FOLD}, unique_id)")
def c14(s):
    c, b = (s.series.where(F.col("model") == m) for m in ("recent_mean", "naive"))
    return M.base_frame(c, b).select(*M.KEYS, "_merge")


@q("c21_cohort_join", f"SELECT DISTINCT b.forecast_origin_date, b.horizon, c.weeks_in_month, c.fiscal_week_of_month AS weeks_elapsed FROM base b JOIN cal c ON c.ds = b.forecast_origin_date")
def c21(s):
    return N.cohorts(s.base.select("forecast_origin_date", "horizon").distinct(), s.calendar)


@q("d21_period_scores", f"SELECT model, horizon, tier, predicted_fiscal_year_month, metric, avg(value) AS value, sum(n_obs)::BIGINT AS n_obs, count(value) AS n_folds FROM ({SCORES}) GROUP BY ALL", r=("value",))
def d21(s):
    return M.period_scores(s.scores)


@q("d22_tier_and_global", f"SELECT coalesce(tier, 'global') AS tier, count(*) AS n, sum(w) AS w FROM base GROUP BY GROUPING SETS ((tier), ())", r=("w",))
def d22(s):
    rows = s.base.groupingSets([[F.col("tier")], []], "tier").agg(F.grouping("tier").alias("g"), F.count("*").alias("n"), F.sum("w").alias("w"))
    return rows.select(F.when(F.col("g") == 1, "global").otherwise(F.col("tier")).alias("tier"), "n", "w")


@q("d23_fold_coverage", f"SELECT horizon, count(DISTINCT ({FOLD})) AS n_folds, count(DISTINCT forecast_origin_date) AS n_origins FROM base GROUP BY ALL")
def d23(s):
    return N.fold_coverage(s.scores)


@q("d24_cell_means", f"SELECT model, horizon, tier, metric, weeks_in_month, fiscal_week_of_month AS weeks_elapsed, avg(value) AS value, count(value) AS n_defined, count(*) AS n_folds FROM ({SCORES}) s JOIN cal ON ds = forecast_origin_date GROUP BY ALL", r=("value",))
def d24(s):
    return N.cohort_means(s.scores, s.calendar)


@q("l1_weighted_mae", f"SELECT {FOLD}, weighted_mae FROM ({FOLDS})", r=("weighted_mae",))
def l1(s):
    return M.fold_values(s.base, []).select(*M.FOLD, "weighted_mae")


def _metric(name: str, metric: str) -> None:
    @q(name, f"SELECT tier, avg({metric}) AS value, count({metric}) AS n_folds FROM (SELECT tier, {FOLD}, {DEFINED[metric]} AS {metric} FROM (SELECT tier, {FOLD}, {SUMS} FROM base GROUP BY ALL)) GROUP BY ALL UNION ALL SELECT 'global', avg({metric}), count({metric}) FROM ({FOLDS})", r=("value",))
    def run(s):
        whole = M.overall(s.base, metric).select(F.lit("global").alias("tier"), "value", "n_folds")
        return M.overall(s.base, metric, ["tier"]).unionByName(whole)


for _name, _m in (("l2_wrmae_pooled", "wrmae_pooled"), ("l3_wrmae_per_series", "wrmae_per_series"), ("l4_signed_bias_pooled", "signed_bias_pooled"), ("l5_signed_bias_per_series", "signed_bias_per_series"), ("l6_wape", "wape"), ("l7_weighted_signed_bias", "weighted_signed_bias")):
    _metric(_name, _m)

SHARES = f"SELECT unique_id, sum(b / t) / any_value(f) AS x, sum(c / t) / any_value(f) AS y FROM (SELECT *, w * abs(fb - a) AS b, w * abs(fc - a) AS c, sum(w * abs(fb - a)) OVER (PARTITION BY {FOLD}) AS t FROM base), (SELECT count(*) AS f FROM (SELECT {FOLD} FROM base GROUP BY ALL HAVING sum(w * abs(fb - a)) > 1e-12)) WHERE t > 1e-12 GROUP BY ALL"


BY_HORIZON = f"SELECT horizon, unique_id, sum(b / t) / any_value(f) AS x, sum(c / t) / any_value(f) AS y FROM (SELECT *, w * abs(fb - a) AS b, w * abs(fc - a) AS c, sum(w * abs(fb - a)) OVER (PARTITION BY horizon, {FOLD}) AS t FROM base) JOIN (SELECT horizon, count(*) AS f FROM (SELECT horizon, {FOLD} FROM base GROUP BY ALL HAVING sum(w * abs(fb - a)) > 1e-12) GROUP BY 1) USING (horizon) WHERE t > 1e-12 GROUP BY horizon, unique_id"


def _held(rows: str, by: str) -> str:
    """SQL of the sentence about the tiers that a series held: its last one, and in how many folds it had others."""
    keys = f"{by}, unique_id" if by else "unique_id"
    return f"""SELECT {keys}, any_value(last_tier) AS last_tier, any_value(last_tier) || coalesce(' at last origin (' || string_agg(tier || ' in ' || n || ' of ' || folds || ' folds', '; ' ORDER BY tier_rank) FILTER (tier <> last_tier) || ')', '') AS held
  FROM (SELECT {keys}, tier, tier_rank, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY {keys}) AS BIGINT) AS folds FROM {rows} GROUP BY {keys}, tier, tier_rank)
  JOIN (SELECT unique_id, max_by(tier, (forecast_origin_date, predicted_fiscal_year_month)) AS last_tier FROM {rows} GROUP BY unique_id) USING (unique_id) GROUP BY {keys}"""


@q("l8_error_shares", SHARES, r=("x", "y"))
def l8(s):
    return M.shares(s.base)


@q("l8_horizon_shares", f"SELECT k.horizon, k.unique_id, coalesce(x, 0) AS x, coalesce(y, 0) AS y, coalesce(y, 0) - coalesce(x, 0) AS net, last_tier AS tier, held AS label FROM (SELECT DISTINCT horizon, unique_id FROM base) k LEFT JOIN ({BY_HORIZON}) USING (horizon, unique_id) JOIN ({_held('base', 'horizon')}) USING (horizon, unique_id)", r=("x", "y", "net"))
def l8_horizons(s):
    return M.horizon_shares(s.base)


@q("l9_wrmae_by_progress", f"SELECT weeks_in_month, weeks_actualized, avg(v) AS value, sum(n_obs)::BIGINT AS n_events FROM (SELECT s.weeks_in_month, s.weeks_actualized, b.forecast_origin_date, CASE WHEN sum(w * abs(fb - a)) > 1e-12 THEN sum(w * abs(fc - a)) / sum(w * abs(fb - a)) END AS v, count(*) AS n_obs FROM base b JOIN spine s ON s.forecast_origin_date = b.forecast_origin_date AND s.target_month = b.predicted_fiscal_year_month GROUP BY ALL) GROUP BY ALL", r=("value",))
def l9(s):
    return M.by_progress(s.base, s.spine)


HEROES = " UNION ALL ".join(f"SELECT avg(v) AS value, count(v) AS n_folds, '{m}' AS metric, '{h}' AS horizon FROM (SELECT {FOLD}, {DEFINED[m]} AS v FROM (SELECT {FOLD}, {SUMS} FROM base WHERE horizon = '{h}' GROUP BY ALL))" for m in ("wrmae_pooled", "wrmae_per_series", "wape") for h in ("horizon_1", "horizon_2"))


@q("l10_hero_metric", HEROES, r=("value",))
def l10(s):
    out = None
    for metric in M.HERO:
        for horizon in ("horizon_1", "horizon_2"):
            row = M.hero(s.base, metric, horizon).withColumn("horizon", F.lit(horizon))
            out = row if out is None else out.unionByName(row)
    return out


@q("l11_native_mae", "SELECT f.model, f.forecast_origin_date, f.unique_id, avg(abs(f.ypred - p.y)) AS mae FROM forecasts f JOIN panel p ON p.unique_id = f.unique_id AND p.ds = f.ds GROUP BY ALL", r=("mae",))
def l11(s):
    return s.forecasts.join(s.panel, ["unique_id", "ds"]).groupBy("model", "forecast_origin_date", "unique_id").agg(F.avg(F.abs(F.col("ypred") - F.col("y"))).alias("mae"))


@q("l12_rmse", "SELECT model, max(pooled) AS pooled, avg(r) AS fold_mean FROM (SELECT model, forecast_origin_date, sqrt(avg(pow(ypred - y, 2))) AS r, NULL AS pooled FROM forecasts JOIN panel USING (unique_id, ds) GROUP BY ALL UNION ALL SELECT model, NULL, NULL, sqrt(avg(pow(ypred - y, 2))) FROM forecasts JOIN panel USING (unique_id, ds) GROUP BY ALL) GROUP BY model", r=("pooled", "fold_mean"))
def l12(s):
    rows = s.forecasts.join(s.panel, ["unique_id", "ds"]).withColumn("e2", F.pow(F.col("ypred") - F.col("y"), 2))
    pooled = rows.groupBy("model").agg(F.sqrt(F.avg("e2")).alias("pooled"))
    folds = rows.groupBy("model", "forecast_origin_date").agg(F.sqrt(F.avg("e2")).alias("r")).groupBy("model").agg(F.avg("r").alias("fold_mean"))
    return pooled.join(folds, "model")


@q("l13_series_errors", f"SELECT {FOLD}, unique_id, tier, CASE WHEN fb <> a THEN abs(fc - a) / abs(fb - a) END AS relative_mae, CASE WHEN a <> 0 THEN (fc - a) / abs(a) END AS relative_bias FROM base", r=("relative_mae", "relative_bias"))
def l13(s):
    return M.series_errors(s.base)


@q("f5_worst_series", f"SELECT * FROM (SELECT {FOLD}, unique_id, tier, CASE WHEN fb <> a THEN abs(fc - a) / abs(fb - a) END AS relative_mae FROM base) WHERE relative_mae > 2", r=("relative_mae",))
def f5(s):
    return M.series_errors(s.base).where("relative_mae > 2").drop("relative_bias").orderBy(F.desc("relative_mae"))


@q("l14_fold_scores", SCORES, r=("value",))
def l14(s):
    return s.scores


@q("l14_summary_scores", f"SELECT model, horizon, tier, metric, avg(value) AS value, sum(n_obs)::BIGINT AS n_obs, count(value) AS n_folds FROM ({SCORES}) GROUP BY ALL", r=("value",))
def l14_summary(s):
    return M.summary_scores(s.scores)


def _grain(grain: str, period: str, origin: str) -> str:
    return f"SELECT '{grain}' AS grain, model, horizon, tier, {period} AS period, {origin} AS origin, metric, avg(value) AS value, count(value) AS n_folds FROM ({ALL_SCORES}) GROUP BY ALL"


@q("l15_leaderboard", " UNION ALL ".join([_grain("summary", "CAST(NULL AS INTEGER)", "CAST(NULL AS DATE)"), _grain("period", "predicted_fiscal_year_month", "CAST(NULL AS DATE)"), _grain("fold", "predicted_fiscal_year_month", "forecast_origin_date")]), r=("value",))
def l15(s):
    return M.leaderboard(s.series, "naive")


@q("l16_headline", f"SELECT model, avg(value) FILTER (horizon = 'horizon_1') AS horizon_1, avg(value) FILTER (horizon = 'horizon_2') AS horizon_2 FROM ({SCORES}) WHERE tier = 'global' AND metric = 'wrmae_pooled' AND model = 'recent_mean' GROUP BY model", r=("horizon_1", "horizon_2"))
def l16(s):
    return M.headline(M.summary_scores(s.scores), "recent_mean", ["horizon_1", "horizon_2"])


@q(
    "a9_evaluate_sink",
    f"""SELECT 'e1' AS run_id, 'recent_mean' AS model, table_name, n_rows FROM (
  SELECT 'fold_metrics' AS table_name, count(*) AS n_rows FROM ({SCORES}) UNION ALL SELECT 'per_series_comparison', count(*) FROM base
  UNION ALL SELECT 'period_metrics', count(*) FROM (SELECT DISTINCT model, horizon, tier, predicted_fiscal_year_month, metric FROM ({SCORES}))
  UNION ALL SELECT 'summary_metrics', count(*) FROM (SELECT DISTINCT model, horizon, tier, metric FROM ({SCORES})))""",
)
def a9(s):
    root = f"{shared_dir(s.spark)}/evaluate-{uuid.uuid4().hex}"
    tables = {"per_series_comparison": s.base, "fold_metrics": s.scores, "period_metrics": M.period_scores(s.scores), "summary_metrics": M.summary_scores(s.scores)}
    S.write_run(tables, root, "e1", "recent_mean")
    return s.spark.read.parquet(f"{root}/manifest")


@q(
    "a9_evaluate_manifest",
    f"""SELECT 'recent_mean' AS challenger_model, 'naive' AS benchmark_model, 'wrmae_pooled' AS hero_metric, (SELECT avg(value) FROM ({SCORES}) WHERE model = 'recent_mean' AND tier = 'global' AND metric = 'wrmae_pooled' AND horizon = 'horizon_1') AS horizon_1,
  (SELECT avg(value) FROM ({SCORES}) WHERE model = 'recent_mean' AND tier = 'global' AND metric = 'wrmae_pooled' AND horizon = 'horizon_2') AS horizon_2,
  count(DISTINCT forecast_origin_date) AS n_origins, min(forecast_origin_date) AS first_origin, max(forecast_origin_date) AS last_origin, count(DISTINCT unique_id) AS n_series, count(DISTINCT ({FOLD})) AS n_folds_total FROM base""",
    r=("horizon_1", "horizon_2"),
)
def a9_manifest(s):
    values = M.headline(M.summary_scores(s.scores), "recent_mean", ["horizon_1", "horizon_2"]).select("horizon_1", "horizon_2")
    facts = s.base.agg(F.countDistinct("forecast_origin_date").alias("n_origins"), F.min("forecast_origin_date").alias("first_origin"), F.max("forecast_origin_date").alias("last_origin"), F.countDistinct("unique_id").alias("n_series"), F.countDistinct(*M.FOLD).alias("n_folds_total"))
    return facts.crossJoin(values).select(F.lit("recent_mean").alias("challenger_model"), F.lit("naive").alias("benchmark_model"), F.lit("wrmae_pooled").alias("hero_metric"), "horizon_1", "horizon_2", *facts.columns)


# -- gates: counts of what was checked and what was wrong -------------------------------------


def _gate(name: str, checked: str):
    """A gate's query: (gate, checked, violations, ok); the oracle counts the rows it must check and expects none to be bad."""
    return q(name, f"SELECT '{name}' AS gate, ({checked}) AS checked, 0::BIGINT AS violations, true AS ok")


#: Planted defects: two runs in one frame, and rows that no run has stamped.
MIXED = "CASE WHEN unique_id % 5 = 3 THEN NULL WHEN unique_id % 5 = 4 THEN 'run-2' ELSE 'run-1' END"


@q("m1_single_lineage", f"SELECT 'published' AS frame, 1::BIGINT AS ids, 0::BIGINT AS nulls, 'run-1' AS id, true AS ok UNION ALL SELECT 'mixed', count(DISTINCT r), count(*) FILTER (r IS NULL), max(r), false FROM (SELECT {MIXED} AS r FROM panel)")
def m1(s):
    frames = {"published": S.with_lineage(s.panel, "run-1"), "mixed": s.panel.withColumn("feature_run_id", F.expr(MIXED))}
    out = None
    for name, df in frames.items():
        row = G.lineage_facts(df).select(F.lit(name).alias("frame"), "ids", "nulls", "id", F.lit(G.single_lineage(df, expected="run-1").isEmpty()).alias("ok"))
        out = row if out is None else out.unionByName(row)
    return out


@_gate("m2_calendar_coverage", "SELECT count(DISTINCT ds) FROM panel")
def m2(s):
    bad = G.uncovered_weeks(s.panel, s.calendar).withColumn("bad", F.lit(True))
    return G.check("m2_calendar_coverage", s.panel.select("ds").distinct().join(bad, "ds", "left"), F.col("bad").isNotNull())


@q("m2_fiscal_position", "SELECT unique_id, fiscal_year_month, fiscal_week_of_month, y FROM pc")
def m2_position(s):
    return G.fiscal_position(s.panel, s.calendar)


@q("m3_feature_drift", "SELECT 'lag1' AS feature, count(*) AS n FROM panel UNION ALL SELECT 'lag2', count(*) FROM panel UNION ALL SELECT 'lag52', count(*) FROM panel UNION ALL SELECT 'rolling_mean_lag1_window_size4', count(*) FROM panel")
def m3(s):
    declared = ["lag1", "lag2", "lag52", "rolling_mean_lag1_window_size4"]
    if odd := G.feature_drift(s.weekly_features, declared, [1, 2, 52], {1: 4}):
        raise G.GateError(str(odd))
    return s.weekly_features.select(F.explode(F.array(*map(F.lit, declared))).alias("feature")).groupBy("feature").agg(F.count("*").alias("n"))


@q("m4_lag_alignment", "SELECT 1 AS lag, 0::BIGINT AS violations UNION ALL SELECT 2, 0 UNION ALL SELECT 52, 0")
def m4(s):
    out = [G.lag_alignment(s.weekly_features, s.panel, k).agg(F.count("*").alias("violations")).select(F.lit(k).alias("lag"), "violations") for k in (1, 2, 52)]
    return out[0].union(out[1]).union(out[2])


@_gate("m5_mtd_construction", "SELECT count(*) FROM grid")
def m5(s):
    return G.check("m5_mtd_construction", G.mtd_increments(s.table, s.panel, s.calendar), ~F.col("ok"))


@q(
    "m5_planted_defects",
    "SELECT 'increments' AS gate, count(*) FILTER (unique_id = 3 AND weeks_actualized = 1) + count(*) FILTER (unique_id = 5 AND weeks_actualized IN (2, 3)) AS violations FROM grid UNION ALL SELECT 'week_zero_coverage', count(DISTINCT target_month) FROM grid WHERE unique_id = 3",
)
def m5_planted(s):
    """One series without its week-0 origins, and one whose month-to-date is off by one at week 2 (so week 3 grows wrongly too)."""
    off = F.when((F.col("unique_id") == 5) & (F.col("weeks_actualized") == 2), F.col("mtd_revenue") + 1).otherwise(F.col("mtd_revenue"))
    table = s.table.where("NOT (unique_id = 3 AND weeks_actualized = 0)").withColumn("mtd_revenue", off)
    bad = G.mtd_increments(table, s.panel, s.calendar).agg(F.count_if(~F.col("ok")).alias("violations")).select(F.lit("increments").alias("gate"), "violations")
    active = s.totals.join(s.complete_pairs, ["unique_id", "fiscal_year_month"], "left_semi")
    return bad.unionByName(G.week_zero_coverage(table, active).agg(F.count("*").alias("violations")).select(F.lit("week_zero_coverage").alias("gate"), "violations"))


@_gate("m6_total_reconciliation", "SELECT count(*) FROM grid WHERE weeks_actualized = weeks_in_month - 1")
def m6(s):
    return G.check("m6_total_reconciliation", G.total_reconciliation(s.table, s.panel, s.calendar), ~F.col("ok"))


@_gate("m7_remaining_identity", "SELECT count(*) FROM grid")
def m7(s):
    return G.check("m7_remaining_identity", G.remaining_identity(FE.remaining_target(s.table), s.panel, s.calendar), ~F.col("ok"))


@q(
    "m8_join_integrity",
    """SELECT 'whole' AS frame, gate, checked, 0::BIGINT AS violations FROM (SELECT unnest(['unique_feature_keys', 'key_types']) AS gate, (SELECT count(*) FROM panel) AS checked UNION ALL SELECT unnest(['origins_without_features', 'row_count']), (SELECT count(*) FROM grid))
  UNION ALL SELECT 'doubled', 'unique_feature_keys', (SELECT count(*) FROM panel) + (SELECT count(*) FROM panel WHERE unique_id = 3), (SELECT count(*) FROM panel WHERE unique_id = 3)
  UNION ALL SELECT 'empty', unnest(['unique_feature_keys', 'origins_without_features', 'row_count', 'key_types']), 0, 1""",
)
def m8(s):
    """The study's own join, one with a series' features twice, and one over no rows at all, which passes nothing."""
    twice = s.weekly_features.unionByName(s.weekly_features.where("unique_id = 3"))
    none = s.table.where("false")
    rows = G.join_integrity(s.modelling_table, s.table, s.weekly_features).select(F.lit("whole").alias("frame"), "*")
    rows = rows.unionByName(G.join_integrity(s.modelling_table, s.table, twice).where("gate = 'unique_feature_keys'").select(F.lit("doubled").alias("frame"), "*"))
    return rows.unionByName(G.join_integrity(none, none, s.weekly_features.where("false")).select(F.lit("empty").alias("frame"), "*"))


@q("m9_shared_cutoff", "SELECT 0::BIGINT AS violations, (SELECT count(*) FROM grid) AS checked")
def m9(s):
    return G.shared_cutoff(s.modelling_table, s.panel, [1, 2, 52]).agg(F.count("*").alias("violations")).crossJoin(s.modelling_table.agg(F.count("*").alias("checked")))


@q("m10_leakage", "SELECT 'lag1' AS feature, 0::BIGINT AS changed_before, true AS follows_y UNION ALL SELECT 'rolling_mean_lag1_window_size4', 0, true UNION ALL SELECT 'count_workdays', 0, false")
def m10(s):
    def rebuild(panel):
        made = FE.weekly_features(panel, [1], {1: 4}).withColumn("at", F.date_sub("ds", 7))
        return P.on_calendar(made, s.calendar).select("unique_id", "at", "lag1", "rolling_mean_lag1_window_size4", "count_workdays")

    made = rebuild(s.panel)
    if odd := G.feature_partition(made, ["unique_id", "at"], {"follows_y": ["lag1", "rolling_mean_lag1_window_size4"], "calendar": ["count_workdays"]}):
        raise G.GateError(f"features in no part, or in two: {odd}")
    cut = s.panel.agg(F.date_sub(F.max("ds"), 140)).first()[0]
    got = G.leakage(s.panel, rebuild, ["unique_id", "at"], ["lag1", "rolling_mean_lag1_window_size4", "count_workdays"], "at", F.lit(cut))
    return got.select("feature", "changed_before", (F.col("changed_after") > 0).alias("follows_y"))


@q("m11_fold_population", "SELECT count(*) AS n_rows, count(*) FILTER (horizon <> 'horizon_1') AS n_other_horizon, 0::BIGINT AS n_unknown_tier, (5 - count(DISTINCT tier))::BIGINT AS n_missing_tier FROM ms")
def m11(s):
    return G.fold_population(s.series, R.TIERS)


@q("m12_exogenous_checks", "SELECT unnest(['calendar_dates', 'exog_keys', 'panel_coverage']) AS gate, 0::BIGINT AS violations")
def m12(s):
    extra = FE.additional_exogenous(s.panel, s.calendar)
    count = lambda df, n: df.agg(F.count("*").alias("violations")).select(F.lit(n).alias("gate"), "violations")
    return count(G.unique_keys(s.calendar, ["ds"]), "calendar_dates").union(count(G.unique_keys(extra, ["unique_id", "ds"]), "exog_keys")).union(count(G.unmatched(s.panel, extra, ["unique_id", "ds"]), "panel_coverage"))


@q("m13_parity", f"SELECT {FOLD}, unique_id, 'differs' AS problem FROM base WHERE abs(fc - fb) > 1e-8 + 1e-9 * abs(fb)")
def m13(s):
    a, b = (s.series.where(F.col("model") == m) for m in ("recent_mean", "naive"))
    return G.parity(a, b, M.KEYS, ["tier", "horizon"], ["monthly_forecast", "series_weight", "actual_monthly_total"])


@q("m13_expected_counts", "SELECT count(DISTINCT target_month) AS target_months, count(DISTINCT forecast_origin_date) AS origins, count(DISTINCT unique_id) AS series, count(*) AS events FROM spine JOIN month_totals ON fiscal_year_month = target_month WHERE target_month IN (SELECT fiscal_year_month FROM months, last_complete l WHERE months.month_index BETWEEN l.i - 2 AND l.i)")
def m13_counts(s):
    months = O.months(s.calendar).crossJoin(F.broadcast(s.last)).where("month_index between last_index - 2 and last_index").select(F.col("fiscal_year_month").alias("target_month"))
    return G.expected_counts(s.spine, s.totals, months)


@_gate("m14_reconstruction", "SELECT count(*) FROM ms")
def m14(s):
    keys = ["model", *R.KEYS]
    bad = G.reconstruction(s.series, s.components.join(s.series.select(*keys), keys, "left_semi"), keys).agg(F.count("*").alias("v"))
    n = s.series.agg(F.count("*").alias("checked")).crossJoin(bad)
    return n.select(F.lit("m14_reconstruction").alias("gate"), "checked", F.col("v").alias("violations"), (F.col("v") == 0).alias("ok"))


@q(
    "m15_base_frame",
    """SELECT 'study' AS frame, count(*) AS n_rows, 0::BIGINT AS n_repeated, 0::BIGINT AS n_left_only, 0::BIGINT AS n_right_only, 0::BIGINT AS n_other_tier, 0::BIGINT AS n_other_weight, 0::BIGINT AS n_other_actual, 0::BIGINT AS n_null_inputs, 0::BIGINT AS n_not_in_calendar FROM base
  UNION ALL SELECT 'planted', count(*), 0, count(*) FILTER (unique_id = 3), count(*) FILTER (unique_id = 5), count(*) FILTER (unique_id = 7 AND tier <> 'low'), count(*) FILTER (unique_id = 8), count(*) FILTER (unique_id = 9), count(*) FILTER (unique_id = 10), count(*) FILTER (forecast_origin_date = (SELECT min(forecast_origin_date) FROM base)) FROM base""",
)
def m15(s):
    """The study's frame, and one with a series on one side only, others whose tier, weight or actual differs or whose forecast is
    null, and a calendar without the first origin."""
    c, b = (s.series.where(F.col("model") == m) for m in ("recent_mean", "naive"))
    of = lambda i, c, x: F.when(F.col("unique_id") == i, x).otherwise(F.col(c))
    c2 = c.where("unique_id <> 5").withColumn("monthly_forecast", of(10, "monthly_forecast", F.lit(None)))
    b2 = b.where("unique_id <> 3").withColumns({"tier": of(7, "tier", F.lit("low")), "series_weight": of(8, "series_weight", F.col("series_weight") + 1), "actual_monthly_total": of(9, "actual_monthly_total", F.col("actual_monthly_total") + 1)})
    first = s.base.agg(F.min("forecast_origin_date").alias("ds"))
    planted = G.base_frame_checks(M.base_frame(c2, b2), s.calendar.join(first, "ds", "left_anti"))
    return G.base_frame_checks(s.base, s.calendar).select(F.lit("study").alias("frame"), "*").unionByName(planted.select(F.lit("planted").alias("frame"), "*"))


@q("m16_calendars_agree", "SELECT forecast_origin_date AS ds FROM origins JOIN cal ON cal.ds = forecast_origin_date WHERE count_workdays = 4")
def m16(s):
    other = s.calendar.withColumn("count_workdays", F.lit(5))
    return G.calendars_agree(s.calendar, other, s.origins, ["fiscal_year_month", "count_workdays"])


@q("m17_tier_prefix", "SELECT 'very_low,low,middle,high,very_high' AS present, true AS is_prefix, true AS all_known FROM (SELECT count(DISTINCT tier) AS n FROM ms) WHERE n = 5")
def m17(s):
    return G.tier_prefix(s.series, R.TIERS).withColumn("present", F.array_join("present", ","))


@_gate("m18_unique_keys", "SELECT count(*) FROM ms")
def m18(s):
    keys = ["model", *R.KEYS]
    rows = s.series.groupBy(*keys).agg(F.count("*").alias("n"))
    return G.check("m18_unique_keys", rows, F.col("n") > 1)


@q("m19_frame_difference", "SELECT 'monthly_forecast' AS \"column\", count(*) AS rows_compared, sum((fc IS DISTINCT FROM fb)::INT)::BIGINT AS rows_different, max(abs(fc - fb)) AS max_abs_delta FROM base UNION ALL SELECT 'actual_monthly_total', count(*), 0, 0.0 FROM base", r=("max_abs_delta",))
def m19(s):
    cols = [*M.KEYS, "monthly_forecast", "actual_monthly_total"]
    a, b = (s.series.where(F.col("model") == m).select(*cols) for m in ("recent_mean", "naive"))
    return G.frame_difference(a, b, M.KEYS)


@q("m19_same_rows", "SELECT (SELECT count(*) FROM weekly_sales WHERE (unique_id, ds, y) NOT IN (SELECT (unique_id, ds, y) FROM panel)) AS only_left, (SELECT count(*) FROM panel WHERE (unique_id, ds, y) NOT IN (SELECT (unique_id, ds, y) FROM weekly_sales)) AS only_right")
def m19_rows(s):
    return G.same_rows(P.weekly_sums(X.sales(s.spark, s.sf)), s.panel)


@q("m19_schema_difference", "SELECT 'model' AS \"column\", 'string' AS a, CAST(NULL AS VARCHAR) AS b UNION ALL SELECT 'tier_rank', 'int', 'bigint' FROM (SELECT count(*) AS n FROM ms) WHERE n > 0")
def m19_schema(s):
    return G.schema_difference(s.series, s.series.drop("model").withColumn("tier_rank", F.col("tier_rank").cast("long")))


@q(
    "m20_report",
    """SELECT gate, checked, violations, violations = 0 AND checked > 0 AS ok, CASE WHEN violations = 0 AND checked > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
  SELECT unnest(['series_keys', 'origins_in_calendar', 'known_tiers', 'weights_not_negative']) AS gate, (SELECT count(*) FROM ms) AS checked, 0::BIGINT AS violations
  UNION ALL SELECT unnest(['component_keys', 'exact_reconstruction']), (SELECT count(*) FROM ms), 0
  UNION ALL SELECT 'forecast_keys', count(*), 0 FROM forecasts UNION ALL SELECT 'forecast_weeks_after_origin', count(*), 0 FROM forecasts
  UNION ALL SELECT 'forecast_is_actual', count(*), sum((monthly_forecast <> actual_monthly_total)::INT)::BIGINT FROM ms)""",
)
def m20(s):
    """A run's outputs checked one by one; the last check is one that fails."""
    keys, tiers = ["model", *R.KEYS], ["very_low", "low", "middle", "high", "very_high"]
    known = s.calendar.select(F.col("ds").alias("forecast_origin_date"), F.lit(True).alias("known"))
    both = s.series.select(*keys, "monthly_forecast").join(s.components.join(s.series.select(*keys), keys, "left_semi").select(*keys, "mtd_revenue", "predicted_remaining", F.lit(True).alias("there")), keys, "full_outer")
    rebuilt = (F.col("mtd_revenue").cast(P.MONEY) + F.col("predicted_remaining").cast(P.MONEY)).cast("double")
    repeated = lambda df, by: df.groupBy(*by).agg(F.count("*").alias("n"))
    return G.report(
        [
            G.check("series_keys", repeated(s.series, keys), F.col("n") > 1),
            G.check("origins_in_calendar", s.series.join(F.broadcast(known), "forecast_origin_date", "left"), F.col("known").isNull()),
            G.check("known_tiers", s.series, ~F.col("tier").isin(tiers)),
            G.check("weights_not_negative", s.series, F.col("series_weight") < 0),
            G.check("component_keys", both, F.col("there").isNull() | F.col("monthly_forecast").isNull()),
            G.check("exact_reconstruction", both, ~F.col("monthly_forecast").eqNullSafe(rebuilt)),
            G.check("forecast_keys", repeated(s.forecasts, ["model", "forecast_origin_date", "unique_id", "ds"]), F.col("n") > 1),
            G.check("forecast_weeks_after_origin", s.forecasts, F.col("ds") <= F.col("forecast_origin_date")),
            G.check("forecast_is_actual", s.series, F.col("monthly_forecast") != F.col("actual_monthly_total")),
        ]
    )


@q("m21_run_agreement", "SELECT 'base' AS table_name, count(*) AS n_rows, 0::BIGINT AS n_other_run FROM base UNION ALL SELECT 'series', count(*), count(*) FILTER (unique_id % 5 > 2) FROM ms")
def m21(s):
    """Tables as a run wrote them: one is the run's own, in the other are rows that another run and no run stamped."""
    root = f"{shared_dir(s.spark)}/agreement-{uuid.uuid4().hex}"
    stamps = {"base": (s.base.drop("differs"), F.lit("run-1")), "series": (s.series, F.expr(MIXED))}
    for name, (df, run) in stamps.items():
        df.withColumn("run_id", run).write.parquet(f"{root}/{name}")
    return G.other_runs({name: s.spark.read.parquet(f"{root}/{name}") for name in stamps}, "run-1")


@q(
    "m22_self_score",
    f"""SELECT 'self_score' AS gate, count(*) AS checked, count(*) FILTER (abs(value - 1) > 1e-9) AS violations FROM ({SCORES}) WHERE model = 'naive' AND metric IN ('wrmae_pooled', 'wrmae_per_series') AND value IS NOT NULL
  UNION ALL SELECT 'mean_of_folds', (SELECT count(*) FROM (SELECT DISTINCT model, horizon, tier, metric FROM ({SCORES}))), 0
  UNION ALL SELECT 'weightless_slices', count(*), count(*) FILTER (value IS NOT NULL AND wsum <= 1e-12) FROM ({SCORES}) z JOIN (SELECT horizon, forecast_origin_date, predicted_fiscal_year_month, tier, sum(w) AS wsum FROM base GROUP BY ALL) x USING (horizon, forecast_origin_date, predicted_fiscal_year_month, tier) WHERE metric IN ('wrmae_pooled', 'wrmae_per_series')""",
)
def m22(s):
    """The benchmark scores 1 against itself, a summary is the mean of its folds, and a slice without weight has no weighted score."""
    weighted = F.col("metric").isin("wrmae_pooled", "wrmae_per_series")
    own = s.scores.where((F.col("model") == "naive") & weighted & F.col("value").isNotNull())
    keys = ["model", "horizon", "tier", "metric"]
    sums = s.base.groupBy("horizon", *M.FOLD, "tier").agg(F.sum("w").alias("wsum"))
    slices = s.scores.where(weighted).join(sums, ["horizon", *M.FOLD, "tier"])
    count = lambda name, df, bad: df.agg(F.lit(name).alias("gate"), F.count("*").alias("checked"), F.count_if(bad).alias("violations"))
    out = count("self_score", own, F.abs(F.col("value") - 1) > 1e-9)
    summary = M.summary_scores(s.scores)
    wrong = G.mean_of_folds(summary, s.scores).select(*keys, F.lit(True).alias("wrong"))
    out = out.unionByName(count("mean_of_folds", summary.join(wrong, keys, "left"), F.coalesce("wrong", F.lit(False))))
    return out.unionByName(count("weightless_slices", slices, F.col("value").isNotNull() & (F.col("wsum") <= 1e-12)))


@_gate("m23_ambiguous_weeks", "SELECT count(DISTINCT ds) FROM panel")
def m23(s):
    weeks = s.panel.select("ds").distinct()
    return G.check("m23_ambiguous_weeks", weeks.join(G.ambiguous_weeks(s.calendar), "ds", "left"), F.col("months").isNotNull())


#: The month whose calendar rows the matrix drops, doubles or renames.
SPOILT = "(SELECT max(fiscal_year_month) FROM months WHERE fiscal_year_month < (SELECT m FROM last_complete))"
SPOILT_SCORES = SCORES.replace("* REPLACE (fb AS fc)", "* REPLACE (fb + 1 AS fc)")


@q(
    "m_mutation_matrix",
    f"""SELECT 'm2' AS gate, 'weeks dropped from the calendar' AS mutation, count(DISTINCT ds) AS violations FROM pc WHERE fiscal_year_month = {SPOILT}
  UNION ALL SELECT 'm4', 'lag 1 shifted by a week', count(*) FROM (SELECT unique_id, lag(y, 1) OVER w AS a, lag(y, 2) OVER w AS b FROM panel WINDOW w AS (PARTITION BY unique_id ORDER BY ds)) WHERE unique_id = 3 AND a IS DISTINCT FROM b
  UNION ALL SELECT 'm6', 'one added to a total', count(*) FROM grid WHERE unique_id = 3 AND weeks_actualized = weeks_in_month - 1
  UNION ALL SELECT 'm7', 'one added to a remainder', count(*) FROM grid WHERE unique_id = 5
  UNION ALL SELECT 'm9', 'a lag taken a week later', count(*) FROM grid g LEFT JOIN panel p ON p.unique_id = g.unique_id AND p.ds = g.forecast_origin_date LEFT JOIN panel n ON n.unique_id = g.unique_id AND n.ds = g.forecast_origin_date + 7 WHERE g.unique_id = 7 AND p.y IS DISTINCT FROM n.y
  UNION ALL SELECT 'm12_dates', 'calendar weeks doubled', count(*) FROM cal WHERE fiscal_year_month = {SPOILT}
  UNION ALL SELECT 'm12_keys', 'a series doubled', count(*) FROM cal WHERE ds >= (SELECT min(ds) FROM panel WHERE unique_id = 3)
  UNION ALL SELECT 'm12_coverage', 'a series dropped', count(*) FROM panel WHERE unique_id = 5
  UNION ALL SELECT 'm14', 'one added to a forecast', count(*) FROM ms WHERE unique_id = 3
  UNION ALL SELECT 'm18', 'a series doubled', count(*) FROM ms WHERE unique_id = 3
  UNION ALL SELECT 'm22_self_score', 'one added to the benchmark', count(*) FROM ({SPOILT_SCORES}) WHERE model = 'naive' AND metric IN ('wrmae_pooled', 'wrmae_per_series') AND abs(value - 1) > 1e-9
  UNION ALL SELECT 'm22_mean_of_folds', 'one added to a summary', count(*) FROM (SELECT model, horizon, tier, metric FROM ({SCORES}) WHERE tier = 'global' GROUP BY ALL HAVING count(value) > 0)
  UNION ALL SELECT 'm22_mean_of_folds', 'folds pooled over tiers', count(*) FROM (SELECT model, horizon, tier, metric, avg(value) AS v FROM ({SCORES}) GROUP BY ALL) a JOIN (SELECT model, horizon, metric, avg(value) AS v FROM ({SCORES}) GROUP BY ALL) b USING (model, horizon, metric) WHERE a.v IS DISTINCT FROM b.v AND coalesce(abs(a.v - b.v) > 1e-12 + 1e-12 * abs(a.v), true)
  UNION ALL SELECT 'm23', 'weeks in two months', count(*) FROM cal WHERE fiscal_year_month = {SPOILT}""",
)
def m_matrix(s):
    """Each gate on a frame with a defect of its kind: the counts are those of the rows that the defect touches."""
    month = O.months(s.calendar).crossJoin(F.broadcast(s.last)).where("fiscal_year_month < last_month").agg(F.max("fiscal_year_month").alias("m"))
    spoilt = s.calendar.join(F.broadcast(month), F.col("fiscal_year_month") == F.col("m"), "left_semi")
    of = lambda i, c, x: F.when(F.col("unique_id") == i, x).otherwise(F.col(c))
    later = s.panel.select("unique_id", F.date_sub("ds", 7).alias("forecast_origin_date"), F.col("y").alias("late"))
    shifted = s.modelling_table.join(later, ["unique_id", "forecast_origin_date"], "left").withColumn("lag1", of(7, "lag1", F.col("late"))).drop("late")
    extra, keys = FE.additional_exogenous(s.panel, s.calendar), ["model", *R.KEYS]
    both = M.both_models(s.base, "recent_mean", "naive")
    own = M.fold_scores(both.withColumn("fc", F.when(F.col("model") == "naive", F.col("fc") + 1).otherwise(F.col("fc"))))
    self_score = own.where((F.col("model") == "naive") & F.col("metric").isin("wrmae_pooled", "wrmae_per_series") & (F.abs(F.col("value") - 1) > 1e-9))
    summary = M.summary_scores(s.scores)
    pooled = s.scores.groupBy("model", "horizon", "metric").agg(F.avg("value").alias("value"))
    cases = {
        ("m2", "weeks dropped from the calendar"): G.uncovered_weeks(s.panel, s.calendar.join(spoilt.select("ds"), "ds", "left_anti")),
        ("m4", "lag 1 shifted by a week"): G.lag_alignment(s.weekly_features.withColumn("lag1", of(3, "lag1", F.col("lag2"))), s.panel, 1),
        ("m6", "one added to a total"): G.total_reconciliation(s.table.withColumn("actual_monthly_total", of(3, "actual_monthly_total", F.col("actual_monthly_total") + 1)), s.panel, s.calendar).where(~F.col("ok")),
        ("m7", "one added to a remainder"): G.remaining_identity(FE.remaining_target(s.table).withColumn("remaining_target", of(5, "remaining_target", F.col("remaining_target") + 1)), s.panel, s.calendar).where(~F.col("ok")),
        ("m9", "a lag taken a week later"): G.shared_cutoff(shifted, s.panel, [1]),
        ("m12_dates", "calendar weeks doubled"): G.unique_keys(s.calendar.unionByName(spoilt), ["ds"]),
        ("m12_keys", "a series doubled"): G.unique_keys(extra.unionByName(extra.where("unique_id = 3")), ["unique_id", "ds"]),
        ("m12_coverage", "a series dropped"): G.unmatched(s.panel, extra.where("unique_id <> 5"), ["unique_id", "ds"]),
        ("m14", "one added to a forecast"): G.reconstruction(s.series.withColumn("monthly_forecast", of(3, "monthly_forecast", F.col("monthly_forecast") + 1)), s.components.join(s.series.select(*keys), keys, "left_semi"), keys),
        ("m18", "a series doubled"): G.unique_keys(s.series.unionByName(s.series.where("unique_id = 3")), keys),
        ("m22_self_score", "one added to the benchmark"): self_score,
        ("m22_mean_of_folds", "one added to a summary"): G.mean_of_folds(summary.withColumn("value", F.when(F.col("tier") == "global", F.col("value") + 1).otherwise(F.col("value"))), s.scores),
        ("m22_mean_of_folds", "folds pooled over tiers"): G.mean_of_folds(summary.drop("value").join(pooled, ["model", "horizon", "metric"]), s.scores),
        ("m23", "weeks in two months"): G.ambiguous_weeks(s.calendar.unionByName(spoilt.withColumn("fiscal_year_month", F.col("fiscal_year_month") + 1))),
    }
    return G.mutations_seen(cases)


# -- monitoring --------------------------------------------------------------------------------

STATUS = "SELECT unique_id, fiscal_year_month, CASE WHEN count(y) < count(*) THEN 'gapped' WHEN count(*) < max(weeks_in_month) THEN 'incomplete' ELSE 'complete' END AS status, CASE WHEN count(y) = count(*) AND count(*) = max(weeks_in_month) THEN CAST(sum(CAST(y AS DECIMAL(18,2))) AS DOUBLE) END AS total FROM gappy g JOIN cal ON cal.ds = g.ds GROUP BY ALL"
GAPPY = "(SELECT s.unique_id, c.ds, w.y FROM (SELECT unique_id, min(ds) AS a FROM weekly_sales GROUP BY 1) s JOIN cal c ON c.ds >= s.a AND c.ds <= (SELECT max(ds) FROM weekly_sales) LEFT JOIN weekly_sales w ON w.unique_id = s.unique_id AND w.ds = c.ds)"
STATUS = STATUS.replace("gappy", GAPPY)


def _gappy(s):
    return P.reindexed(P.weekly_sums(X.sales(s.spark, s.sf)), s.calendar)


@q("n1_reindexed_weeks", f"SELECT * FROM {GAPPY}")
def n1(s):
    return _gappy(s)


@q("n2_month_status", STATUS)
def n2(s):
    return N.monthly_status(_gappy(s), s.calendar)


@q("n3_fold_members", "SELECT DISTINCT forecast_origin_date, unique_id FROM base")
def n3(s):
    return N.fold_members(s.base)


#: Members that change: every third series is left out at the origins of even months.
CHANGING = "NOT (unique_id % 3 = 1 AND month(forecast_origin_date) % 2 = 0)"
GLOBAL = f"SELECT forecast_origin_date, fiscal_year_month, CASE WHEN bool_or(status = 'gapped') THEN 'gapped' WHEN bool_or(status = 'complete') THEN 'complete' ELSE 'incomplete' END AS status, CASE WHEN NOT bool_or(status = 'gapped') THEN CAST(sum(CAST(total AS DECIMAL(18,2))) AS DOUBLE) END AS total FROM ({STATUS}) JOIN (SELECT DISTINCT forecast_origin_date, unique_id FROM base) USING (unique_id) GROUP BY ALL"
CHANGING_GLOBAL = GLOBAL.replace("FROM base)", f"FROM base WHERE {CHANGING})")


@q("n4_global_month", GLOBAL)
def n4(s):
    return N.global_monthly(N.monthly_status(_gappy(s), s.calendar), N.fold_members(s.base))


@q("n4_changing_members", CHANGING_GLOBAL)
def n4_changing(s):
    return N.global_monthly(N.monthly_status(_gappy(s), s.calendar), N.fold_members(s.base.where(CHANGING)))


POINTS = f"SELECT {FOLD}, horizon, CAST(sum(CAST(fc AS DECIMAL(18,2))) AS DOUBLE) AS challenger, CAST(sum(CAST(fb AS DECIMAL(18,2))) AS DOUBLE) AS benchmark, CAST(sum(CAST(a AS DECIMAL(18,2))) AS DOUBLE) AS actual, any_value(last_ds) AS ds FROM base JOIN months ON months.fiscal_year_month = predicted_fiscal_year_month GROUP BY {FOLD}, horizon"


@q("n5_forecast_points", POINTS)
def n5(s):
    return N.forecast_points(s.base, s.calendar)


WEEKS = f"SELECT forecast_origin_date, ds, CASE WHEN count(y) = count(*) THEN CAST(sum(CAST(y AS DECIMAL(18,2))) AS DOUBLE) END AS y FROM {GAPPY} JOIN (SELECT DISTINCT forecast_origin_date, unique_id FROM base) USING (unique_id) GROUP BY ALL"


@q("n6_weekly_sum", WEEKS)
def n6(s):
    return N.weekly_sum(_gappy(s), N.fold_members(s.base))


WF = f"SELECT DISTINCT f.model, f.forecast_origin_date, f.ds, f.predicted_fiscal_year_month, f.ypred, m.horizon FROM (SELECT model, forecast_origin_date, ds, fiscal_year_month AS predicted_fiscal_year_month, CAST(sum(round(ypred, 2)::DECIMAL(18,2)) AS DOUBLE) AS ypred FROM forecasts GROUP BY ALL) f JOIN (SELECT DISTINCT {FOLD}, horizon FROM base) m USING ({FOLD})"


def _weekly_forecast(s):
    rows = s.forecasts.join(F.broadcast(s.calendar.select("ds", F.col("fiscal_year_month").alias("predicted_fiscal_year_month"))), "ds")
    return N.weekly_forecast(rows, s.base)


@q("n6_weekly_forecast", WF, r=("ypred",))
def n6_forecast(s):
    return _weekly_forecast(s)


@q("e15_month_changes", f"SELECT model, forecast_origin_date, before, ds, CAST(before + CAST((ds - before) // 2 AS INTEGER) AS DATE) AS midpoint FROM (SELECT *, lag(ds) OVER w AS before, lag(predicted_fiscal_year_month) OVER w AS mb FROM ({WF}) WINDOW w AS (PARTITION BY model, forecast_origin_date ORDER BY ds)) WHERE mb <> predicted_fiscal_year_month")
def e15(s):
    return N.month_changes(_weekly_forecast(s))


FOLDS_SEEN = f"(SELECT * FROM base WHERE {CHANGING})"
LAST_WEEK = "(SELECT fiscal_year_month, last_ds AS ds FROM months)"
LINES = f"""SELECT CAST(unique_id AS VARCHAR) AS facet, CAST(NULL AS DATE) AS forecast_origin_date, 'week' AS grain, 'actual' AS line, g.ds, c.fiscal_year_month, CAST(NULL AS VARCHAR) AS horizon, y FROM {GAPPY} g JOIN cal c ON c.ds = g.ds
  UNION ALL SELECT CAST(unique_id AS VARCHAR), NULL, 'month', 'actual', ds, fiscal_year_month, NULL, total FROM ({STATUS}) JOIN {LAST_WEEK} USING (fiscal_year_month)
  UNION ALL SELECT 'global', forecast_origin_date, 'week', 'actual', w.ds, c.fiscal_year_month, NULL, y FROM ({WEEKS.replace("FROM base)", f"FROM base WHERE {CHANGING})")}) w JOIN cal c ON c.ds = w.ds
  UNION ALL SELECT 'global', forecast_origin_date, 'month', 'actual', ds, fiscal_year_month, NULL, total FROM ({CHANGING_GLOBAL}) JOIN {LAST_WEEK} USING (fiscal_year_month)
  UNION ALL SELECT CAST(unique_id AS VARCHAR), forecast_origin_date, 'month', line, ds, fiscal_year_month, horizon, CASE line WHEN 'challenger' THEN fc ELSE fb END FROM {FOLDS_SEEN} b, (SELECT unnest(['challenger', 'benchmark']) AS line) JOIN {LAST_WEEK} m ON m.fiscal_year_month = b.predicted_fiscal_year_month
  UNION ALL SELECT 'global', forecast_origin_date, 'month', line, any_value(ds), fiscal_year_month, horizon, CAST(sum(CAST(CASE line WHEN 'challenger' THEN fc ELSE fb END AS DECIMAL(18,2))) AS DOUBLE) FROM {FOLDS_SEEN} b, (SELECT unnest(['challenger', 'benchmark']) AS line) JOIN {LAST_WEEK} m ON m.fiscal_year_month = b.predicted_fiscal_year_month GROUP BY forecast_origin_date, fiscal_year_month, horizon, line
  UNION ALL SELECT CAST(f.unique_id AS VARCHAR), f.forecast_origin_date, 'week', f.model, f.ds, f.fiscal_year_month, b.horizon, round(f.ypred, 2) FROM forecasts f JOIN {FOLDS_SEEN} b ON b.forecast_origin_date = f.forecast_origin_date AND b.predicted_fiscal_year_month = f.fiscal_year_month AND b.unique_id = f.unique_id
  UNION ALL SELECT 'global', f.forecast_origin_date, 'week', f.model, f.ds, any_value(f.fiscal_year_month), b.horizon, CAST(sum(round(f.ypred, 2)::DECIMAL(18,2)) AS DOUBLE) FROM forecasts f JOIN {FOLDS_SEEN} b ON b.forecast_origin_date = f.forecast_origin_date AND b.predicted_fiscal_year_month = f.fiscal_year_month AND b.unique_id = f.unique_id GROUP BY f.forecast_origin_date, f.model, f.ds, b.horizon"""


@q("n7_facet", LINES, r=("y",))
def n7(s):
    """Over folds whose members change."""
    weekly = _gappy(s)
    return N.facets(weekly, N.monthly_status(weekly, s.calendar), s.base.where(CHANGING), s.forecasts, s.calendar)


@q("n8_scorecard", f"SELECT model, tier, avg(value) FILTER (horizon = 'horizon_1') AS horizon_1_value, (sum(n_obs) FILTER (horizon = 'horizon_1'))::BIGINT AS horizon_1_n_obs, avg(value) FILTER (horizon = 'horizon_2') AS horizon_2_value, (sum(n_obs) FILTER (horizon = 'horizon_2'))::BIGINT AS horizon_2_n_obs FROM ({SCORES}) WHERE metric = 'wape' GROUP BY ALL", r=("horizon_1_value", "horizon_2_value"))
def n8(s):
    return N.scorecard(M.summary_scores(s.scores), "wape", ["horizon_1", "horizon_2"])


@q("n9_skill_by_origin", f"SELECT metric, model, horizon, forecast_origin_date, avg(value) AS value, count(value) AS n_folds FROM ({SCORES}) WHERE tier = 'global' GROUP BY ALL", r=("value",))
def n9(s):
    out = None
    for metric in M.SCORED:
        rows = N.skill_by_origin(s.scores, metric).withColumn("metric", F.lit(metric))
        out = rows if out is None else out.unionByName(rows)
    return out


@q("n10_cohort_means", f"SELECT metric, model, horizon, weeks_in_month, fiscal_week_of_month AS weeks_elapsed, avg(value) AS value, count(value) AS n_defined FROM ({SCORES}) s JOIN cal ON ds = forecast_origin_date WHERE tier = 'global' GROUP BY ALL", r=("value",))
def n10(s):
    return N.cohort_means(s.scores, s.calendar).where("tier = 'global'").select("metric", "model", "horizon", "weeks_in_month", "weeks_elapsed", "value", "n_defined")


@q("n11_top_shares", f"SELECT horizon, unique_id, x, y, y - x AS net FROM (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY x DESC, unique_id) AS k FROM ({BY_HORIZON})) WHERE k <= 20", r=("x", "y", "net"))
def n11(s):
    down = Window.partitionBy("horizon").orderBy(F.desc("x"), "unique_id")
    return M.horizon_shares(s.base).withColumn("k", F.row_number().over(down)).where("k <= 20").select("horizon", "unique_id", "x", "y", "net")


@q("h19_tiers_held", _held("ms", "model"))
def h19(s):
    return N.tiers_held(s.series, ["model"])


# -- models that need a fit: rows only ------------------------------------------------------------


@q("k9_boosted_recursive")
def k9(s):
    return FC.boosted_from_origins(s.panel, s.calendar, s.origins)


#: Fixed value: the evaluation's target months, as many as the reference has.
TARGET_MONTHS = 6
DIRECT_ROUNDS, FINAL_ROUNDS = 24, 12


#: Inputs of the direct-month model, in units of the series' level.
DIRECT = ["mtd_revenue", "lag1", "lag2", "rolling_mean_lag1_window_size4", "last_completed_month_revenue"]


@q("k10_direct_month")
def k10(s):
    """A model of month totals for each of the last target months, fitted on the months before it, with levels as of its first origin; all
    fits go through the same jobs."""
    table = s.modelling_table.dropna(subset=[*DIRECT, "actual_monthly_total"])
    months = table.groupBy("target_month").agg(F.min("forecast_origin_date").alias("until")).orderBy(F.desc("target_month")).limit(TARGET_MONTHS)
    fits = months.select(F.col("target_month").alias("month"), "until", (F.row_number().over(Window.orderBy("target_month")) - 1).alias("fit"))
    per = lambda c: F.col(c) / F.col("level")
    rows = table.join(F.broadcast(fits), F.col("target_month") <= F.col("month")).join(FC.levels(s.panel, fits), ["fit", "unique_id"])
    rows = rows.select("fit", "month", "unique_id", "forecast_origin_date", "target_month", "level", per("actual_monthly_total").alias("label"), *[per(c).alias(c) for c in DIRECT], *[F.col(c).cast("double").alias(c) for c in ("weeks_in_month", "weeks_actualized")])
    forest = B.fit(rows.where("target_month < month"), [*DIRECT, "weeks_in_month", "weeks_actualized"], "label", TARGET_MONTHS, DIRECT_ROUNDS)
    made = B.predicted(rows.where("target_month = month"), forest)
    return made.select("unique_id", "forecast_origin_date", "target_month", (F.get("predictions", F.lit(0)) * F.col("level")).alias("monthly_forecast"))


@q("k12_residuals")
def k12(s):
    return FC.fitted(FC.fit_boosted(s.panel, s.calendar, FC.one_fit(s.panel), FINAL_ROUNDS), s.panel, s.calendar)


@q("k13_final_fit", "SELECT max(ds) AS train_end_ds, count(DISTINCT unique_id) AS n_series, count(*) AS n_obs, 12 AS n_trees FROM panel")
def k13(s):
    forest = FC.fit_boosted(s.panel, s.calendar, FC.one_fit(s.panel), FINAL_ROUNDS)
    path = f"{shared_dir(s.spark)}/final-fit-{uuid.uuid4().hex}"
    forest.table(s.spark).write.parquet(path)
    facts = s.panel.agg(F.max("ds").alias("train_end_ds"), F.countDistinct("unique_id").alias("n_series"), F.count("*").alias("n_obs"))
    return facts.crossJoin(s.spark.read.parquet(path).where("round >= 0").agg(F.countDistinct("round").cast("int").alias("n_trees")))


@q("k14_calibration_curve")
def k14(s):
    return s.curve


@q("k15_parsimonious_rounds")
def k15(s):
    return FC.parsimonious(s.curve, ["forecast_origin_date", "horizon"])


@q("k16_pooled_rounds")
def k16(s):
    return FC.pooled_rounds(FC.parsimonious(s.curve, ["forecast_origin_date", "horizon"]))


#: Curves of given scores: for each line number the mean price of each quantity.
GIVEN = "SELECT l_linenumber, CAST(l_quantity AS INTEGER) AS rounds, CAST(avg(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS score FROM lineitem GROUP BY ALL"
CHOSEN = f"""SELECT l_linenumber, CAST(min(CASE WHEN smoothed <= best * 1.01 THEN rounds END) AS INTEGER) AS rounds, min(CASE WHEN smoothed <= best * 1.01 THEN rounds END) > 0.9 * max(rounds) AS inconclusive FROM (
  SELECT *, min(smoothed) OVER (PARTITION BY l_linenumber) AS best FROM (SELECT *, avg(score) OVER (PARTITION BY l_linenumber ORDER BY rounds ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS smoothed FROM ({GIVEN}))) GROUP BY l_linenumber"""


def _given(s):
    rows = read(s.spark, s.sf, "lineitem")
    return rows.groupBy("l_linenumber", F.col("l_quantity").cast("int").alias("rounds")).agg((F.sum(F.col("l_extendedprice").cast(P.MONEY)).cast("double") / F.count("*")).alias("score"))


@q("k15_given_scores", CHOSEN)
def k15_given(s):
    return FC.parsimonious(_given(s), ["l_linenumber"])


@q("k16_given_scores", f"SELECT list_sort(list(rounds))[1 + CAST(ceil((count(*) - 1) * 0.75) AS INTEGER)] AS rounds, avg(inconclusive::INT) AS share_inconclusive, avg(inconclusive::INT) > 0.25 AS refused FROM ({CHOSEN})", r=("share_inconclusive",))
def k16_given(s):
    return FC.pooled_rounds(FC.parsimonious(_given(s), ["l_linenumber"]))


@q("e12_centred_mean", "SELECT unique_id, ds, avg(y) OVER (PARTITION BY unique_id ORDER BY ds ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS smoothed FROM panel", r=("smoothed",))
def e12(s):
    return s.panel.select("unique_id", "ds", F.avg("y").over(Window.partitionBy("unique_id").orderBy("ds").rowsBetween(-1, 1)).alias("smoothed"))


@q(
    "k17_disjoint_calibration",
    """SELECT c.name AS calibration, max(m.fiscal_year_month) AS last_calibration_month, (SELECT min(start_month) FROM starts) AS first_start_month, max(m.fiscal_year_month) < (SELECT min(start_month) FROM starts) AS disjoint
  FROM (VALUES ('study', -1), ('a month late', 0)) c(name, k) JOIN months m ON m.month_index = (SELECT min(month_index) FROM starts) + c.k GROUP BY c.name""",
)
def k17(s):
    """The months that the study's calibration origins predict, and those of origins a month later, of which the last is a month too late."""
    m = O.months(s.calendar).select(F.col("fiscal_year_month").alias("target_month"), "month_index")
    out = None
    weeks = s.calibration_origins.select(F.explode(F.sequence(F.col("origin_week") + 1, F.col("origin_week") + F.col("horizon"))).alias("week_index")).distinct()
    predicted = s.calendar.join(weeks, "week_index", "left_semi").select("month_index").distinct()
    for name, late in (("study", 0), ("a month late", 1)):
        row = G.disjoint(m.join(predicted.select((F.col("month_index") + late).alias("month_index")), "month_index"), s.starts).select(F.lit(name).alias("calibration"), "*")
        out = row if out is None else out.unionByName(row)
    return out
