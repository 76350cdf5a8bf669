"""Registered queries against their SQL on the smallest input, and the entry point without subpackage llm."""

from __future__ import annotations

import datetime
import decimal
import importlib.util

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from panelmill.plans import example, registered
from panelmill.plans.example import Study

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAMPLE = """a1_trip_ingest a6_clustered_layout b1_date_sanity b3_curated_trips b12_pivot c4_zero_fill c10_combine_mtd_remaining c14_match_indicator c17_weekly_features_at_origin
c24_weeks_after_origin d4_month_cutoff d7_weekly_panel d10_monthly_totals d14_tiers d16_monthly_series d18_dropped_pairs d20_below_mtd e2_origin_spine e3_workday_progress e6_rolling_mean e10_rank_buckets
e14_gaps e17_autocorrelation g4_set_equality h3_trip_ids h7_date_dimension h18_choose_lambda k2_origins k8_seasonal_naive l3_wrmae_per_series l8_error_shares l9_wrmae_by_progress l14_fold_scores m5_mtd_construction
m10_leakage m19_frame_difference n2_month_status n5_forecast_points o3_mtd_shares o6_intermittency o8_dispersion_ratios
d4_daily_extract e18_partial_autocorrelation h4_local_hours h19_tiers_held k5_fixed_step_folds k15_given_scores k17_disjoint_calibration l8_horizon_shares l15_leaderboard m1_single_lineage m5_planted_defects m15_base_frame m20_report
m21_run_agreement m22_self_score n4_global_month n7_facet h10_calendar_by_table j1_future_regressor j1_fitted_values h18_guerrero_lambda m_mutation_matrix n4_changing_members n6_weekly_sum a11_leaderboard_scan d25_describe o4_share_distribution""".split()


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return None if v != v else round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in data), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, duck, name):
    df = registered.QUERIES[name](spark, SF)
    want = duck.sql(registered.ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    a, b = table(df.columns, [tuple(r) for r in df.collect()]), table(want.columns, want.fetchall())
    assert len(a) == len(b)
    off = [(x, y) for x, y in zip(a, b) if x != y and any(p != q and not (isinstance(p, float) and isinstance(q, float) and abs(p - q) <= 2e-6 * max(1, abs(q))) for p, q in zip(x, y))]
    assert not off[:3]


def test_direct_month_has_all_target_months(spark):
    made = registered.QUERIES["k10_direct_month"](spark, SF).select("target_month", "monthly_forecast").collect()
    table = Study.of(spark, SF).modelling_table.where("actual_monthly_total IS NOT NULL").select("target_month").distinct()
    assert sorted({r.target_month for r in made}) == sorted(r[0] for r in table.collect())[-6:]
    assert all(r.monthly_forecast is not None for r in made)


def test_tasks_of_bounded_trips_do_not_grow(spark, duck, monkeypatch):
    monkeypatch.setattr(example, "TASK_TRIPS", 500)
    plain, bounded = (example.silver_trips(spark, SF, bounded=b) for b in (False, True))
    assert plain.exceptAll(bounded).count() == bounded.exceptAll(plain).count() == 0
    parts = bounded.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"), F.collect_set("order_id").alias("orders")).collect()
    assert len(parts) >= 10 and max(r.n for r in parts) <= 1000
    assert sum(len(r.orders) for r in parts) == bounded.select("order_id").distinct().count()
    df, want = registered.QUERIES["d26_trip_sketches"](spark, SF), duck.sql(registered.ORACLE["d26_trip_sketches"])
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table(want.columns, want.fetchall())


def test_every_query_is_registered_once():
    found = __spark_entry__.queries()
    assert set(registered.QUERIES) <= set(found) and set(__spark_entry__.oracle_sql()) <= set(found)


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_without_the_llm_folder(monkeypatch):
    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name.startswith("panelmill.llm") or name == "corpus_pipeline" else real(name, *a))
    assert set(__spark_entry__.queries()) == set(registered.QUERIES)
    assert set(__spark_entry__.oracle_sql()) == set(registered.ORACLE)
