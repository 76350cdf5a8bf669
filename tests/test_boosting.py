"""Boosted trees against a plain version in numpy, and what they are worth."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelmill.operators import boosting, forecast, gates
from panelmill.plans import registered
from panelmill.plans.example import Study

SF = "/root/testdata/sf0.01"
START = dt.date(2019, 1, 6)


def week(k: int) -> dt.date:
    return START + dt.timedelta(weeks=k)


@pytest.fixture(scope="module")
def cal(spark):
    rows = [(week(k), 201901 + k // 4 % 12 + 100 * (k // 48), k % 4 + 1, 4, (k % 4 + 1) / 4, 4 + k % 2, k + 1, k // 4 + 1) for k in range(170)]
    return spark.createDataFrame(rows, "ds date, fiscal_year_month int, fiscal_week_of_month int, weeks_in_month int, origin_month_fraction_elapsed double, count_workdays int, week_index int, month_index int").withColumn("holiday_days_in_week", F.lit(0))


def lower_median(x: np.ndarray) -> float:
    return float(np.sort(x)[math.ceil(len(x) / 2) - 1])


def plain_fit(x: np.ndarray, y: np.ndarray, edges: list[np.ndarray], rounds: int, depth: int, rate: float, least: int) -> np.ndarray:
    """Predictions of the training rows after 0, 1, ... trees, split by split over all cuts."""
    bins = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
    made = [np.full(len(y), lower_median(y))]
    for _ in range(rounds):
        r = y - made[-1]
        g = np.sign(r)
        node = np.zeros(len(y), dtype=int)
        for _ in range(depth):
            new = 2 * node
            for k in np.unique(node):
                rows = np.flatnonzero(node == k)
                best = (1e-9, None, None)
                for f in range(x.shape[1]):
                    for cut in range(boosting.BINS - 1):
                        left = bins[rows, f] <= cut
                        if left.sum() < least or (~left).sum() < least:
                            continue
                        gain = g[rows][left].sum() ** 2 / left.sum() + g[rows][~left].sum() ** 2 / (~left).sum() - g[rows].sum() ** 2 / len(rows)
                        if gain > best[0]:
                            best = (gain, f, cut)
                if best[1] is not None:
                    new[rows] += bins[rows, best[1]] > best[2]
            node = new
        step = np.zeros(len(y))
        for k in np.unique(node):
            step[node == k] = rate * lower_median(r[node == k])
        made.append(made[-1] + step)
    return np.stack(made, axis=1)


def test_forests_equal_plain_boosting(spark):
    r = np.random.default_rng(1)
    x = r.integers(0, 20, (400, 3)).astype(float)
    y = np.where(x[:, 0] > 9, 5.0, 0.0) + 0.5 * x[:, 1] + r.integers(0, 9, 400) / 7
    fit = np.arange(400) % 2
    rows = spark.createDataFrame([(int(f), *map(float, a), float(b)) for f, a, b in zip(fit, x, y)], "fit int, a double, b double, c double, y double").repartition(3)
    forest = boosting.fit(rows, ["a", "b", "c"], "y", 2, 20, depth=2, rate=0.3, least=5)
    got = forest.prefixes(fit, x)
    for k in (0, 1):
        want = plain_fit(x[fit == k], y[fit == k], list(forest.edges), 20, 2, 0.3, 5)
        assert np.allclose(got[fit == k], want)
    made = {(q.a, q.b, q.c, q.fit): q.predictions for q in boosting.predicted(rows.drop("y"), forest, [0, 7, 20]).collect()}
    assert all(np.allclose(made[(*a, f)], p[[0, 7, 20]]) for a, f, p in zip(map(tuple, x.tolist()), fit.tolist(), got))
    saved = forest.table(spark)
    assert saved.where("round >= 0").count() == 2 * 20 * (3 + 4) and saved.where("round = -1").count() == 2


@pytest.mark.parametrize("rounds", [1, 5, 18])
def test_the_first_trees_are_a_fit_of_fewer_rounds(spark, cal, rounds):
    rows = spark.createDataFrame([(i, week(k), float(10 * i + (k * i) % 5)) for i in range(1, 7) for k in range(70)], "unique_id long, ds date, y double")
    o = spark.createDataFrame([(week(60), 3, 1), (week(58), 2, 0)], "forecast_origin_date date, horizon int, fit int")
    fits = spark.createDataFrame([(0, week(58)), (1, week(60))], "fit int, until date")
    many, few = (forecast.fit_boosted(rows, cal, fits, rounds=n) for n in (18, rounds))
    a = forecast.predict_boosted(many, rows, cal, o, [1, 5, 18]).where(f"rounds = {rounds}")
    b = forecast.predict_boosted(few, rows, cal, o)
    keys = ["forecast_origin_date", "unique_id", "ds"]
    assert a.count() == 6 * (3 + 2) and gates.parity(a, b, keys, [], ["ypred"]).count() == 0
    later = rows.withColumn("y", F.when(F.col("ds") > F.lit(week(60)), 1e6).otherwise(F.col("y")))
    assert gates.parity(b, forecast.predict_boosted(few, later, cal, o), keys, [], ["ypred"]).count() == 0  # nothing after an origin counts


def test_boosting_beats_naive_and_seasonal_naive_on_a_trend(spark, cal):
    """Series that grow and have a season of a year; held out are the eight weeks after the origins."""
    r = np.random.default_rng(5)
    value = lambda i, k: (100 * i) * (1 + 0.004 * k) * (1 + 0.4 * math.sin(2 * math.pi * (START.timetuple().tm_yday + 7 * k) / 365.25)) * (1 + 0.05 * r.standard_normal())
    rows = spark.createDataFrame([(i, week(k), float(value(i, k))) for i in range(1, 21) for k in range(160)], "unique_id long, ds date, y double")
    o = spark.createDataFrame([(week(140), 141, 8), (week(150), 151, 8)], "forecast_origin_date date, origin_week int, horizon int")
    future = forecast.future_weeks(rows, o, cal)
    made = {"boosted": forecast.boosted_from_origins(rows, cal, o, refit_every=2), "naive": forecast.naive(forecast.history(rows, o, cal), future), "seasonal": forecast.seasonal_naive(forecast.history(rows, o, cal), future, 52)}
    error = {m: df.join(rows, ["unique_id", "ds"]).agg(F.avg(F.abs(F.col("ypred") - F.col("y")) / F.col("y"))).first()[0] for m, df in made.items()}
    assert made["boosted"].where("ds > forecast_origin_date").count() == 20 * 16
    assert error["boosted"] < 0.85 * error["naive"] and error["boosted"] < 0.85 * error["seasonal"], error


def test_levels_and_lags_of_a_fit_are_those_it_knows(spark, cal):
    rows = spark.createDataFrame([(1, week(k), float(k + 1)) for k in range(60)], "unique_id long, ds date, y double")
    fits = spark.createDataFrame([(0, week(9)), (1, week(57))], "fit int, until date")
    got = {(q.fit, q.ds): q for q in forecast.training_rows(rows, cal, fits).collect()}
    assert len(got) == (10 - 4) + (58 - 4) and got[0, week(9)].level == 5.5
    assert got[1, week(57)].level == np.mean(range(7, 59)) and got[1, week(57)].lag52 == 6 / got[1, week(57)].level and got[0, week(9)].lag52 == 1.0 and got[0, week(9)].has_lag52 == 0.0
    assert got[0, week(9)].rolling_mean_lag1_window_size4 == 7.5 / 5.5 and got[0, week(9)].lag1 == 9 / 5.5


def test_residuals_are_those_of_the_model(spark):
    s = Study.of(spark, SF)
    got = {(q.unique_id, q.ds): q for q in registered.QUERIES["k12_residuals"](spark, SF).collect()}
    rows = forecast.training_rows(s.panel, s.calendar, forecast.one_fit(s.panel)).collect()
    x = np.array([[q[c] for c in forecast.FEATURES] for q in rows])
    y, level = np.array([q.scaled for q in rows]), np.array([q.level for q in rows])
    forest = forecast.fit_boosted(s.panel, s.calendar, forecast.one_fit(s.panel), 2)
    want = plain_fit(x, y, list(forest.edges), 2, 3, 0.3, 10)
    assert np.allclose(forest.prefixes(np.zeros(len(y), int), x), want)
    assert len(got) == len(rows) and all(abs(got[q.unique_id, q.ds].residual - (q.y - got[q.unique_id, q.ds].fitted)) < 1e-6 for q in rows)
    error = lambda made: np.abs(np.array([q.y for q in rows]) - made).mean()
    assert error(np.array([got[q.unique_id, q.ds].fitted for q in rows])) < error(want[:, 2] * level) < error(want[:, 0] * level)


def test_direct_month_is_a_fit_of_each_target_month(spark):
    """The last target month's forecasts, from a plain fit on the months before it; earlier months don't see later ones."""
    from panelmill.plans import queries_scores as Q

    s = Study.of(spark, SF)
    got = {(q.unique_id, q.forecast_origin_date, q.target_month): q.monthly_forecast for q in registered.QUERIES["k10_direct_month"](spark, SF).collect()}
    names = [*Q.DIRECT, "weeks_in_month", "weeks_actualized"]
    table = s.modelling_table.dropna(subset=[*Q.DIRECT, "actual_monthly_total"]).collect()
    months = sorted({q.target_month for q in table})[-Q.TARGET_MONTHS :]
    assert {k[2] for k in got} == set(months) and len(got) == sum(q.target_month in months for q in table)
    panel = s.panel.toPandas()
    everything = []  # the bins' edges come from the training rows of all fits
    for month in months:
        until = min(q.forecast_origin_date for q in table if q.target_month == month)
        recent = panel[(panel.ds <= until) & (panel.ds > until - dt.timedelta(weeks=52)) & (panel.y > 0)]
        level = {i: max(1.0, v) for i, v in recent.groupby("unique_id").y.mean().items()}
        scaled = lambda q: [*(q[c] / level[q.unique_id] for c in Q.DIRECT), float(q.weeks_in_month), float(q.weeks_actualized)]  # noqa: B023, E731
        train, held = [q for q in table if q.target_month < month], [q for q in table if q.target_month == month]
        everything.append((np.array([scaled(q) for q in train]), np.array([q.actual_monthly_total / level[q.unique_id] for q in train]), np.array([scaled(q) for q in held]), [level[q.unique_id] for q in held], held))
    rows = spark.createDataFrame([(k, *map(float, x), float(y)) for k, (a, b, *_) in enumerate(everything) for x, y in zip(a, b)], ", ".join(["fit int", *(f"{c} double" for c in names), "label double"]))
    forest = boosting.fit(rows, names, "label", len(months), 1)
    for k in (0, len(months) - 1):
        x, y, ahead, level, held = everything[k]
        both = plain_forecast(x, y, ahead, list(forest.edges), Q.DIRECT_ROUNDS)
        assert np.allclose([got[q.unique_id, q.forecast_origin_date, q.target_month] for q in held], both * np.array(level))


def plain_forecast(x: np.ndarray, y: np.ndarray, ahead: np.ndarray, edges: list[np.ndarray], rounds: int) -> np.ndarray:
    """Predictions of other rows by the plain fit: they go where training rows of their bins would, so each is put behind the training rows
    without a say in splits or leaves."""
    bins, far = (np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, a.T)], axis=1) for a in (x, ahead))
    made, out = np.full(len(y), lower_median(y)), np.full(len(ahead), lower_median(y))
    for _ in range(rounds):
        r = y - made
        node, far_node = np.zeros(len(y), dtype=int), np.zeros(len(ahead), dtype=int)
        for _ in range(2):
            new, far_new = 2 * node, 2 * far_node
            for k in np.unique(node):
                at = node == k
                n = np.stack([np.bincount(bins[at, f], minlength=boosting.BINS) for f in range(x.shape[1])])
                g = np.stack([np.bincount(bins[at, f], np.sign(r[at]), boosting.BINS) for f in range(x.shape[1])])
                f, cut = boosting._best_splits(n, g, 10)
                new[at] += bins[at, f] > cut
                far_new[far_node == k] += far[far_node == k, f] > cut
            node, far_node = new, far_new
        for k in np.unique(node):
            m = 0.3 * lower_median(r[node == k])
            made[node == k] += m
            out[far_node == k] += m
    return out
