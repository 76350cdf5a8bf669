"""Forecasts from every origin in one plan, and models that need a fit."""

from __future__ import annotations

import datetime as dt
import inspect
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelmill.operators import boosting
from panelmill.operators.panel import money, on_calendar
from panelmill.session import written


def history(panel: DataFrame, origins: DataFrame, calendar: DataFrame, weeks: int | None = None) -> DataFrame:
    """Every origin with the panel's weeks up to it, the last ``weeks`` if given: (forecast_origin_date, origin_week, unique_id, ds, y, week_index).

    Pairs of origin and week come from the calendar alone and are joined by the week: no range join over the panel."""
    ends = origins.select("forecast_origin_date", "origin_week")
    within = F.col("week_index") <= F.col("origin_week")
    pairs = ends.join(F.broadcast(calendar.select("ds", "week_index")), within & (F.col("week_index") > F.col("origin_week") - weeks) if weeks else within)
    return panel.select("unique_id", "ds", "y").join(F.broadcast(pairs), "ds").select("unique_id", "ds", "y", "week_index", "forecast_origin_date", "origin_week")


def future_weeks(panel: DataFrame, origins: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every origin, series and week of the horizon."""
    weeks = F.broadcast(origins).join(F.broadcast(calendar.select("ds", "week_index", "fiscal_year_month")), F.col("week_index").between(F.col("origin_week") + 1, F.col("origin_week") + F.col("horizon")))
    weeks = weeks.select("forecast_origin_date", "origin_week", "ds", "week_index", "fiscal_year_month", (F.col("week_index") - F.col("origin_week")).alias("step"))
    return panel.select("unique_id").distinct().crossJoin(F.broadcast(weeks))


def naive(history: DataFrame, future: DataFrame) -> DataFrame:
    """The last value, for every week of the horizon: the panel has no gaps, so it is the origin's own week."""
    last = history.where("week_index = origin_week").select("forecast_origin_date", "unique_id", F.col("y").alias("ypred"))
    return future.join(last, ["forecast_origin_date", "unique_id"]).select("forecast_origin_date", "unique_id", "ds", "ypred")


def recent_mean(history: DataFrame, future: DataFrame, weeks: int) -> DataFrame:
    """The mean of the last ``weeks`` weeks."""
    recent = history.where(F.col("week_index") > F.col("origin_week") - weeks)
    mean = recent.groupBy("forecast_origin_date", "unique_id").agg((money().cast("double") / F.count("*")).alias("ypred"))
    return future.join(mean, ["forecast_origin_date", "unique_id"]).select("forecast_origin_date", "unique_id", "ds", "ypred")


def seasonal_naive(history: DataFrame, future: DataFrame, season: int) -> DataFrame:
    """The value of as many whole seasons back as lead to the origin or before; null where the series hasn't one."""
    back = future.withColumn("source_week", F.col("week_index") - season * F.ceil(F.col("step") / season))
    past = history.select("forecast_origin_date", "unique_id", F.col("week_index").alias("source_week"), F.col("y").alias("ypred"))
    return back.join(past, ["forecast_origin_date", "unique_id", "source_week"], "left").select("forecast_origin_date", "unique_id", "ds", "ypred")


def per_series(history: DataFrame, future: DataFrame, fit_predict: Callable, regressors: DataFrame | None = None, params: dict | None = None) -> DataFrame:
    """The hook for forecasters written for one series, which are named functions of pandas frames:

    ``fit_predict(train, horizon, **params)`` or ``fit_predict(train, horizon, future_x, **params)`` gives a value for each step, or those
    and the fitted values of the last rows of ``train``. ``params`` are hyper-parameters by name; one that the function doesn't
    have is an error before anything runs. ``regressors`` are known for past and future weeks, by ``ds`` or by ``unique_id`` and ``ds``:
    ``train`` has them as columns, ``future_x`` is a row for each step. One group is one series as of one origin, a few hundred rows.
    """
    return _per_series(history, future, fit_predict, regressors, params).where("kind = 'forecast'").select("forecast_origin_date", "unique_id", "ds", F.col("value").alias("ypred"))


def per_series_fitted(history: DataFrame, future: DataFrame, fit_predict: Callable, regressors: DataFrame | None = None, params: dict | None = None) -> DataFrame:
    """(forecast_origin_date, unique_id, ds, fitted) of forecasters that give fitted values as well."""
    return _per_series(history, future, fit_predict, regressors, params).where("kind = 'fitted'").select("forecast_origin_date", "unique_id", "ds", F.col("value").alias("fitted"))


def _per_series(history: DataFrame, future: DataFrame, fit_predict: Callable, regressors: DataFrame | None, params: dict | None) -> DataFrame:
    params = params or {}
    takes = inspect.signature(fit_predict).parameters
    if odd := sorted(set(params) - set(takes)):
        raise TypeError(f"{fit_predict.__name__} has no hyper-parameters {odd}")
    wants_future = "future_x" in takes
    extra = [c for c in regressors.columns if c not in ("unique_id", "ds")] if regressors is not None else []
    keys = ["unique_id", "ds"] if regressors is not None and "unique_id" in regressors.columns else ["ds"]

    def run(key: tuple, train: pd.DataFrame, ahead: pd.DataFrame) -> pd.DataFrame:
        train, ahead = train.sort_values("ds").reset_index(drop=True), ahead.sort_values("ds").reset_index(drop=True)
        if train.empty or ahead.empty:
            return pd.DataFrame({c: [] for c in ("forecast_origin_date", "unique_id", "ds", "kind", "value")})
        given = (ahead[["ds", *extra]],) if wants_future else ()
        made = fit_predict(train[["ds", "y", *extra]], len(ahead), *given, **params)
        values, fitted = made if isinstance(made, tuple) else (made, [])
        values, fitted = [float(v) for v in values], [float(v) for v in fitted]
        ds = [*ahead["ds"].iloc[: len(values)], *train["ds"].iloc[len(train) - len(fitted) :]]
        return pd.DataFrame({"forecast_origin_date": key[0], "unique_id": key[1], "ds": ds, "kind": ["forecast"] * len(values) + ["fitted"] * len(fitted), "value": values + fitted})

    by = ["forecast_origin_date", "unique_id"]
    past, ahead = history.select(*by, "ds", "y"), future.select(*by, "ds")
    if regressors is not None:
        known = regressors.select(*keys, *extra)
        known = F.broadcast(known) if keys == ["ds"] else known  # a calendar: a row a week
        past, ahead = past.join(known, keys, "left"), ahead.join(known, keys, "left")
    named = lambda *names: [F.col(c).alias(c) for c in names]  # noqa: E731  both sides may come from one frame
    past, ahead = past.select(*named(*by, "ds", "y", *extra)), ahead.select(*named(*by, "ds", *extra))
    return past.groupBy(*by).cogroup(ahead.groupBy(*by)).applyInPandas(run, "forecast_origin_date date, unique_id long, ds date, kind string, value double")


def recent_peak(train: pd.DataFrame, horizon: int) -> list[float]:
    """A per-series forecaster: the largest of the last eight values."""
    return [float(train["y"].tail(8).max())] * horizon


def workday_rate(train: pd.DataFrame, horizon: int, future_x: pd.DataFrame, weeks: int = 8) -> tuple[list[float], list[float]]:
    """A per-series forecaster with a future regressor: what a workday brought over the last ``weeks``, times the workdays of each week to
    come; its fitted values are those of the last ``weeks``."""
    recent = train.tail(weeks)
    rate = recent["y"].sum() / max(1, recent["count_workdays"].sum())
    return list(rate * future_x["count_workdays"]), list(rate * recent["count_workdays"])


#: Forecasters by name: (history, future) -> (forecast_origin_date, unique_id, ds, ypred).
FORECASTERS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "naive": naive,
    "recent_mean": lambda h, f: recent_mean(h, f, 7),
    "recent_quarter": lambda h, f: recent_mean(h, f, 13),
    "seasonal_naive": lambda h, f: seasonal_naive(h, f, 52),
    "recent_peak": lambda h, f: per_series(h, f, recent_peak),
}


# -- global boosted trees -----------------------------------------------------------------

FEATURES = ["lag1", "lag52", "rolling_mean_lag1_window_size4", "has_lag52", "week_sin", "week_cos", "count_workdays", "fiscal_week_of_month", "weeks_in_month"]
#: Weeks that a forecast's features look back, and that a series' level is taken from.
SEASON = 52
ROUNDS, DEPTH, RATE = 20, 3, 0.3


def levels(panel: DataFrame, fits: DataFrame, weeks: int = SEASON) -> DataFrame:
    """(fit, unique_id, level): each series' mean positive value over its last weeks up to the fit's date ``until``, at least 1. Targets are
    scaled by it, so that series of all sizes share a model."""
    recent = panel.join(F.broadcast(fits.select("fit", "until")), (F.col("ds") <= F.col("until")) & (F.col("ds") > F.date_sub("until", 7 * weeks)))
    return recent.groupBy("fit", "unique_id").agg(F.greatest(F.coalesce(F.avg(F.when(F.col("y") > 0, F.col("y"))), F.lit(1.0)), F.lit(1.0)).alias("level"))


def training_rows(panel: DataFrame, calendar: DataFrame, fits: DataFrame) -> DataFrame:
    """(fit, unique_id, ds, y, level, scaled, FEATURES) for each fit and week up to its date: lags in units of the level; a missing yearly
    lag is marked and stands in as the level (1). Lags are taken once for all fits."""
    w = Window.partitionBy("unique_id").orderBy("ds")
    last4 = w.rowsBetween(-4, -1)
    rows = on_calendar(panel, calendar).withColumns({"back1": F.lag("y", 1).over(w), "back52": F.lag("y", SEASON).over(w), "mean4": F.when(F.count("y").over(last4) == 4, F.avg("y").over(last4))})
    rows = rows.where("back1 IS NOT NULL AND mean4 IS NOT NULL").join(F.broadcast(fits.select("fit", "until")), F.col("ds") <= F.col("until")).join(levels(panel, fits), ["fit", "unique_id"])
    angle = 2 * F.pi() * F.dayofyear("ds") / 365.25
    per = lambda c: F.col(c) / F.col("level")
    made = {"lag1": per("back1"), "lag52": F.coalesce(per("back52"), F.lit(1.0)), "rolling_mean_lag1_window_size4": per("mean4"), "has_lag52": F.col("back52").isNotNull().cast("double"), "week_sin": F.sin(angle), "week_cos": F.cos(angle)}
    return rows.select("fit", "unique_id", "ds", "y", "level", per("y").alias("scaled"), *[(made[c] if c in made else F.col(c)).cast("double").alias(c) for c in FEATURES])


def one_fit(panel: DataFrame) -> DataFrame:
    """The fit (0) that knows the whole panel."""
    return panel.agg(F.max("ds").alias("until")).withColumn("fit", F.lit(0))


def fit_boosted(panel: DataFrame, calendar: DataFrame, fits: DataFrame, rounds: int = ROUNDS, depth: int = DEPTH, rate: float = RATE) -> boosting.Forest:
    """Global models of the scaled weekly value, one for each row of ``fits`` (fit, until) over what is known then; all in the same jobs."""
    n = fits.agg(F.max("fit")).first()[0] + 1
    return boosting.fit(training_rows(panel, calendar, fits), FEATURES, "scaled", n, rounds, depth, rate)


def predict_boosted(forest: boosting.Forest, panel: DataFrame, calendar: DataFrame, origins: DataFrame, grid: list[int] | None = None) -> DataFrame:
    """Recursive forecasts from every origin, (rounds, forecast_origin_date, unique_id, ds, ypred): each step's forecast becomes the next
    step's lag. ``origins`` has forecast_origin_date, horizon (weeks) and fit, the number of its model; ``grid`` gives numbers of
    rounds (all trees if None).

    A row is a series as of an origin with its last 52 weeks as an array. A task takes it through all steps and numbers of rounds,
    each of which carries a buffer of its own, so nothing is written, joined or shuffled between steps. The calendar, a row a week, travels
    with the task."""
    grid = grid or [forest.rounds]
    cases = origins.select("forecast_origin_date", "horizon", "fit")
    back = F.date_sub("forecast_origin_date", 7 * SEASON)
    seen = panel.join(F.broadcast(cases), (F.col("ds") > back) & (F.col("ds") <= F.col("forecast_origin_date")))
    known = seen.groupBy("forecast_origin_date", "unique_id", "horizon", "fit").agg(F.transform(F.array_sort(F.collect_list(F.struct("ds", "y"))), lambda x: x["y"]).alias("weeks"))
    dates = {r[0]: [float(x) for x in r[1:]] for r in calendar.select("ds", *FEATURES[6:]).collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for origin, series, horizon, fit, weeks in zip(*(c.to_pylist() for c in b.columns)):
                if len(weeks) < 4:
                    continue
                level = max(float(np.mean([y for y in weeks if y > 0] or [1.0])), 1.0)
                held = np.full((len(grid), SEASON + horizon), np.nan)  # of each number of rounds: the weeks so far
                held[:, SEASON - len(weeks) : SEASON] = np.array(weeks) / level
                for k in range(horizon):
                    ds = origin + dt.timedelta(weeks=k + 1)
                    if ds not in dates:
                        break
                    at = SEASON + k
                    year = held[:, k]
                    angle = 2 * np.pi * ds.timetuple().tm_yday / 365.25
                    features = np.stack([held[:, at - 1], np.where(np.isnan(year), 1.0, year), held[:, at - 4 : at].mean(axis=1), (~np.isnan(year)).astype(float), *(np.full(len(grid), x) for x in (np.sin(angle), np.cos(angle), *dates[ds]))], axis=1)
                    made = forest.prefixes(np.full(len(grid), fit), features)[np.arange(len(grid)), grid]
                    held[:, at] = np.maximum(made, 0.0)
                    out += [(r, origin, series, ds, y * level) for r, y in zip(grid, held[:, at].tolist())]
            columns = list(zip(*out)) if out else [()] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.date32(), pa.int64(), pa.date32(), pa.float64()))], names=["rounds", "forecast_origin_date", "unique_id", "ds", "ypred"])

    return known.select("forecast_origin_date", "unique_id", "horizon", "fit", "weeks").mapInArrow(run, "rounds int, forecast_origin_date date, unique_id long, ds date, ypred double")


def shared_fits(origins: DataFrame, refit_every: int) -> tuple[DataFrame, DataFrame]:
    """Fits (fit, until), and ``origins`` with theirs: every ``refit_every`` origins share one, fitted on what the first of them knows."""
    number = F.floor((F.row_number().over(Window.orderBy("forecast_origin_date")) - 1) / refit_every).cast("int")
    dates = origins.select("forecast_origin_date").distinct().withColumn("fit", number)  # one row a week
    return dates.groupBy("fit").agg(F.min("forecast_origin_date").alias("until")), origins.join(F.broadcast(dates), "forecast_origin_date")


def boosted_from_origins(panel: DataFrame, calendar: DataFrame, origins: DataFrame, rounds: int = ROUNDS, refit_every: int = 8) -> DataFrame:
    """Forecasts from all origins."""
    fits, origins = shared_fits(origins, refit_every)
    return predict_boosted(fit_boosted(panel, calendar, fits, rounds), panel, calendar, origins).drop("rounds")


def fitted(forest: boosting.Forest, panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """Fitted values and residuals of the training rows of the one fit over the whole panel."""
    rows = boosting.predicted(training_rows(panel, calendar, one_fit(panel)), forest)
    return rows.select("unique_id", "ds", "y", (F.get("predictions", F.lit(0)) * F.col("level")).alias("fitted")).withColumn("residual", F.col("y") - F.col("fitted"))


def weighted_absolute_error(actual: Column, forecast: Column, weight: Column) -> Column:
    """The scorer of a calibration: an aggregate over a fold's series; null where they have no weight."""
    return F.try_divide(F.sum(weight * F.abs(forecast - actual)), F.nullif(F.sum(weight), F.lit(0.0)))


def rounds_curve(months: DataFrame, score: Callable[[Column, Column, Column], Column] = weighted_absolute_error) -> DataFrame:
    """(forecast_origin_date, horizon, rounds, score) of held-out months: monthly forecasts, totals and weights of each number of rounds."""
    got = score(F.col("actual_monthly_total"), F.col("monthly_forecast"), F.col("series_weight"))
    return months.groupBy("forecast_origin_date", "horizon", "rounds").agg(got.alias("score"))


def parsimonious(curve: DataFrame, keys: list[str], window: int = 3, epsilon: float = 0.01) -> DataFrame:
    """For each curve the fewest rounds whose smoothed score is within epsilon of the smoothed best, and whether that lies in the
    top tenth of the grid (inconclusive)."""
    by = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    half = window // 2
    smooth = F.avg("score").over(by.orderBy("rounds").rowsBetween(-half, half))
    rows = curve.withColumn("smoothed", smooth)
    rows = rows.withColumns({"best": F.min("smoothed").over(by), "top": F.max("rounds").over(by)})
    chosen = F.min(F.when(F.col("smoothed") <= F.col("best") * (1 + epsilon), F.col("rounds")))
    return rows.groupBy(*keys).agg(chosen.alias("rounds"), F.max("top").alias("top")).select(*keys, "rounds", (F.col("rounds") > 0.9 * F.col("top")).alias("inconclusive"))


def pooled_rounds(chosen: DataFrame, percent: int = 75, refuse_above: float = 0.25) -> DataFrame:
    """One row: the percentile of the chosen rounds, an element of them (the higher one), the share of inconclusive curves, and
    whether that is too high to use the result."""
    n = F.size("all")
    at = F.ceil((n - 1) * F.lit(percent) / 100).cast("int")
    rows = chosen.agg(F.array_sort(F.collect_list("rounds")).alias("all"), F.avg(F.col("inconclusive").cast("double")).alias("share_inconclusive"))
    return rows.select(F.get("all", at).alias("rounds"), "share_inconclusive", (F.col("share_inconclusive") > refuse_above).alias("refused"))
