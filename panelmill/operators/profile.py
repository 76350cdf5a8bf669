"""Profiles of a panel as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelmill.operators.panel import MONEY, on_calendar
from panelmill.session import written


def _sum(c: Column) -> Column:
    return F.sum(c.cast(MONEY)).cast("double")


def series_stats(panel: DataFrame) -> DataFrame:
    """Mean, median and totals of each series, of all weeks and of positive ones, its first non-zero week and its length."""
    y = F.col("y")
    up = F.when(y > 0, y)
    return panel.groupBy("unique_id").agg(
        (_sum(y) / F.count("*")).alias("mean"),
        F.median("y").alias("median"),
        _sum(y).alias("total"),
        F.coalesce(_sum(up), F.lit(0.0)).alias("positive_total"),
        (_sum(up) / F.count(up)).alias("mean_positive"),
        F.median(up).alias("median_positive"),
        F.min(F.when(y != 0, F.col("ds"))).alias("start_ds"),
        (F.datediff(F.max("ds"), F.min(F.when(y != 0, F.col("ds")))) / 7 + 1).cast("long").alias("length_weeks"),
    )


def trailing(panel: DataFrame, weeks: int) -> DataFrame:
    """The last ``weeks`` weeks of the panel; weeks are Sundays, so this is a date filter against a one-row maximum."""
    end = panel.agg(F.max("ds").alias("end_ds"))
    return panel.crossJoin(F.broadcast(end)).where(F.col("ds") > F.date_sub("end_ds", 7 * weeks)).drop("end_ds")


def mtd_shares(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """Month-to-date over the final month for each week, and whether the month's total reaches the core threshold."""
    rows = on_calendar(panel, calendar)
    month = Window.partitionBy("unique_id", "fiscal_year_month")
    run = month.orderBy("ds").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"mtd": F.sum(F.col("y").cast(MONEY)).over(run).cast("double"), "month_total": F.sum(F.col("y").cast(MONEY)).over(month).cast("double")})
    core = trailing(panel, 52).where("y > 0").groupBy("unique_id").agg(F.greatest(F.lit(1000.0), 0.25 * (_sum(F.col("y")) / F.count("*"))).alias("core_threshold"))
    return rows.join(core, "unique_id").select(
        "unique_id", "ds", "fiscal_year_month", "fiscal_week_of_month", "weeks_in_month", "mtd", "month_total", F.when(F.col("month_total") > 0, F.col("mtd") / F.col("month_total")).alias("mtd_share"), (F.col("month_total") >= F.col("core_threshold")).alias("is_core")
    )


def select_ranks(rows: DataFrame, by: list[str], value: str, wanted: DataFrame) -> DataFrame:
    """(by, k, value): the values of ranks k (from 0) of each group, for a table ``wanted`` of (by, k). Distributed selection: distinct values
    are counted, dealt out by ranges of (group, value), and a value's rank is its part's offset plus its place there, so no task sees a whole
    group."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    parts = written(counted.repartitionByRange(*by, value).withColumn("_part", F.spark_partition_id()), "ordered-values")
    each = parts.groupBy("_part", *by).agg(F.sum("n").alias("m"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = each.select("_part", *by, F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("before"))  # a row for each part and group in it
    here = Window.partitionBy("_part", *by).orderBy(value)
    placed = parts.withColumn("run", F.sum("n").over(here)).join(before, ["_part", *by]).join(wanted.groupBy(*by).agg(F.collect_set("k").alias("ks")), by)
    end = F.col("before") + F.col("run")
    hit = F.filter("ks", lambda k: (k >= end - F.col("n")) & (k < end))
    return placed.select(*by, value, F.explode(hit).alias("k"))


def exact_quantiles(rows: DataFrame, by: list[str], value: str, at: list[float]) -> DataFrame:
    """(by, n, q): linear-interpolated quantiles of each group, q an array in the order of ``at``; few or many groups, of any size. Without
    ``by`` all rows are one group."""
    if not by:
        return exact_quantiles(rows.withColumn("_all", F.lit(0)), ["_all"], value, at).drop("_all")
    sizes = rows.where(F.col(value).isNotNull()).groupBy(*by).agg(F.count("*").alias("n"))
    sizes = written(sizes, "group-sizes")
    points = sizes.select(*by, "n", F.posexplode(F.array(*map(F.lit, at))).alias("i", "p")).withColumn("at", (F.col("n") - 1) * F.col("p"))
    ranks_ = points.select(*by, F.explode(F.array(F.floor("at"), F.ceil("at"))).alias("k"))
    found = written(select_ranks(rows, by, value, ranks_), "quantile-values")
    side = lambda how, name: points.select(*by, "i", "at", how("at").alias("k")).join(found, [*by, "k"]).select(*by, "i", F.col("at").alias(f"at_{name}"), F.col(value).alias(name))
    both = side(F.floor, "a").join(side(F.ceil, "b"), [*by, "i"])
    made = F.col("a") + (F.col("at_a") - F.floor("at_a")) * (F.col("b") - F.col("a"))
    each = both.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", made.alias("v")))), lambda x: x["v"]).alias("q"))
    return sizes.join(each, by)


def group_quantiles(rows: DataFrame, by: list[str], value: str, at: list[float], exact: bool = True) -> DataFrame:
    """(by, n, q): exact, or by mergeable sketches within 1/100,000 of the rank."""
    if exact:
        return exact_quantiles(rows, by, value, at)
    return rows.where(F.col(value).isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), F.percentile_approx(value, at, 100_000).alias("q"))


def share_distribution(shares: DataFrame, exact: bool = True) -> DataFrame:
    """Five numbers of the share by month length and week, over core months."""
    core = shares.where("is_core AND mtd_share IS NOT NULL")
    rows = group_quantiles(core, ["weeks_in_month", "fiscal_week_of_month"], "mtd_share", [0.0, 0.25, 0.5, 0.75, 1.0], exact).withColumnRenamed("q", "p")
    return rows.select("weeks_in_month", "fiscal_week_of_month", "n", *[F.get("p", F.lit(k)).alias(c) for k, c in enumerate(("least", "q25", "q50", "q75", "most"))])


def negative_weeks(panel: DataFrame) -> DataFrame:
    y = F.col("y")
    down = F.when(y < 0, y)
    return panel.groupBy("unique_id").agg(F.count(down).alias("n_negative"), (F.count(down) / F.count("*")).alias("share_negative"), F.coalesce(_sum(down), F.lit(0.0)).alias("negative_sum"), F.try_divide(-F.coalesce(_sum(down), F.lit(0.0)), _sum(F.when(y > 0, y))).alias("materiality"))


def demand_class(adi: Column, cv2: Column) -> Column:
    """Smooth, Erratic, Intermittent or Lumpy by the usual cuts."""
    return F.when((adi < 1.32) & (cv2 < 0.49), "Smooth").when((adi < 1.32) & (cv2 >= 0.49), "Erratic").when((adi >= 1.32) & (cv2 < 0.49), "Intermittent").when((adi >= 1.32) & (cv2 >= 0.49), "Lumpy")


def intermittency(panel: DataFrame) -> DataFrame:
    """Share of zero weeks, mean interval between positive ones and squared variation of their size, with the class."""
    up = F.when(F.col("y") > 0, F.col("y"))
    rows = panel.groupBy("unique_id").agg((F.count_if(F.col("y") == 0) / F.count("*")).alias("zero_share"), F.try_divide(F.count("*"), F.count(up)).alias("adi"), F.pow(F.try_divide(F.stddev_samp(up), F.avg(up)), 2).alias("cv2"))
    return rows.withColumn("demand_class", demand_class(F.col("adi"), F.col("cv2")))


def spread(panel: DataFrame) -> DataFrame:
    """Standard deviation, interquartile range and median absolute deviation of each series, and the coefficient of variation."""
    rows = panel.groupBy("unique_id").agg(F.stddev_samp("y").alias("std"), F.avg("y").alias("mean"), F.percentile("y", [0.25, 0.5, 0.75]).alias("q"))
    off = panel.join(rows.select("unique_id", F.get("q", F.lit(1)).alias("centre")), "unique_id")
    mad = off.groupBy("unique_id").agg(F.median(F.abs(F.col("y") - F.col("centre"))).alias("mad"))
    return rows.join(mad, "unique_id").select("unique_id", "std", (F.get("q", F.lit(2)) - F.get("q", F.lit(0))).alias("iqr"), "mad", F.try_divide("std", "mean").alias("cv"))


def dispersion_ratios(shares: DataFrame, by: list[str], exact: bool = True) -> DataFrame:
    """How much less the remaining month varies than the final month: ratios of interquartile range, MAD and P90 - P10."""
    rows = shares.withColumn("remaining", F.col("month_total") - F.col("mtd"))
    at5 = [0.1, 0.25, 0.5, 0.75, 0.9]
    of = lambda df, c, at, name: group_quantiles(df, by, c, at, exact).select(*by, *(["n"] if name == "r" else []), F.col("q").alias(name))
    first = of(rows, "remaining", at5, "r").join(of(rows, "month_total", at5, "f"), by)
    off = rows.join(F.broadcast(first.select(*by, F.get("r", F.lit(2)).alias("rc"), F.get("f", F.lit(2)).alias("fc"))), by)
    off = off.withColumns({"ro": F.abs(F.col("remaining") - F.col("rc")), "fo": F.abs(F.col("month_total") - F.col("fc"))})
    mad = of(off, "ro", [0.5], "rq").join(of(off, "fo", [0.5], "fq"), by).select(*by, F.get("rq", F.lit(0)).alias("rm"), F.get("fq", F.lit(0)).alias("fm"))
    at = lambda c, k: F.get(c, F.lit(k))
    over = lambda a, b: F.when(b != 0, a / b)
    return first.join(mad, by).select(*by, "n", over(at("r", 3) - at("r", 1), at("f", 3) - at("f", 1)).alias("iqr_ratio"), over(F.col("rm"), F.col("fm")).alias("mad_ratio"), over(at("r", 4) - at("r", 0), at("f", 4) - at("f", 0)).alias("p90_p10_ratio"))


def _in_order(rows: DataFrame, *order: Column) -> DataFrame:
    """The rows dealt out by ranges of ``order``, with their part: what ranks before a part is the sum over the parts before it. Written,
    so that a row keeps its part."""
    return written(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "in-order")


def _with_before(parts: DataFrame, **sums: Column) -> DataFrame:
    """Each row with the sums over all earlier parts (0 for the first): one row a part goes through a window of its own."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    each = parts.groupBy("_part").agg(*[c.alias(name) for name, c in sums.items()])
    before = each.select("_part", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in sums])
    return parts.join(F.broadcast(before), "_part")


def ranks(totals: DataFrame, measures: list[str]) -> DataFrame:
    """The rank of each series by each measure, 1 for the largest; ties share the better rank. No task sees all series."""
    out = None
    for m in measures:
        parts = _with_before(_in_order(totals.select("unique_id", m), F.desc(m)), before=F.count("*"))
        made = parts.select("unique_id", (F.col("before") + F.rank().over(Window.partitionBy("_part").orderBy(F.desc(m)))).cast("int").alias(f"rank_{m}"))
        out = made if out is None else out.join(made, "unique_id")
    return out


def first_rank_buckets(totals: DataFrame, measure: str, n: int = 5) -> DataFrame:
    """Quantile bins of first ranks (ties by id): bin edges at linear quantiles of 1..N, which NTILE doesn't give."""
    order = [F.asc(measure), F.asc("unique_id")]
    parts = _with_before(_in_order(totals.select("unique_id", measure), *order), before=F.count("*"))
    k = F.col("before") + F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    rows = parts.withColumn("k", k).crossJoin(F.broadcast(totals.agg(F.count("*").alias("all_series"))))
    bucket = F.greatest(F.lit(1), F.ceil(F.try_divide(n * (F.col("k") - 1), F.col("all_series") - 1))).cast("int")
    return rows.select("unique_id", measure, F.coalesce(bucket, F.lit(1)).alias("bucket"))


def concentration(totals: DataFrame, measure: str) -> DataFrame:
    """Cumulative share of the total by descending rank."""
    order = [F.desc(measure), F.asc("unique_id")]
    m = F.col(measure).cast(MONEY)
    parts = _with_before(_in_order(totals.select("unique_id", measure), *order), before=F.count("*"), summed=F.sum(m))
    w = Window.partitionBy("_part").orderBy(*order)
    run = F.col("summed") + F.sum(m).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = parts.select("unique_id", (F.col("before") + F.row_number().over(w)).cast("int").alias("position"), run.cast("double").alias("run"))
    whole = totals.agg(F.sum(m).cast("double").alias("whole"))
    return rows.crossJoin(F.broadcast(whole)).select("unique_id", "position", (F.col("run") / F.col("whole")).alias("cumulative_share"))


def first_in_group(rows: DataFrame, identity: str, *by: str) -> DataFrame:
    """The rows with is_first: true for one row of each identity in each group, so a count of them is the exact distinct count (null
    identities don't count). Rows that lie dealt out by identity aren't moved, and no task holds a table of all identities."""
    nth = F.row_number().over(Window.partitionBy(identity, *by).orderBy(F.lit(0)))
    return rows.withColumn("is_first", (nth == 1) & F.col(identity).isNotNull())


def daily_sketches(rows: DataFrame, day: str, identity: str, measure: str, lg_k: int = 14, k: int = 400) -> DataFrame:
    """(day, n, distinct_sketch, measure_sketch): for each day its rows, a sketch of its distinct identities (HyperLogLog, a standard error of
    1.04 / 2^(lg_k / 2), 0.8 %) and one of its measure (KLL, ranks within about 1 %). Days are stored once; any period is a merge of its
    days, without the facts."""
    return rows.groupBy(day).agg(F.count("*").alias("n"), F.hll_sketch_agg(identity, lg_k).alias("distinct_sketch"), F.kll_sketch_agg_double(F.col(measure).cast("double"), k).alias("measure_sketch"))


def merged_sketches(sketches: DataFrame, *by: Column) -> DataFrame:
    """Sketches of longer periods from those of shorter ones; merging is associative, so merges can be merged."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("measure_sketch").alias("measure_sketch"))


def sketch_figures(sketches: DataFrame, at: list[float]) -> DataFrame:
    """The sketches' keys, n, the estimated number of distinct identities, and q, the measure's quantiles in the order of ``at``."""
    keys = [c for c in sketches.columns if c not in ("n", "distinct_sketch", "measure_sketch")]
    return sketches.select(*keys, "n", F.hll_sketch_estimate("distinct_sketch").alias("distinct"), F.array(*[F.kll_sketch_get_quantile_double("measure_sketch", F.lit(p)) for p in at]).alias("q"))


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, nulls, n) of every column."""
    row = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return row.unpivot(["n"], df.columns, "column_name", "nulls").select("column_name", "nulls", "n")


def describe(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """(column_name, n, mean, std, least, q25, q50, q75, most) of numeric columns."""
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column_name", "v").where("v IS NOT NULL")
    q = group_quantiles(rows, ["column_name"], "v", [0.25, 0.5, 0.75], exact).drop("n")
    made = rows.groupBy("column_name").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("least"), F.max("v").alias("most")).join(q, "column_name")
    return made.select("column_name", "n", "mean", "std", "least", *[F.get("q", F.lit(k)).alias(name) for k, name in enumerate(("q25", "q50", "q75"))], "most")


def autocorrelation(panel: DataFrame, lags: int) -> DataFrame:
    """Autocorrelation of each series at lags 0 to ``lags``: a self-join on exploded lags, a row for each value and lag."""
    w = Window.partitionBy("unique_id")
    rows = panel.withColumns({"k": F.row_number().over(w.orderBy("ds")), "d": F.col("y") - F.avg("y").over(w)})
    later = rows.select("unique_id", F.explode(F.sequence(F.lit(0), F.lit(lags))).alias("lag"), "k", F.col("d").alias("a"))
    later = later.select("unique_id", "lag", (F.col("k") - F.col("lag")).alias("k"), "a")
    made = later.join(rows.select("unique_id", "k", F.col("d").alias("b")), ["unique_id", "k"]).groupBy("unique_id", "lag").agg(F.sum(F.col("a") * F.col("b")).alias("c"))
    zero = made.where("lag = 0").select("unique_id", F.col("c").alias("c0"))
    return made.join(zero, "unique_id").select("unique_id", "lag", F.when(F.col("c0") != 0, F.col("c") / F.col("c0")).alias("acf"))


#: The Durbin-Levinson recursion over an array r of autocorrelations (lag 0 first): phi holds the coefficients of the order before.
_LEVINSON = """
aggregate(sequence(1, size(r) - 1), named_struct('phi', cast(array() as array<double>), 'out', array(1D)), (s, k) ->
  transform(array(
    (element_at(r, k + 1) - aggregate(zip_with(s.phi, reverse(slice(r, 2, k - 1)), (p, x) -> p * x), 0D, (a, x) -> a + x))
  ), num -> transform(array(1 - aggregate(zip_with(s.phi, slice(r, 2, k - 1), (p, x) -> p * x), 0D, (a, x) -> a + x)), den -> transform(array(if(abs(den) > 1e-12, num / den, 0D)), last ->
    named_struct('phi', concat(zip_with(s.phi, reverse(s.phi), (p, x) -> p - last * x), array(last)), 'out', concat(s.out, array(last))))[0])[0])[0]
, s -> s.out)"""


def partial_autocorrelation(acf: DataFrame) -> DataFrame:
    """Partial autocorrelation by the Durbin-Levinson recursion over each series' short list of autocorrelations; none where one is
    undefined. An expression over the array: no Python runs."""
    lists = acf.groupBy("unique_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda x: x["acf"]).alias("r"), F.count("acf").alias("defined"))
    lists = lists.where((F.col("defined") == F.size("r")) & (F.size("r") > 1))
    return lists.select("unique_id", F.posexplode(F.expr(_LEVINSON)).alias("lag", "pacf"))


def box_cox(y: Column, lam: Column) -> Column:
    return F.when(lam == 0, F.ln(y)).otherwise((F.pow(y, lam) - 1) / lam)


def choose_lambda(panel: DataFrame, grid: list[float]) -> DataFrame:
    """The Box-Cox lambda of each series with the best normal log-likelihood on a grid; positive values only."""
    lam = F.explode(F.array(*[F.lit(float(g)) for g in grid]))
    rows = panel.where("y > 0").select("unique_id", "y", lam.alias("power"))
    z = box_cox(F.col("y"), F.col("power"))
    made = rows.groupBy("unique_id", "power").agg((-F.count("*") / 2 * F.ln(F.var_pop(z)) + (F.first("power") - 1) * F.sum(F.ln("y"))).alias("likelihood"))
    return made.groupBy("unique_id").agg(F.max_by("power", "likelihood").alias("power"), F.max("likelihood").alias("likelihood"))


def guerrero_lambda(panel: DataFrame, grid: list[float], season: int) -> DataFrame:
    """(unique_id, power, variation): Guerrero's Box-Cox lambda of each series on a grid. The series is cut into whole seasons, the first
    weeks left out if they don't make one; of the powers the one wins under which std / mean^(1 - power) varies least between them
    (deviation over mean; ties: the smaller power). Seasons without a positive mean don't count; with fewer than two there is no row."""
    by = Window.partitionBy("unique_id")
    placed = panel.withColumns({"k": F.row_number().over(by.orderBy("ds")) - 1, "n": F.count("*").over(by)})
    placed = placed.withColumn("block", F.floor((F.col("k") - F.col("n") % season) / season)).where("block >= 0")
    blocks = placed.groupBy("unique_id", "block").agg(F.avg("y").alias("mean"), F.stddev_samp("y").alias("std")).where("mean > 0")
    each = blocks.select("unique_id", "mean", "std", F.explode(F.array(*[F.lit(float(g)) for g in grid])).alias("power"))
    ratio = F.col("std") / F.pow("mean", 1 - F.col("power"))
    varied = each.groupBy("unique_id", "power").agg(F.try_divide(F.stddev_pop(ratio), F.avg(ratio)).alias("variation"), F.count("*").alias("seasons")).where("seasons > 1 AND variation IS NOT NULL")
    best = varied.groupBy("unique_id").agg(F.min(F.struct("variation", "power")).alias("best"))
    return best.select("unique_id", "best.power", "best.variation")


def year_over_year(panel: DataFrame, calendar: DataFrame, years: list[int] | None = None) -> DataFrame:
    """Totals by fiscal week with a column for each year, of all years that the panel reaches into if none are given."""
    rows = on_calendar(panel, calendar)
    if years is None:
        years = [r[0] for r in rows.select("fiscal_year").distinct().orderBy("fiscal_year").collect()]  # a row a year
    return rows.groupBy("fiscal_week").pivot("fiscal_year", years).agg(_sum(F.col("y")))


def length_histogram(stats: DataFrame) -> DataFrame:
    return stats.groupBy("length_weeks").agg(F.count("*").alias("n_series"))
