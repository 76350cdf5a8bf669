"""Date functions and the 4-4-5 fiscal calendar."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Fixed values of the example calendar: holidays by month and day.
HOLIDAYS = ((1, 1, "New Year"), (7, 4, "Independence Day"), (12, 25, "Christmas Day"))


def week_start(d: Column) -> Column:
    """The Sunday on or before a date."""
    return F.date_sub(d, F.dayofweek(d) - 1)


def yearweek(year: Column, week: Column) -> Column:
    return (year * 100 + week).cast("int")


def harmonics(d: Column) -> tuple[Column, Column]:
    angle = 2 * F.pi() * F.dayofyear(d) / 365.25
    return F.sin(angle), F.cos(angle)


def utc_offset_hours(d: Column, tz: str) -> Column:
    """Offset of local midnight from UTC, in hours."""
    midnight = d.cast("timestamp")
    return (F.unix_timestamp(midnight) - F.unix_timestamp(F.to_utc_timestamp(midnight, tz))) / 3600


def is_dst(d: Column, tz: str = "America/New_York", standard: int = -5) -> Column:
    return utc_offset_hours(d, tz) != standard


def year_start(year: Column) -> Column:
    """The Sunday nearest to 1 January, on which a fiscal year starts; so a year has 52 or 53 weeks."""
    first = F.make_date(year, F.lit(1), F.lit(1))
    day = F.dayofweek(first) - 1
    return F.date_add(first, F.when(day <= 3, -day).otherwise(7 - day))


def fiscal_years(bounds: DataFrame) -> DataFrame:
    """The years of the facts (one row: first, last date) and one more on either side: (fiscal_year)."""
    return bounds.select(F.explode(F.sequence(F.year("first") - 1, F.year("last") + 1)).alias("fiscal_year"))


#: Days of a fiscal year's months: 4, 4 and 5 weeks a quarter; a long year has a week more at its end.
REGULAR_YEAR = [28, 28, 35] * 4
LONG_YEAR = [28, 28, 35] * 3 + [28, 28, 42]


def year_table(spark: SparkSession, years: Iterable[int], long_years: Iterable[int] = ()) -> DataFrame:
    """(fiscal_year, month_days): the days of each month of the given years."""
    rows = [(y, LONG_YEAR if y in set(long_years) else REGULAR_YEAR) for y in years]
    return spark.createDataFrame(rows, "fiscal_year int, month_days array<int>")


def ruled_years(years: DataFrame) -> DataFrame:
    """The default where no table is given, (fiscal_year, start, month_days): a year starts on the Sunday nearest to 1 January and is long
    if that makes it so."""
    days = F.datediff(year_start(F.col("fiscal_year") + 1), year_start(F.col("fiscal_year")))
    lengths = F.when(days == sum(LONG_YEAR), F.array(*map(F.lit, LONG_YEAR))).otherwise(F.array(*map(F.lit, REGULAR_YEAR)))
    return years.select(F.col("fiscal_year").cast("int").alias("fiscal_year"), year_start(F.col("fiscal_year")).alias("start"), lengths.alias("month_days"))


def given_years(table: DataFrame, first_sunday: str) -> DataFrame:
    """(fiscal_year, start, month_days) of a year table whose first year starts on ``first_sunday``; each year starts where the one before
    ends. A table with a year missing or twice, a year of broken weeks, or a first day that is no Sunday is an error."""
    total = F.aggregate("month_days", F.lit(0), lambda s, n: s + n)
    before = Window.orderBy("fiscal_year").rowsBetween(Window.unboundedPreceding, -1)
    rows = table.select("fiscal_year", "month_days", total.alias("days"))
    first = F.to_date(F.lit(first_sunday))
    checked = rows.agg(F.count_if((F.col("days") % 7 != 0) | F.col("days").isNull()).alias("broken"), F.count("*").alias("n"), F.countDistinct("fiscal_year").alias("years"), (F.max("fiscal_year") - F.min("fiscal_year") + 1).alias("span"), F.first(F.dayofweek(first)).alias("day")).first()
    if checked.broken or checked.n == 0 or not checked.n == checked.years == checked.span or checked.day != 1:
        raise ValueError(f"a calendar needs consecutive years of whole weeks from a Sunday on: {checked.asDict()}")
    return rows.select("fiscal_year", F.date_add(first, F.coalesce(F.sum("days").over(before), F.lit(0)).cast("int")).alias("start"), "month_days")  # a row a year


def holiday_table(years: DataFrame) -> DataFrame:
    """Holidays are an input table: (date, holiday_name)."""
    each = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(name).alias("name")) for m, d, name in HOLIDAYS])
    every = years.select(F.explode(F.array(*[F.col("fiscal_year") + k for k in (-1, 0, 1)])).alias("y")).distinct()
    return every.select("y", F.explode(each).alias("h")).select(F.make_date("y", "h.m", "h.d").alias("date"), F.col("h.name").alias("holiday_name"))


def date_dimension(years: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """One row for each date of the fiscal years: fiscal and Gregorian attributes, weekend, holiday and daylight-saving flags. ``years`` are
    ``given_years``, or (fiscal_year) alone, for which the rule holds."""
    spans = years if "month_days" in years.columns else ruled_years(years)
    months = spans.select("fiscal_year", "start", "month_days", F.posexplode("month_days").alias("m", "n"))
    gone = F.aggregate(F.slice("month_days", F.lit(1), F.col("m")), F.lit(0), lambda s, n: s + n)
    days = months.select("fiscal_year", "start", (F.col("m") + 1).alias("fiscal_month"), gone.alias("gone"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"))
    at = F.col("gone") + F.col("k")
    days = days.select("fiscal_year", F.date_add("start", at).alias("date"), (F.floor(at / 7) + 1).cast("int").alias("fiscal_week"), "fiscal_month", (F.floor(F.col("k") / 7) + 1).cast("int").alias("fiscal_week_of_month"), (F.col("k") + 1).alias("day_of_fiscal_month"))
    holidays = holiday_table(years) if holidays is None else holidays
    d = F.col("date")
    return days.join(F.broadcast(holidays), "date", "left").select(
        "date",
        week_start(d).alias("week_start"),
        "fiscal_year",
        "fiscal_week",
        yearweek(F.col("fiscal_year"), F.col("fiscal_week")).alias("fiscal_year_week"),
        "fiscal_month",
        (F.col("fiscal_year") * 100 + F.col("fiscal_month")).cast("int").alias("fiscal_year_month"),
        "fiscal_week_of_month",
        "day_of_fiscal_month",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        (F.dayofweek(d) - 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.col("holiday_name").isNotNull().alias("is_holiday"),
        "holiday_name",
        is_dst(d).alias("is_dst"),
    )


def weekly_calendar(dates: DataFrame) -> DataFrame:
    """Dates rolled up to fiscal weeks: workdays, weekday holidays, week of month, weeks in month, elapsed fraction."""
    weekday = ~F.col("is_weekend")
    weekly = dates.groupBy(F.col("week_start").alias("ds"), "fiscal_year", "fiscal_week", "fiscal_year_week", "fiscal_month", "fiscal_year_month").agg(
        F.sum((weekday & ~F.col("is_holiday")).cast("int")).cast("int").alias("count_workdays"),
        F.sum((weekday & F.col("is_holiday")).cast("int")).cast("int").alias("holiday_days_in_week"),
    )
    month = Window.partitionBy("fiscal_year_month")
    weekly = weekly.withColumn("fiscal_week_of_month", F.row_number().over(month.orderBy("ds"))).withColumn("weeks_in_month", F.max("fiscal_week_of_month").over(month))
    return weekly.withColumn("origin_month_fraction_elapsed", F.col("fiscal_week_of_month") / F.col("weeks_in_month"))


def indexed(cal: DataFrame) -> DataFrame:
    """The calendar with dense week and month numbers, for arithmetic on periods (201201 - 1 is not a month)."""
    week = Window.orderBy("ds")
    return cal.withColumn("week_index", F.row_number().over(week)).withColumn("month_index", F.dense_rank().over(Window.orderBy("fiscal_year_month")))
