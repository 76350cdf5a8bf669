"""From raw trip facts to a zero-filled daily series per zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def file_month(name: Column) -> Column:
    """First day of the month that a file name carries as YYYY-MM."""
    return F.to_date(F.concat(F.regexp_extract(name, r"(\d{4}-\d{2})", 1), F.lit("-01")))


def date_sanity(trips: DataFrame, keep: bool = True) -> DataFrame:
    """Trips whose pickup date lies between one month before and two months after their file's month, ends included.

    A row expression: no distinct list of files and no join. ``keep`` False gives the complement, for reports.
    """
    dated = trips.withColumns({"pickup_date": F.to_date("pickup_ts"), "file_month": file_month(F.col("sourcefile_name"))})
    inside = F.col("pickup_date").between(F.add_months("file_month", -1), F.add_months("file_month", 2))
    return dated.where(inside if keep else ~F.coalesce(inside, F.lit(False)))


def strict_date_sanity(trips: DataFrame) -> DataFrame:
    """The variant that compares timestamps and leaves the ends out."""
    month = file_month(F.col("sourcefile_name"))
    return trips.where((F.col("pickup_ts") > F.add_months(month, -1).cast("timestamp_ntz")) & (F.col("pickup_ts") < F.add_months(month, 2).cast("timestamp_ntz")))


def fare_is_valid() -> Column:
    return ~((F.col("fare_amount") == 0) | (F.col("total_amount") == 0)) & ~((F.col("trip_distance") == 0) & (F.col("total_amount") <= 0))


def valid_fares(trips: DataFrame) -> DataFrame:
    """Without trips of no fare or total, and without those of no distance and no positive total; nulls go, as in SQL."""
    return trips.where(fare_is_valid())


def is_named() -> Column:
    """Whether a trip has an id: all that goes into it is there. Counts of ids need no id."""
    return F.col("vendor_id").isNotNull() & F.col("pickup_ts").isNotNull() & F.col("pu_zone").isNotNull() & F.col("do_zone").isNotNull() & F.col("sourcefile_name").isNotNull()


def trip_id() -> Column:
    """MD5 over vendor, pickup time with its offset (times are UTC), zones and source file; null if one of them is."""
    parts = [F.col("vendor_id").cast("string"), F.concat(F.date_format("pickup_ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00")), F.col("pu_zone").cast("string"), F.col("do_zone").cast("string"), F.col("sourcefile_name")]
    return F.md5(F.concat(*[x for p in parts for x in (p, F.lit("|"))][:-1]))


def local(ts: Column, tz: str) -> Column:
    """A UTC time without zone as a local one, whatever the session's zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ts)


def with_trip_columns(trips: DataFrame, tz: str = "America/New_York") -> DataFrame:
    """The columns that a curated trip has besides its own: an id, local dates, and hours of pickup and dropoff.

    An hour is that hour's start as UTC time, cut at local hours."""
    hour = lambda c: F.convert_timezone(F.lit(tz), F.lit("UTC"), F.date_trunc("hour", local(F.col(c), tz)).cast("timestamp_ntz"))
    return trips.withColumns(
        {
            "trip_id": trip_id(),
            "pickup_date": F.to_date(local(F.col("pickup_ts"), tz)),
            "pickup_hour": hour("pickup_ts"),
            "dropoff_date": F.to_date(local(F.col("dropoff_ts"), tz)),
            "dropoff_hour": hour("dropoff_ts"),
        }
    )


def curated(trips: DataFrame, tz: str = "America/New_York") -> DataFrame:
    """All columns of a trip, zones renamed, with those of ``with_trip_columns``, minutes of duration and from the file month's start."""
    minutes = lambda a, b: (F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))) / 6e7
    start, end = F.col("pickup_ts"), F.col("dropoff_ts")
    rows = with_trip_columns(trips, tz).withColumns({"duration_minutes": minutes(start, end), "offset_minutes": minutes(file_month(F.col("sourcefile_name")), start)})
    return rows.withColumnsRenamed({"pu_zone": "pickup_zone_id", "do_zone": "dropoff_zone_id"})


def daily_counts(trips: DataFrame, end: DataFrame | None = None, measure: Column | None = None) -> DataFrame:
    """Trips with an id (or another measure) per zone and date, up to the covered end if it is given; partial counts before the shuffle. An
    id isn't made to be counted: where its parts are there, they are asked."""
    named = is_named() if {"vendor_id", "pickup_ts", "do_zone", "sourcefile_name"} <= set(trips.columns) else F.col("trip_id").isNotNull()
    if end is not None:
        trips = trips.crossJoin(F.broadcast(end)).where("pickup_date <= covered_end")
    return trips.groupBy("pu_zone", "pickup_date").agg((F.count_if(named) if measure is None else F.sum(measure)).alias("n"))


def daily_facts(trips: DataFrame, tz: str = "America/New_York") -> DataFrame:
    """(pu_zone, pickup_date, n, valid, file_month) of trips that passed the date sanity: named trips and trips of a valid fare by zone and
    local date, and the newest file's month. One pass and one small table serve the daily series, its end and its zones."""
    dated = trips.withColumn("pickup_date", F.to_date(local(F.col("pickup_ts"), tz)))
    return dated.groupBy("pu_zone", "pickup_date").agg(F.count_if(fare_is_valid() & is_named()).alias("n"), F.count_if(fare_is_valid()).alias("valid"), F.max("file_month").alias("file_month"))


def daily_of(facts: DataFrame, end: DataFrame) -> DataFrame:
    """The daily counts of ``daily_facts`` up to the covered end."""
    return facts.where("valid > 0").crossJoin(F.broadcast(end)).where("pickup_date <= covered_end").select("pu_zone", "pickup_date", "n")


def covered_end(trips: DataFrame) -> DataFrame:
    """One row: the last day of the newest file's month."""
    return trips.agg(F.last_day(F.max("file_month")).alias("covered_end"))


def zone_spine(daily: DataFrame, end: DataFrame) -> DataFrame:
    """Every date of each zone from its first one to the covered end, none for a zone that starts later: one row per zone is exploded,
    nothing is range-joined."""
    first = daily.groupBy("pu_zone").agg(F.min("pickup_date").alias("first_date"))
    spans = first.crossJoin(F.broadcast(end)).where("first_date <= covered_end")
    return spans.select("pu_zone", F.explode(F.sequence("first_date", "covered_end")).alias("pickup_date"))


def zero_filled(daily: DataFrame, spine: DataFrame) -> DataFrame:
    return spine.join(daily, ["pu_zone", "pickup_date"], "left").select("pu_zone", "pickup_date", F.coalesce("n", F.lit(0)).alias("n"))


def zero_filled_by_union(daily: DataFrame) -> DataFrame:
    """The same over all zones and all dates seen, as a union with zeros that is summed."""
    zeros = daily.select("pu_zone").distinct().crossJoin(daily.select("pickup_date").distinct()).withColumn("n", F.lit(0).cast("long"))
    return daily.unionByName(zeros).groupBy("pu_zone", "pickup_date").agg(F.sum("n").alias("n"))


def month_cutoff(daily: DataFrame, dates: DataFrame) -> DataFrame:
    """One row (last_date, cutoff_month): the fiscal month of the last ride's date if that is the month's last day, else the month before."""
    last = daily.agg(F.max("pickup_date").alias("last_date"))
    ends = dates.groupBy("fiscal_year_month").agg(F.max("date").alias("month_end"))
    at = dates.select(F.col("date").alias("last_date"), "fiscal_year_month").join(F.broadcast(last), "last_date").join(ends, "fiscal_year_month")
    m = F.col("fiscal_year_month")
    before = F.when(m % 100 == 1, m - 89).otherwise(m - 1)
    return at.select("last_date", F.when(F.col("last_date") == F.col("month_end"), m).otherwise(before).cast("int").alias("cutoff_month"))


def daily_extract(daily: DataFrame, end: DataFrame, dates: DataFrame) -> DataFrame:
    """The extract that forecasting starts from: every zone and date of the daily counts from its first ride on, with its date's
    attributes and its number of rides, up to the last complete fiscal month. ``daily`` is read three times: give it written."""
    filled = zero_filled(daily, zone_spine(daily, end)).withColumnRenamed("n", "number_ride_pickups")
    names = ["day_of_fiscal_month", "fiscal_week", "fiscal_week_of_month", "fiscal_month", "fiscal_year", "fiscal_year_month", "day_of_week", "day_name", "is_weekend", "is_holiday", "holiday_name", "is_dst", "fiscal_year_week"]
    attributes = dates.select(F.col("date").alias("pickup_date"), *names, F.col("week_start").alias("fiscal_week_start_date"))
    rows = filled.join(F.broadcast(attributes), "pickup_date").crossJoin(F.broadcast(month_cutoff(daily, dates).select("cutoff_month")))
    return rows.where("fiscal_year_month <= cutoff_month").drop("cutoff_month")


def gaps(facts: DataFrame, key: str, ts: str, step: str) -> DataFrame:
    """Rows of a series that come later than one step after the row before."""
    before = F.lag(ts).over(Window.partitionBy(key).orderBy(ts))
    return facts.withColumn("previous", before).where(F.col(ts) > F.col("previous") + F.expr(step))
