"""Static schedules and category dictionaries from CSV: by header name, as text, then cast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns that aren't text, by file.
CASTS = {
    "attributions": {"is_operator": "int"},
    "calendar": {x: "int" for x in ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "start_date", "end_date")},
    "calendar_dates": {"date": "int", "exception_type": "int"},
    "routes": {"route_type": "int"},
    "stops": {"stop_lat": "double", "stop_lon": "double", "location_type": "int"},
    "stop_times": {"stop_sequence": "int", "pickup_type": "int", "drop_off_type": "int", "shape_dist_traveled": "double"},
    "trips": {"direction_id": "int"},
}
CATEGORIES = ("Växjö city lines", "Other town lines", "Regional lines", "School routes")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header, RFC 4180 quotes, all columns text; ids keep their digits and zeros.

    Lines may end in any of the usual ways, or in a doubled carriage return as some archives write it:
    the empty line that this leaves is no row.
    """
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", False).option("inferSchema", False).csv(path)


def read_schedule_file(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One file of a schedule with its casts; a column that the file lacks isn't made up."""
    raw = read_csv(spark, f"{folder}/{name}.txt")
    return raw.select(*(F.col(c).try_cast(CASTS.get(name, {}).get(c, "string")).alias(c) for c in raw.columns))


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """route_id, category and town; raises ValueError naming every problem at once."""
    raw = read_csv(spark, path)
    town = (F.col("category") == "Other town lines") != (F.coalesce("town", F.lit("")) != "")
    found = raw.select(
        F.when(F.count("*").over(_by("route_id")) > 1, F.concat(F.lit("duplicate route "), "route_id")).alias("a"),
        F.when(~F.coalesce(F.col("category").isin(*CATEGORIES), F.lit(False)), F.concat_ws(" ", F.lit("unknown category of"), "route_id")).alias("b"),
        F.when(town, F.concat_ws(" ", F.lit("town doesn't fit the category of"), "route_id")).alias("c"),
    )
    problems = found.select(F.explode(F.array("a", "b", "c")).alias("p")).filter("p IS NOT NULL").distinct().orderBy("p").collect()
    if problems:
        raise ValueError("; ".join(r["p"] for r in problems))
    return raw.select("route_id", "category", F.nullif("town", F.lit("")).alias("town"))


def _by(column: str):
    from pyspark.sql import Window

    return Window.partitionBy(column)


def active_services(calendar: DataFrame, dates: DataFrame, day: int, weekday: str) -> DataFrame:
    """Services running on a YYYYMMDD day: by weekday and range, without removals, with additions."""
    regular = calendar.filter((F.col(weekday) == 1) & (F.col("start_date") <= day) & (F.col("end_date") >= day)).select("service_id")
    on = dates.filter(F.col("date") == day)
    kept = regular.join(on.filter("exception_type = 2").select("service_id"), "service_id", "left_anti")
    return kept.union(on.filter("exception_type = 1").select("service_id")).distinct()


def trip_scope(trips: DataFrame, attributions: DataFrame, home: str) -> DataFrame:
    """Per trip its operator and whether it is in scope; raises ValueError if a trip has two operators."""
    ops = attributions.filter("is_operator = 1").groupBy("trip_id").agg(F.max("organization_name").alias("operator"), F.count("*").alias("n"))
    if ops.filter("n > 1").limit(1).count():
        raise ValueError("a trip has more than one operator")
    return trips.join(ops.drop("n"), "trip_id", "left").withColumn("in_scope", F.col("operator").isNull() | (F.col("operator") == home))


def timing_flag(timepoint):
    """1, empty and null are timing stops, 0 isn't, anything else is null."""
    return F.when(timepoint.isNull() | timepoint.isin("1", ""), True).when(timepoint == "0", False)
