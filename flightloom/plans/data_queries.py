"""Queries over the data problems 1 to 7 on the test tables, with their SQL where SQL can say it."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom.functions import keys, periods
from flightloom.operators import anomalies, grid, intervals, profile, schema_drift, snapshots, trailing
from flightloom.plans.carrier_files import CARRIER_FILES
from flightloom.sources.tables import CARRIER_METRICS, airport_months, carrier_months, read_table

MAX_GAP = 2
PASSENGERS = anomalies.Rule(ratio=True, lower=0.0, upper=math.inf, jump=math.log(4.0))
LOAD_FACTOR = anomalies.Rule(ratio=False, lower=0.0, upper=100.0, jump=25.0)


def _year_month(p: str = "period") -> list:
    return [periods.ordinal_year(p).alias("year"), periods.ordinal_month(p).alias("month")]


def _airport_grid(spark: SparkSession, root: str) -> DataFrame:
    raw = read_table(spark, root, "airport_monthly")
    return grid.regular_grid(raw, keys.code("airport"), periods.month_ordinal("year", "month"), "passengers", "loaded_at", MAX_GAP)


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    holes = _airport_grid(spark, root).where("status <> 'observed'")
    return holes.select(F.col("source").alias("airport"), *_year_month())


def p1_grid(spark: SparkSession, root: str) -> DataFrame:
    return _airport_grid(spark, root).select(F.col("source").alias("airport"), *_year_month(), "reading", "value", "status")


def _sheet_columns(spark: SparkSession, root: str) -> DataFrame:
    return schema_drift.file_columns(read_table(spark, root, "sheet_rows"), CARRIER_FILES)


def _per_feed(spark: SparkSession, root: str, read) -> DataFrame:
    part = lambda k: F.regexp_extract("file", r"^carrier_(.+)_(\d{4})_(\d{1,2})\.xlsx$", k)
    feed = F.when(part(1) != "", part(1))
    return read(_sheet_columns(spark, root), CARRIER_FILES, feed, periods.month_ordinal(part(2).try_cast("int"), part(3).try_cast("int")))


def _sheet_changes(spark: SparkSession, root: str) -> DataFrame:
    return _per_feed(spark, root, schema_drift.schema_changes)


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return _sheet_changes(spark, root).where("change_kind <> 'moved'").select("file", "field", "change_kind").distinct()


def p2_table(spark: SparkSession, root: str) -> DataFrame:
    table = schema_drift.consistent_table(read_table(spark, root, "sheet_rows"), CARRIER_FILES, _per_feed(spark, root, schema_drift.projections))
    return table.select(
        "file", "row_idx", "airline", keys.service_type("type").alias("service_type"), F.col("year").try_cast("int").alias("year"), F.col("month").try_cast("int").alias("month"),
        F.round("passengers").cast("long").alias("passengers"), *CARRIER_METRICS,
    )


def p3_trailing(spark: SparkSession, root: str) -> DataFrame:
    air = airport_months(spark, root, ("passengers",)).select(F.lit("airport_monthly").alias("table_name"), F.col("airport").alias("entity"), "p", "passengers")
    car = carrier_months(spark, root, ("passengers",)).select(F.lit("carrier_monthly").alias("table_name"), F.concat_ws("|", "airline", "service_type").alias("entity"), "p", "passengers")
    out = trailing.trailing_totals(air.unionByName(car), ["table_name", "entity"], "p", "passengers", (3, 12))
    return out.select("table_name", "entity", *_year_month(), F.col("value").alias("passengers"), "total_3", "avg_3", "active_3", "total_12", "avg_12", "active_12")


def _changes(spark: SparkSession, root: str, table: str) -> DataFrame:
    raw = read_table(spark, root, f"{table}_snapshots")
    year, month = periods.full_year("year"), F.col("month")
    if table == "airport_monthly":
        key, entity = {"airport": keys.loose("airport")}, keys.code("airport")
        measures = [F.col(c) for c in ("passengers", "departures", "arrivals")]
    elif table == "carrier_monthly":
        key = {"airline": keys.loose("airline"), "service_type": keys.loose("service_type")}
        entity = F.concat_ws("|", F.trim("airline"), keys.service_type("service_type"))
        measures = [F.col("passengers"), *(snapshots.to_thousandths(m) for m in CARRIER_METRICS)]
    else:
        key = {"origin": keys.loose("origin"), "destination": keys.loose("destination")}
        entity = F.concat_ws("|", keys.code("origin"), keys.code("destination"))
        measures = [F.col("passengers")]
    out = snapshots.snapshot_changes(raw, "snapshot_no", key | {"year": year, "month": month}, {"entity": entity, "year": year, "month": month}, measures)
    return out.select(F.lit(table).alias("table_name"), "*")


def _all_changes(spark: SparkSession, root: str) -> DataFrame:
    a, b, c = (_changes(spark, root, t) for t in ("airport_monthly", "carrier_monthly", "domestic_route_monthly"))
    return a.unionByName(b).unionByName(c)


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return _all_changes(spark, root).select("table_name", "snapshot_no", "entity", "year", "month", "change_kind").distinct()


def p4_changes(spark: SparkSession, root: str) -> DataFrame:
    text = lambda c: F.when(F.col(c).isNotNull(), F.concat_ws("|", F.transform(c, lambda x: F.coalesce(x, F.lit("?")))))
    return _all_changes(spark, root).withColumn("before", text("before")).withColumn("after", text("after"))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    spans = intervals.coverage_spans(read_table(spark, root, "entity_windows"), keys.code("canonical"), "lo", "hi")
    return spans.withColumnRenamed("entity", "canonical")


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return _flags(spark, root).select(F.col("measure").alias("table_name"), F.col("source").alias("entity"), *_year_month()).distinct()


def _flags(spark: SparkSession, root: str) -> DataFrame:
    air = airport_months(spark, root, ("passengers",)).select(F.lit("airport_monthly").alias("measure"), F.col("airport").alias("source"), F.col("p").alias("period"), F.col("passengers").cast("double").alias("value"))
    car = carrier_months(spark, root, ("passenger_load_factor",)).select(F.lit("carrier_monthly").alias("measure"), F.concat_ws("|", "airline", "service_type").alias("source"), F.col("p").alias("period"), F.col("passenger_load_factor").alias("value"))
    return anomalies.flag_implausible(air.unionByName(car), {"airport_monthly": PASSENGERS, "carrier_monthly": LOAD_FACTOR})


def p6_flags(spark: SparkSession, root: str) -> DataFrame:
    return _flags(spark, root).select(F.col("measure").alias("table_name"), F.col("source").alias("entity"), *_year_month(), "value", "flag", F.round("probability", 6).alias("probability"))


#: The columns whose loads are named, and the columns that tell two rows of a table apart.
WATCHED = {
    "airport_monthly": ([profile.ColumnCheck("passengers", 0.0, None, 1.0)], ["airport", "year", "month"]),
    "airport_international_quarterly": ([profile.ColumnCheck("quarter", 1.0, 4.0)], ["airport", "year", "passengers"]),
    "carrier_monthly": ([profile.ColumnCheck("passenger_load_factor", 0.0, 100.0, 0.001)], ["airline", "service_type", "year", "month"]),
}
_COUNT = lambda c: profile.ColumnCheck(c, 0.0, None, 1.0)
#: For the whole profile, all other measures next to them, and the routes.  Calendar columns tell every load apart by design,
#: texts have no size: both are left to :func:`p7_tables`.
PROFILED = {
    "airport_monthly": ([*WATCHED["airport_monthly"][0], *map(_COUNT, ("departures", "arrivals"))], WATCHED["airport_monthly"][1]),
    "domestic_route_monthly": ([_COUNT("passengers")], ["origin", "destination", "year", "month"]),
    "airport_international_quarterly": ([*WATCHED["airport_international_quarterly"][0], *map(_COUNT, ("passengers", "departures", "arrivals"))], WATCHED["airport_international_quarterly"][1]),
    "carrier_monthly": (
        [*WATCHED["carrier_monthly"][0], profile.ColumnCheck("weight_load_factor", 0.0, 100.0, 0.001), _COUNT("passengers")]
        + [profile.ColumnCheck(m, 0.0, None, 0.001) for m in CARRIER_METRICS if not m.endswith("_load_factor")],
        WATCHED["carrier_monthly"][1],
    ),
}
#: Patterns that the values of a column must match, and the tables whose columns are all profiled.
_NUMBER, _SHARE = r"^[0-9]+(\.[0-9]+)?(E-?[0-9]+)?$", r"^(100(\.0+)?|[0-9]{1,2}(\.[0-9]+)?|[0-9](\.[0-9]+)?E-[0-9]+)$"
PATTERNS = {
    "year": r"^[0-9]{4}$", "month": r"^([1-9]|1[0-2])$", "quarter": r"^[1-4]$", "airport": r"^[A-Z]{5}$", "origin": r"^[A-Z]{5}$", "destination": r"^[A-Z]{5}$",
    "airline": r"^\S(.*\S)?$", "service_type": r"^[a-z]+(_[a-z]+)*$", "passengers": r"^[0-9]+$", "departures": r"^[0-9]+$", "arrivals": r"^[0-9]+$",
    **{m: _SHARE if m.endswith("_load_factor") else _NUMBER for m in CARRIER_METRICS},
}
LOADED = ("airport_monthly", "domestic_route_monthly", "carrier_monthly", "airport_international_quarterly")


def _load_profile(spark: SparkSession, root: str, watched: dict, compared: dict) -> DataFrame:
    """Base aggregates of the ``watched`` columns; the classifier reads all columns that are ``compared``."""
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    base = union([profile.load_cells(read_table(spark, root, t), t, "load_no", checks) for t, (checks, _) in watched.items()])
    rows = union([profile.features(read_table(spark, root, t), t, "load_no", *compared[t]) for t in watched])
    return profile.profile_loads(profile.base_profile(base), profile.discrimination(rows, {t: [c.column for c in compared[t][0]] for t in watched}))


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    return profile.load_issues(_load_profile(spark, root, WATCHED, PROFILED))


def p7_profile(spark: SparkSession, root: str) -> DataFrame:
    return _load_profile(spark, root, PROFILED, PROFILED)


def p7_columns(spark: SparkSession, root: str) -> DataFrame:
    raw = read_table(spark, root, "airport_monthly").drop("loaded_at")
    return profile.column_profile(raw, "load_no", {"year": r"^[0-9]{4}$", "month": r"^([1-9]|1[0-2])$", "airport": r"^[A-Z]{5}$", "passengers": r"^[0-9]+$", "departures": r"^[0-9]+$", "arrivals": r"^[0-9]+$"})


def p7_tables(spark: SparkSession, root: str) -> DataFrame:
    """Every column of every table with loads; :func:`p7_columns` is the part of it that its SQL says."""
    parts = [profile.column_profile(read_table(spark, root, t), "load_no", PATTERNS).select(F.lit(t).alias("table_name"), "*") for t in LOADED]
    return reduce(DataFrame.unionByName, parts)


QUERIES = {f.__name__: f for f in (p1_found, p1_grid, p2_found, p2_table, p3_trailing, p4_found, p4_changes, p5_found, p6_found, p6_flags, p7_found, p7_profile, p7_columns, p7_tables)}
