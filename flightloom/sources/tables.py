"""Declared tables: schema, natural key and version, and readers over them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom.functions import keys, periods


@dataclass(frozen=True)
class TableSpec:
    """What a published table promises: exact columns, natural key, schema version."""

    name: str
    columns: tuple[tuple[str, str], ...]
    key: tuple[str, ...]
    version: str

    @property
    def ddl(self) -> str:
        return ", ".join(f"{c} {t}" for c, t in self.columns)


_MEASURES = (("passengers", "bigint"), ("departures", "bigint"), ("arrivals", "bigint"))
CARRIER_METRICS = (
    "aircraft_km",
    "passenger_km",
    "seat_km",
    "freight_tonnes",
    "mail_tonnes",
    "total_tonne_km",
    "available_tonne_km",
    "passenger_load_factor",
    "weight_load_factor",
)
SPECS = {
    s.name: s
    for s in (
        TableSpec("airport_monthly", (("year", "int"), ("month", "int"), ("airport", "string"), *_MEASURES), ("year", "month", "airport"), "2.0"),
        TableSpec("airport_international_quarterly", (("year", "int"), ("quarter", "int"), ("airport", "string"), *_MEASURES), ("year", "quarter", "airport"), "1.0"),
        TableSpec("airport_yearly", (("year", "int"), ("airport", "string"), ("category", "string"), ("passengers", "bigint")), ("year", "airport", "category"), "2.0"),
        TableSpec(
            "domestic_route_monthly",
            (("year", "int"), ("month", "int"), ("origin", "string"), ("destination", "string"), ("passengers", "bigint")),
            ("year", "month", "origin", "destination"),
            "1.0",
        ),
        TableSpec(
            "carrier_monthly",
            (("airline", "string"), ("service_type", "string"), ("year", "int"), ("month", "int"), ("passengers", "bigint"), *((m, "double") for m in CARRIER_METRICS)),
            ("airline", "service_type", "year", "month"),
            "1.0",
        ),
    )
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One parquet table of a data folder; filters and columns reach the scan."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def rows_that_count(df: DataFrame, key: list[str], values: list[str], order: str = "loaded_at") -> DataFrame:
    """Of several rows of one key, the one delivered last.

    One hash aggregate with map-side combine (no window, no sort): a key that
    holds a third of all rows is reduced before the shuffle.  Ties in ``order``
    are decided by the values themselves, so that the result does not depend on
    the order of rows.  A null in a key column drops the row.
    """
    known = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in key))
    picked = known.groupBy(*key).agg(F.max_by(F.struct(*values), F.struct(F.col(order), *(F.col(v) for v in values))).alias("__row"))
    return picked.select(*key, *(F.col(f"__row.{v}").alias(v) for v in values))


def airport_months(spark: SparkSession, root: str, values: tuple[str, ...] = ("passengers", "departures", "arrivals")) -> DataFrame:
    """airport_monthly in published form: (airport, p, ``values``); only these columns are read."""
    raw = read_table(spark, root, "airport_monthly").select(keys.code("airport").alias("airport"), periods.month_ordinal("year", "month").alias("p"), *values, "loaded_at")
    return rows_that_count(raw, ["airport", "p"], list(values))


def airport_quarters(spark: SparkSession, root: str) -> DataFrame:
    """airport_international_quarterly in published form; only quarters 1 to 4 are kept."""
    raw = (
        read_table(spark, root, "airport_international_quarterly")
        .where(F.col("quarter").between(1, 4))
        .select(keys.code("airport").alias("airport"), periods.quarter_ordinal("year", "quarter").alias("q"), "passengers", "departures", "arrivals", "loaded_at")
    )
    return rows_that_count(raw, ["airport", "q"], ["passengers", "departures", "arrivals"])


def route_months(spark: SparkSession, root: str) -> DataFrame:
    """domestic_route_monthly in published form: (origin, destination, p, passengers)."""
    raw = read_table(spark, root, "domestic_route_monthly").select(
        keys.code("origin").alias("origin"), keys.code("destination").alias("destination"), periods.month_ordinal("year", "month").alias("p"), "passengers", "loaded_at"
    )
    return rows_that_count(raw, ["origin", "destination", "p"], ["passengers"])


def carrier_months(spark: SparkSession, root: str, values: tuple[str, ...] = ("passengers", *CARRIER_METRICS)) -> DataFrame:
    """carrier_monthly in published form: (airline, service_type, p, ``values``); only these columns are read."""
    raw = read_table(spark, root, "carrier_monthly").select(
        F.trim("airline").alias("airline"), keys.service_type("service_type").alias("service_type"), periods.month_ordinal("year", "month").alias("p"), *values, "loaded_at"
    )
    return rows_that_count(raw, ["airline", "service_type", "p"], list(values))
