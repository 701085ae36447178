"""Canonical tables from city pairs and carrier rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightloom.sources.tables import CARRIER_METRICS

LOAD_FACTORS = ("passenger_load_factor", "weight_load_factor")


def half_even(x: Column) -> Column:
    """Whole number, halves to even."""
    return F.bround(x, 0).cast("bigint")


def sum0(x: Column | str) -> Column:
    """Sum; 0 where nothing is known."""
    return F.coalesce(F.sum(x), F.lit(0))


def endpoints(pairs: DataFrame, a: str, b: str, to: str = "to_pax", back: str = "from_pax") -> DataFrame:
    """Two rows per pair: what departs from and arrives at each endpoint.  Blank sides count 0."""
    t, f = F.coalesce(to, F.lit(0.0)), F.coalesce(back, F.lit(0.0))
    sides = F.array(F.struct(F.col(a).alias("endpoint"), t.alias("dep"), f.alias("arr")), F.struct(F.col(b).alias("endpoint"), f.alias("dep"), t.alias("arr")))
    return pairs.withColumn("__e", F.explode(sides)).select(*(c for c in pairs.columns if c not in (a, b, to, back)), "__e.endpoint", "__e.dep", "__e.arr")


def finalize(sides: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: sums rounded half to even, passengers their sum after rounding."""
    known = sides.where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    out = known.groupBy(*keys).agg(half_even(sum0("dep")).alias("departures"), half_even(sum0("arr")).alias("arrivals"))
    return out.select(*keys, (F.col("departures") + F.col("arrivals")).alias("passengers"), "departures", "arrivals")


def monthly_throughput(resolved: DataFrame) -> DataFrame:
    """Airport months from resolved pairs; each side counts on its own, if its endpoint is known."""
    return finalize(endpoints(resolved, "a1", "a2").withColumnRenamed("endpoint", "airport"), ["p", "airport"])


def quarterly_throughput(resolved: DataFrame, known: DataFrame) -> DataFrame:
    """Airport quarters of known entities only."""
    sides = endpoints(resolved, "a1", "a2").withColumnRenamed("endpoint", "airport")
    return finalize(sides.join(known, "airport", "left_semi"), ["q", "airport"])


def directed_routes(resolved: DataFrame) -> DataFrame:
    """Both directions of pairs with two known, distinct endpoints; zero directions stay, repeats add up."""
    routable = resolved.where("a1 IS NOT NULL AND a2 IS NOT NULL AND a1 <> a2")
    t, f = F.coalesce("to_pax", F.lit(0.0)), F.coalesce("from_pax", F.lit(0.0))
    both = F.array(F.struct(F.col("a1").alias("origin"), F.col("a2").alias("destination"), t.alias("n")), F.struct(F.col("a2").alias("origin"), F.col("a1").alias("destination"), f.alias("n")))
    return routable.select("p", F.explode(both).alias("r")).groupBy("p", "r.origin", "r.destination").agg(half_even(sum0("r.n")).alias("passengers"))


def unresolved_volume(resolved: DataFrame, n: int = 5) -> DataFrame:
    """Labels without an entity and the passengers on their sides, largest first."""
    side = lambda a, label: F.when(F.col(a).isNull(), F.struct(F.coalesce(label, F.lit("(blank)")).alias("label"), (F.coalesce("to_pax", F.lit(0.0)) + F.coalesce("from_pax", F.lit(0.0))).alias("n")))
    sides = resolved.select(F.explode(F.array_compact(F.array(side("a1", "city1"), side("a2", "city2")))).alias("s"))
    return sides.groupBy("s.label").agg(half_even(F.sum("s.n")).alias("passengers")).orderBy(F.desc("passengers"), "label").limit(n)


def complete_years(df: DataFrame, ordinal: str, per_year: int) -> DataFrame:
    """Years in which every period occurs somewhere in the table."""
    year = F.floor(F.col(ordinal) / F.lit(per_year)).cast("int")
    return df.select(year.alias("year"), F.col(ordinal).alias("__o")).groupBy("year").agg(F.countDistinct("__o").alias("n")).where(F.col("n") == per_year).select("year")


def yearly(monthly: DataFrame, quarterly: DataFrame) -> DataFrame:
    """Yearly totals per airport and category, over years complete in the table as a whole."""
    def part(df: DataFrame, ordinal: str, per_year: int, category: str) -> DataFrame:
        rows = df.withColumn("year", F.floor(F.col(ordinal) / F.lit(per_year)).cast("int")).join(complete_years(df, ordinal, per_year), "year", "left_semi")
        return rows.groupBy("year", "airport").agg(sum0("passengers").alias("passengers")).withColumn("category", F.lit(category))

    return part(monthly, "p", 12, "domestic").unionByName(part(quarterly, "q", 4, "international"))


def tidy_carriers(raw: DataFrame, keys: list[str]) -> DataFrame:
    """Carrier facts per key: metrics summed (0 where unknown), load factors averaged without weights."""
    sums = [F.coalesce(F.sum(F.col(m).cast("decimal(24,3)")), F.lit(0)).cast("double").alias(m) for m in CARRIER_METRICS if m not in LOAD_FACTORS]
    # exact sums, so that the mean does not depend on the order of rows
    means = [F.try_divide(F.sum(F.col(m).cast("decimal(24,6)")).cast("double"), F.count(m)).alias(m) for m in LOAD_FACTORS]
    return raw.groupBy(*keys).agg(half_even(F.sum("passengers")).alias("passengers"), *sums, *means)
