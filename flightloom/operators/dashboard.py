"""Analytics over the national series, the airports and the gateways."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightloom.operators import canonical, windows


def carried(carrier: DataFrame, service: str = "scheduled_domestic") -> DataFrame:
    """Passengers carried per month: the national layer."""
    return carrier.where(F.col("service_type") == service).groupBy("p").agg(canonical.sum0("passengers").alias("passengers"))


def throughput(df: DataFrame, ordinal: str = "p") -> DataFrame:
    return df.groupBy(ordinal).agg(canonical.sum0("passengers").alias("passengers"))


def demand_pulse(carrier: DataFrame, known_zero: list[int]) -> DataFrame:
    """National series with its trailing year and both changes against a year before."""
    return windows.national_trailing(carried(carrier), "passengers", 12, known_zero)


def trailing_leaders(monthly: DataFrame, n: int = 10, most: int = 12) -> DataFrame:
    """Top airports by trailing year, now or twelve emitted windows ago, with all their windows."""
    t12 = windows.matrix_trailing(monthly, "airport", "passengers", 12)
    order = t12.select("p").distinct().withColumn("back", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("p"))))
    ends = t12.join(order.where("back IN (1, 13)"), "p")
    place = F.row_number().over(Window.partitionBy("p").orderBy(F.desc("total"), "airport"))
    top = ends.withColumn("place", place).where(F.col("place") <= n)
    now = t12.join(order.where("back = 1"), "p").select("airport", F.col("total").alias("latest"))
    chosen = top.select("airport").distinct().join(now, "airport").orderBy(F.desc("latest"), "airport").limit(most)
    return t12.join(chosen.select("airport"), "airport", "left_semi")


def newcomer_ramps(monthly: DataFrame, months: int = 24, observed: int = 3, cumulative: int = 100_000, peak: int = 20_000) -> DataFrame:
    """Airports first seen a year or more after the data begin, over their first ``months`` calendar months."""
    start = monthly.agg((F.min("p") + 12).alias("from_p"))
    fresh = windows.first_seen(monthly.where("passengers IS NOT NULL"), "airport").join(F.broadcast(start), F.col("first_p") >= F.col("from_p")).drop("from_p")
    rows = monthly.where("passengers IS NOT NULL").join(fresh, "airport").where(F.col("p") < F.col("first_p") + months)
    all_of = Window.partitionBy("airport")
    sized = rows.withColumn("n", F.count(F.lit(1)).over(all_of)).withColumn("cumulative", F.sum("passengers").over(all_of)).withColumn("peak", F.max("passengers").over(all_of))
    kept = sized.where((F.col("n") >= observed) & ((F.col("cumulative") >= cumulative) | (F.col("peak") >= peak)))
    return kept.select("airport", (F.col("p") - F.col("first_p")).alias("month_index"), "passengers", "cumulative", "peak")


def share_movers(df: DataFrame, entity: str, ordinal: str, width: int, least: int, n: int) -> DataFrame:
    """Largest winners and losers of share, in points, between the latest ``width`` periods and those before.

    Nothing if one of these periods is missing; an airport that is both counts as a loser.
    """
    base = df.select(entity, F.col(ordinal).alias("p"), "passengers")
    last = base.agg(F.max("p").alias("hi"))
    side = base.join(F.broadcast(last), (F.col("p") > F.col("hi") - 2 * width) & (F.col("p") <= F.col("hi")))
    whole = side.agg(F.countDistinct("p").alias("n")).where(F.col("n") == 2 * width)
    side = side.join(F.broadcast(whole), F.lit(True)).drop("n")
    recent = F.col("p") > F.col("hi") - width
    sums = side.groupBy(entity).agg(F.coalesce(F.sum(F.when(recent, F.col("passengers"))), F.lit(0)).alias("latest"), F.coalesce(F.sum(F.when(~recent, F.col("passengers"))), F.lit(0)).alias("previous"))
    totals = sums.agg(F.sum("latest").alias("tl"), F.sum("previous").alias("tp"))
    share = sums.join(F.broadcast(totals), F.lit(True)).where((F.col("latest") >= least) | (F.col("previous") >= least))
    moved = share.select(entity, "latest", "previous", (100 * F.try_divide(F.col("latest").cast("double"), F.col("tl").cast("double")) - 100 * F.try_divide(F.col("previous").cast("double"), F.col("tp").cast("double"))).alias("delta"))
    # two top-n plans, each task keeps n rows, instead of one order of all entities
    shown = lambda side: [F.col(entity), F.col("latest"), F.col("previous"), F.round("delta", 9).alias("delta_pp"), F.lit(side).alias("side")]
    losers = moved.orderBy("delta", entity).limit(n).select(*shown("loser"))
    gainers = moved.orderBy(F.desc("delta"), entity).limit(n).select(*shown("gainer"))
    return losers.unionByName(gainers.join(losers, entity, "left_anti"))


def seasonality(monthly: DataFrame, least_years: int = 3, least_t12: int = 100_000, most: int = 60) -> DataFrame:
    """Index per airport and calendar month over complete years: 100 is a twelfth of the year's passengers.

    A report on the ``most`` largest airports by trailing year.
    """
    years = canonical.complete_years(monthly, "p", 12)
    rows = monthly.withColumn("year", F.floor(F.col("p") / F.lit(12)).cast("int")).withColumn("month", F.pmod("p", F.lit(12)) + 1).join(years, "year", "left_semi")
    t12 = windows.matrix_trailing(monthly, "airport", "passengers", 12)
    latest = t12.groupBy("airport").agg(F.max_by("total", "p").alias("t12")).where(F.col("t12") >= least_t12)
    enough = rows.groupBy("airport").agg(F.countDistinct("year").alias("n")).where(F.col("n") >= least_years).join(latest, "airport").orderBy(F.desc("t12"), "airport").limit(most).select("airport")
    annual = F.sum("passengers").over(Window.partitionBy("airport", "year"))
    index = rows.join(enough, "airport", "left_semi").withColumn("idx", F.try_divide(F.col("passengers").cast("double") * 12, annual.cast("double")) * 100)
    return index.groupBy("airport", F.col("month").cast("int").alias("month")).agg(F.round(F.avg("idx"), 6).alias("idx"))


def kpis(monthly: DataFrame, quarterly: DataFrame, carrier: DataFrame, known_zero: list[int]) -> DataFrame:
    """One row: the latest figures of the three layers; airport context is null if the layers end in different months."""
    pulse = demand_pulse(carrier, known_zero).where("value IS NOT NULL").orderBy(F.desc("p")).limit(1)
    a = pulse.select(F.col("p").alias("latest_p"), F.col("value").alias("carried"), F.col("total").alias("carried_t12"))
    last = throughput(monthly).orderBy(F.desc("p")).limit(1).select(F.col("p").alias("airport_p"), F.col("passengers").alias("throughput"))
    active = monthly.groupBy("p").agg(F.countDistinct(F.when(F.col("passengers") > 0, F.col("airport"))).alias("active_airports")).orderBy(F.desc("p")).limit(1).drop("p")
    gates = windows.positional_trailing(throughput(quarterly, "q").withColumnRenamed("q", "p"), "passengers", 4).orderBy(F.desc("p")).limit(1).select(F.col("p").alias("latest_q"), F.col("total").alias("gateway_t4"))
    one = a.join(last, F.lit(True)).join(active, F.lit(True)).join(gates, F.lit(True))
    same = F.col("latest_p") == F.col("airport_p")
    return one.select("latest_p", "carried", "carried_t12", F.when(same, F.col("throughput")).alias("throughput"), F.when(same, F.col("active_airports")).alias("active_airports"), "latest_q", "gateway_t4")


def race(monthly: DataFrame, n: int = 10) -> DataFrame:
    """Top airports of every trailing year, with the total over all airports."""
    t12 = windows.matrix_trailing(monthly, "airport", "passengers", 12)
    per = Window.partitionBy("p")
    placed = t12.withColumn("place", F.row_number().over(per.orderBy(F.desc("total"), "airport"))).withColumn("everyone", F.sum("total").over(per))
    return placed.where(F.col("place") <= n).select("p", "place", "airport", "total", "everyone")
