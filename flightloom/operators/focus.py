"""Questions about single entities, groups and markets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightloom.operators import canonical, windows
from flightloom.operators.windows import along


def _year(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.floor(F.col("p") / F.lit(12)).cast("int"))


def growth_rate(series: DataFrame, value: str, most_years: int = 10) -> DataFrame:
    """One row: latest window, its change in a year, and the yearly growth rate over up to ``most_years``."""
    known = series.where(F.col(value).isNotNull())
    span = known.agg(F.count(F.lit(1)).alias("n"), F.max("p").alias("hi")).withColumn("years", F.least(F.lit(most_years), F.floor((F.col("n") - 1) / 12).cast("int"))).where("years >= 1")
    at = lambda name, p: known.select(F.col("p").alias(f"p_{name}"), F.col(value).alias(name)).join(F.broadcast(span.select(p.alias(f"p_{name}"))), f"p_{name}", "left_semi")
    last, before, base = at("latest", F.col("hi")), at("year_ago", F.col("hi") - 12), at("base", F.col("hi") - 12 * F.col("years"))
    one = span.join(last, F.col("hi") == F.col("p_latest"), "left").join(before, F.col("hi") - 12 == F.col("p_year_ago"), "left").join(base, F.col("hi") - 12 * F.col("years") == F.col("p_base"), "left")
    ratio = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    return one.select("hi", "years", "latest", "year_ago", "base", F.round(ratio("latest", "year_ago") - 1, 6).alias("yoy"), F.round(F.pow(ratio("latest", "base"), F.lit(1.0) / F.col("years")) - 1, 6).alias("rate"))


def supply_demand(carrier: DataFrame, service: str = "scheduled_domestic", points: int = 37) -> DataFrame:
    """Trailing years of seats and demand as indices to a common base, with the load factor."""
    monthly = carrier.where(F.col("service_type") == service).groupBy("p").agg(F.sum("passengers").alias("passengers"), F.sum(F.col("seat_km").cast("decimal(24,3)")).alias("seat_km"), F.sum(F.col("passenger_km").cast("decimal(24,3)")).alias("passenger_km"))
    w = along().rangeBetween(-11, 0)
    full = lambda c: F.when(F.count(c).over(w) == 12, F.sum(c).over(w)).cast("double").alias(c)
    t12 = monthly.select("p", full("passengers"), full("seat_km"), full("passenger_km")).where("passengers IS NOT NULL AND seat_km IS NOT NULL AND passenger_km IS NOT NULL")
    last = t12.orderBy(F.desc("p")).limit(points)
    first = along().rowsBetween(Window.unboundedPreceding, 0)
    index = lambda c: F.round(F.col(c) / F.first(c).over(first) * 100, 6).alias(f"idx_{c}")
    return last.select("p", index("seat_km"), index("passenger_km"), index("passengers"), F.round(F.try_divide("passenger_km", "seat_km") * 100, 6).alias("load_factor"))


def group_shares(df: DataFrame, entity: str, members: DataFrame, complete: DataFrame, value: str = "passengers") -> DataFrame:
    """Share of each group per complete year; membership is looked up without regard to case, the rest is ``other``."""
    known = members.select(F.lower(entity).alias("__k"), "grp").distinct()
    rows = _year(df).join(complete, "year", "left_semi").withColumn("__k", F.lower(entity)).join(known, "__k", "left")
    sums = rows.groupBy("year", F.coalesce("grp", F.lit("other")).alias("grp")).agg(canonical.sum0(value).alias("passengers"))
    return sums.withColumn("share", F.round(F.try_divide(F.col("passengers").cast("double"), F.sum("passengers").over(Window.partitionBy("year")).cast("double")), 9))


def members_without_rows(members: DataFrame, df: DataFrame, entity: str) -> DataFrame:
    return members.select(entity).distinct().join(df.select(entity).distinct(), entity, "left_anti")


def focus_vs_rest(monthly: DataFrame, focus: str, points: int = 61) -> DataFrame:
    """Trailing years of one airport and of all others, each as an index to the first point."""
    t12 = windows.matrix_trailing(monthly, "airport", "passengers", 12)
    two = t12.groupBy("p").agg(F.sum(F.when(F.col("airport") == focus, F.col("total"))).alias("focus"), F.sum(F.when(F.col("airport") != focus, F.col("total"))).alias("rest"))
    last = two.where("focus > 0 AND rest > 0").orderBy(F.desc("p")).limit(points)
    first = along().rowsBetween(Window.unboundedPreceding, 0)
    index = lambda c: F.round(F.col(c).cast("double") / F.first(c).over(first).cast("double") * 100, 6).alias(f"idx_{c}")
    return last.select("p", "focus", "rest", index("focus"), index("rest"))


def gateway_share(quarterly: DataFrame, focus: str) -> DataFrame:
    """Share of one gateway in trailing four quarters, and whether it is the largest."""
    t4 = windows.matrix_trailing(quarterly.select("airport", F.col("q").alias("p"), "passengers"), "airport", "passengers", 4)
    per = t4.groupBy("p").agg(F.sum("total").alias("all"), F.sum(F.when(F.col("airport") == focus, F.col("total"))).alias("own"), F.max_by("airport", F.struct("total", "airport")).alias("largest"))
    return per.select("p", "own", "all", F.round(F.try_divide(F.col("own").cast("double"), F.col("all").cast("double")), 9).alias("share"), (F.col("largest") == focus).alias("is_largest"))


def median_season(monthly: DataFrame, without: list[int] | None = None) -> DataFrame:
    """Per airport: median index of each calendar month over the airport's own complete years."""
    rows = _year(monthly.where("passengers IS NOT NULL")).withColumn("month", (F.pmod("p", F.lit(12)) + 1).cast("int"))
    if without:
        rows = rows.where(~F.col("year").isin(without))
    per_year = Window.partitionBy("airport", "year")
    full = rows.withColumn("n", F.count(F.lit(1)).over(per_year)).withColumn("annual", F.sum("passengers").over(per_year)).where("n = 12 AND annual > 0")
    index = F.col("passengers").cast("double") * 1200 / F.col("annual").cast("double")
    return full.groupBy("airport", "month").agg(F.round(F.median(index), 6).alias("idx"), F.count(F.lit(1)).alias("years"))


def peak_month(season: DataFrame) -> DataFrame:
    """Month of the highest index, the first one on ties."""
    return season.groupBy("airport").agg(F.max_by("month", F.struct("idx", -F.col("month"))).alias("peak_month"), F.max("idx").alias("peak"))


def concentration(routes: DataFrame, n: int = 50) -> DataFrame:
    """Share of traffic beyond the ``n`` largest undirected pairs, per complete year."""
    years = canonical.complete_years(routes, "p", 12)
    pairs = _year(routes).join(years, "year", "left_semi").groupBy("year", F.least("origin", "destination").alias("a"), F.greatest("origin", "destination").alias("b")).agg(canonical.sum0("passengers").alias("v"))
    placed = pairs.withColumn("place", F.row_number().over(Window.partitionBy("year").orderBy(F.desc("v"), "a", "b")))
    sums = placed.groupBy("year").agg(F.sum("v").alias("total"), F.sum(F.when(F.col("place") <= n, F.col("v"))).alias("trunk"), F.count(F.lit(1)).alias("n_pairs"))
    return sums.select("year", "n_pairs", "total", "trunk", F.round(1 - F.try_divide(F.col("trunk").cast("double"), F.col("total").cast("double")), 9).alias("beyond"))


def recent_periods(df: DataFrame, width: int) -> DataFrame:
    """One row (hi) with the last period if all of the latest ``width`` periods exist, else none."""
    last = df.agg(F.max("p").alias("hi"))
    near = df.select("p").join(F.broadcast(last), F.col("p") > F.col("hi") - width)
    return near.groupBy("hi").agg(F.countDistinct("p").alias("n")).where(F.col("n") == width).select("hi")


def hub_markets(routes: DataFrame, hub: str, n: int = 15, band: float = 0.01) -> DataFrame:
    """Largest partners of a hub in the latest twelve months against the twelve before; nothing unless all 24 exist."""
    own = routes.where((F.col("origin") == hub) | (F.col("destination") == hub)).withColumn("partner", F.when(F.col("origin") == hub, F.col("destination")).otherwise(F.col("origin")))
    rows = own.join(F.broadcast(recent_periods(routes, 24)), F.col("p") > F.col("hi") - 24)
    recent = F.col("p") > F.col("hi") - 12
    sums = rows.groupBy("partner").agg(F.coalesce(F.sum(F.when(recent, F.col("passengers"))), F.lit(0)).alias("latest"), F.coalesce(F.sum(F.when(~recent, F.col("passengers"))), F.lit(0)).alias("previous"))
    yoy = F.try_divide(F.col("latest").cast("double"), F.col("previous").cast("double")) - 1
    trend = F.when(yoy.isNull(), "new").when(yoy >= band, "up").when(yoy <= -band, "down").otherwise("flat")
    return sums.orderBy(F.desc("latest"), "partner").limit(n).select("partner", "latest", "previous", F.round(yoy, 9).alias("yoy"), trend.alias("trend"))


def ramp_series(monthly: DataFrame, months: int = 24) -> DataFrame:
    """First ``months`` calendar months of each airport, with nulls where nothing was published."""
    first = windows.first_seen(monthly.where("passengers IS NOT NULL"), "airport")
    spots = first.select("airport", "first_p", F.explode(F.sequence(F.col("first_p"), F.col("first_p") + (months - 1))).alias("p"))
    return spots.join(monthly.select("airport", "p", "passengers"), ["airport", "p"], "left").select("airport", (F.col("p") - F.col("first_p")).alias("month_index"), "passengers")


def two_entity_share(monthly: DataFrame, a: str, b: str) -> DataFrame:
    """Share of ``a`` in ``a`` plus ``b`` for months that both published, and its step against the month before."""
    two = monthly.where(F.col("airport").isin(a, b) & F.col("passengers").isNotNull()).groupBy("p").agg(F.sum(F.when(F.col("airport") == a, F.col("passengers"))).alias("a"), F.sum(F.when(F.col("airport") == b, F.col("passengers"))).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    share = two.withColumn("share", F.try_divide(F.col("a").cast("double"), (F.col("a") + F.col("b")).cast("double")))
    step = F.when(F.col("p") - F.lag("p").over(along()) == 1, F.col("share") - F.lag("share").over(along()))
    return share.select("p", "a", "b", F.round("share", 9).alias("share"), F.round(step, 9).alias("step"))


def relief(monthly: DataFrame, entrant: str, incumbent: str) -> DataFrame:
    """Since the entrant opened: both airports against the incumbent's same months a year earlier; only if all months exist."""
    start = monthly.where((F.col("airport") == entrant) & F.col("passengers").isNotNull()).agg(F.min("p").alias("lo"), F.max("p").alias("hi")).where("lo IS NOT NULL")
    rows = monthly.join(F.broadcast(start), F.lit(True))
    now, ago = F.col("p").between(F.col("lo"), F.col("hi")), F.col("p").between(F.col("lo") - 12, F.col("hi") - 12)
    own = lambda e, w: F.when((F.col("airport") == e) & w, F.col("passengers"))
    agg = rows.groupBy("lo", "hi").agg(
        F.sum(own(entrant, now)).alias("entrant"), F.sum(own(incumbent, now)).alias("incumbent"), F.sum(own(incumbent, ago)).alias("incumbent_before"),
        F.count(own(entrant, now)).alias("n1"), F.count(own(incumbent, now)).alias("n2"), F.count(own(incumbent, ago)).alias("n3"),
    )
    months = F.col("hi") - F.col("lo") + 1
    whole = agg.where((F.col("n1") == months) & (F.col("n2") == months) & (F.col("n3") == months))
    return whole.select(months.alias("months"), "entrant", "incumbent", "incumbent_before", F.round(F.try_divide(F.greatest(F.col("incumbent_before") - F.col("incumbent"), F.lit(0)).cast("double"), F.col("entrant").cast("double")), 9).alias("displaced"))


def breakouts(monthly: DataFrame, quiet: int = 12, factor: int = 4, recede: float = 0.6, observed: int = 24) -> DataFrame:
    """Airports that leave the ceiling of their first ``quiet`` observed months: first month at ``factor`` times it.

    At least ``observed`` months, two of them adjacent, and two quiet years before it are asked for.
    """
    known = monthly.where("passengers IS NOT NULL")
    w = Window.partitionBy("airport").orderBy("p")
    placed = known.withColumn("k", F.row_number().over(w)).withColumn("adjacent", F.col("p") - F.lag("p").over(w) == 1)
    ceiling = placed.groupBy("airport").agg(F.max(F.when(F.col("k") <= quiet, F.col("passengers"))).alias("ceiling"), F.count(F.lit(1)).alias("n"), F.min("p").alias("first_p"), F.max_by("passengers", "p").alias("latest"), F.max("adjacent").alias("near")).where((F.col("n") >= observed) & F.col("near"))
    out = placed.where(F.col("k") > quiet).join(ceiling.where("ceiling > 0"), "airport")
    broke = out.groupBy("airport", "ceiling", "first_p", "latest").agg(F.min(F.when(F.col("passengers") >= F.col("ceiling") * factor, F.col("p"))).alias("breakout_p"), F.max("passengers").alias("peak"))
    quiet_years = F.floor((F.col("breakout_p") - F.col("first_p")) / 12).cast("int")
    return broke.where("breakout_p IS NOT NULL").withColumn("quiet_years", quiet_years).where("quiet_years >= 2").select("airport", "ceiling", "breakout_p", "quiet_years", "peak", (F.col("latest") < F.col("peak") * recede).alias("receded"))


def white_space(routes: DataFrame, hub: str, least: int = 100_000, markets: int = 30) -> DataFrame:
    """Airports of some size in the latest twelve months that the hub does not serve.

    Nothing unless all twelve exist and the hub serves at least ``markets``: fewer mean missing rows, not white space.
    """
    recent = routes.join(F.broadcast(recent_periods(routes, 12)), F.col("p") > F.col("hi") - 12)
    ends = recent.select(F.explode(F.array("origin", "destination")).alias("airport"), "passengers").groupBy("airport").agg(F.sum("passengers").alias("volume")).where(F.col("volume") >= least)
    own = recent.where((F.col("origin") == hub) | (F.col("destination") == hub))
    partners = own.groupBy(F.when(F.col("origin") == hub, F.col("destination")).otherwise(F.col("origin")).alias("airport")).agg(F.sum("passengers").alias("n")).where("n > 0")
    enough = partners.agg(F.count(F.lit(1)).alias("n_markets")).where(F.col("n_markets") >= markets)
    return ends.where(F.col("airport") != hub).join(partners, "airport", "left_anti").join(F.broadcast(enough), F.lit(True)).select("airport", "volume")


def catchment(monthly: DataFrame, members: DataFrame, back: int = 36, recent: int = 12) -> DataFrame:
    """Trailing years of a group (``airport``) at its best covered recent month, and growth if the same members were there ``back`` months before."""
    own = monthly.join(members.select("airport").distinct(), "airport", "left_semi")
    t12 = windows.gap_honest_trailing(own, "airport", "passengers", 12).where("total IS NOT NULL")
    per = t12.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("total"), F.array_sort(F.collect_set("airport")).alias("who"))
    last = per.agg(F.max("p").alias("hi"))
    anchor = per.join(F.broadcast(last), F.col("p") > F.col("hi") - recent).agg(F.max_by(F.struct("p", "n", "total", "who"), F.struct("n", "p")).alias("x")).where("x IS NOT NULL").select("x.*")
    old = per.select((F.col("p") + back).alias("p"), F.col("total").alias("before"), F.col("who").alias("who_before"))
    return anchor.join(old, "p", "left").select("p", "n", "total", F.when(F.col("who") == F.col("who_before"), F.round(F.try_divide(F.col("total").cast("double"), F.col("before").cast("double")) - 1, 9)).alias("growth"))
