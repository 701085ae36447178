"""Queries over the engine's own operators, each next to the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flightloom.functions import keys, periods, text
from flightloom.operators import canonical, dashboard, focus, resolve, windows
from flightloom.plans.data_sql import AIRPORT, CARRIER, QUARTER, ROUTE
from flightloom.quality import checks, revisions
from flightloom.sources import links, manifest, sheets, sinks
from flightloom.sources.tables import CARRIER_METRICS, SPECS, airport_months, airport_quarters, carrier_months, read_table, route_months, rows_that_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Known to be published as zero: April 2020.
KNOWN_ZERO = [2020 * 12 + 3]
FACTORS = ("passenger_load_factor", "weight_load_factor")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- star schema as city pairs: labels that change their meaning ------------------------------

#: (label, canonical, lo, hi, seq): one label changes hands with a hole, one entity is renamed, two labels run side by side, five are unknown.
LABELS = [
    ("NATION_0", "AAA", None, 1997 * 12 + 11, 0), ("NATION_0", "BBB", 1998 * 12 + 6, None, 1),
    ("NATION_1", "CCC", None, 1998 * 12 + 11, 2), ("NATION_2", "CCC", 1999 * 12, None, 3),
    ("NATION_3", "DUO", None, None, 4), ("NATION_4", "DUO", None, None, 5),
    *((f"NATION_{k}", f"N{k:02d}", None, None, k + 1) for k in range(5, 20)),
]
_V = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
DIM = "dim(label, canonical, lo, hi, seq) AS (VALUES " + ", ".join("(" + ", ".join(map(_V, r)) + ")" for r in LABELS) + ")"
PAIRS = """pairs AS (SELECT CAST(year(l_shipdate) AS INTEGER) * 12 + CAST(month(l_shipdate) AS INTEGER) - 1 AS p, ns.n_name AS city1, nc.n_name AS city2,
  CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS to_pax, CASE WHEN l_returnflag = 'R' THEN l_quantity END AS from_pax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation nc ON c_nationkey = nc.n_nationkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ns ON s_nationkey = ns.n_nationkey)"""
_AT = "(SELECT canonical FROM dim WHERE dim.label = upper(trim({c})) AND (lo IS NULL OR {p} >= lo) AND (hi IS NULL OR {p} <= hi) ORDER BY seq LIMIT 1)"
RESOLVED = f"""{DIM}, {PAIRS}, keys AS (SELECT p, label, {_AT.format(c="k.label", p="k.p")} AS canonical FROM (SELECT DISTINCT p, city1 AS label FROM pairs UNION SELECT DISTINCT p, city2 FROM pairs) k),
res AS (SELECT x.*, k1.canonical AS a1, k2.canonical AS a2 FROM pairs x LEFT JOIN keys k1 ON k1.p = x.p AND k1.label = x.city1 LEFT JOIN keys k2 ON k2.p = x.p AND k2.label = x.city2)"""
SIDES = """sides AS (SELECT p, a1 AS airport, coalesce(to_pax, 0) AS dep, coalesce(from_pax, 0) AS arr FROM res UNION ALL SELECT p, a2, coalesce(from_pax, 0), coalesce(to_pax, 0) FROM res),
pm AS (SELECT p, airport, CAST(round_even(sum(dep), 0) AS BIGINT) + CAST(round_even(sum(arr), 0) AS BIGINT) AS passengers, CAST(round_even(sum(dep), 0) AS BIGINT) AS departures, CAST(round_even(sum(arr), 0) AS BIGINT) AS arrivals
  FROM sides WHERE airport IS NOT NULL GROUP BY p, airport)"""


def label_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LABELS, "label string, canonical string, lo int, hi int, seq int")


def city_pairs(spark: SparkSession, root: str) -> DataFrame:
    t = lambda n: read_table(spark, root, n)
    nation = t("nation")
    ship = t("lineitem").select("l_orderkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate")
    joined = (
        ship.join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation.select(F.col("n_nationkey").alias("nc"), F.col("n_name").alias("city2")), F.col("c_nationkey") == F.col("nc"))
        .join(nation.select(F.col("n_nationkey").alias("ns"), F.col("n_name").alias("city1")), F.col("s_nationkey") == F.col("ns"))
    )
    back = F.col("l_returnflag") == "R"
    return joined.select(
        (F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1).alias("p"), "city1", "city2",
        F.when(~back, F.col("l_quantity")).alias("to_pax"), F.when(back, F.col("l_quantity")).alias("from_pax"),
    )


def resolved_pairs(spark: SparkSession, root: str) -> DataFrame:
    """Pairs added up per month and label pair first: fewer rows are resolved than read."""
    total = city_pairs(spark, root).groupBy("p", "city1", "city2").agg(F.sum("to_pax").alias("to_pax"), F.sum("from_pax").alias("from_pax"), F.count(F.lit(1)).alias("n_rows"))
    return resolve.resolve_pairs(total, label_dim(spark))


@query(f"WITH {AIRPORT} SELECT airport, p, CAST(CASE WHEN count(passengers) OVER w = 12 THEN sum(passengers) OVER w END AS BIGINT) AS total FROM airport_m WINDOW w AS (PARTITION BY airport ORDER BY p RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)")
def slice_airport_t12(spark, root):
    return windows.gap_honest_trailing(airport_months(spark, root, ("passengers",)), "airport", "passengers", 12)


@query(f"WITH {RESOLVED}, {SIDES} SELECT airport, p, CAST(CASE WHEN count(passengers) OVER w = 12 THEN sum(passengers) OVER w END AS BIGINT) AS total FROM pm WINDOW w AS (PARTITION BY airport ORDER BY p RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)")
def slice_pairs_t12(spark, root):
    return windows.gap_honest_trailing(canonical.monthly_throughput(resolved_pairs(spark, root)), "airport", "passengers", 12)


@query(f"WITH {RESOLVED} SELECT p, label, canonical FROM keys")
def jon01_resolve(spark, root):
    pairs = city_pairs(spark, root)
    labels = pairs.select("p", F.explode(F.array("city1", "city2")).alias("label")).distinct()
    return resolve.resolve(labels, label_dim(spark), "label", "p").select("p", "label", "canonical")


@query("""WITH e AS (SELECT n_name AS canonical, n_name || ' CITY' AS city, 'Name ' || n_name AS name FROM nation),
v AS (SELECT upper(trim(regexp_replace(source_label, '\\s+', ' ', 'g'))) AS label, upper(trim(canonical)) AS canonical, lo, hi FROM entity_windows),
a AS (SELECT label, canonical, lo, hi FROM v UNION SELECT upper(city), canonical, NULL, NULL FROM e UNION SELECT upper(name), canonical, NULL, NULL FROM e)
SELECT DISTINCT label, canonical, lo, hi FROM a""")
def jon02_label_index(spark, root):
    own = read_table(spark, root, "entity_windows").select(F.upper(F.trim("canonical")).alias("canonical"), F.col("source_label").alias("label"), "lo", "hi", F.lit(0).alias("seq"))
    cities = read_table(spark, root, "nation").select(F.col("n_name").alias("canonical"), F.concat("n_name", F.lit(" CITY")).alias("city"), F.concat(F.lit("Name "), "n_name").alias("name"))
    none = cities.select(F.col("city").alias("label"), "canonical").where("false")
    return resolve.label_windows(cities, own, none).select("label", "canonical", "lo", "hi").distinct()


@query("""WITH w AS (SELECT DISTINCT upper(trim(regexp_replace(source_label, '\\s+', ' ', 'g'))) AS label, upper(trim(canonical)) AS canonical, coalesce(lo, -2147483647) AS lo, coalesce(hi, 2147483647) AS hi FROM entity_windows WHERE source_label IS NOT NULL)
SELECT a.label, a.canonical, b.canonical AS other, greatest(a.lo, b.lo) AS lo, least(a.hi, b.hi) AS hi FROM w a JOIN w b ON a.label = b.label AND a.canonical < b.canonical AND a.lo <= b.hi AND b.lo <= a.hi WHERE a.lo <= a.hi AND b.lo <= b.hi""")
def jon03_conflicts(spark, root):
    w = read_table(spark, root, "entity_windows").select(text.label_form("source_label").alias("label"), F.upper(F.trim("canonical")).alias("canonical"), "lo", "hi")
    return resolve.conflicts(w)


@query(f"WITH {RESOLVED} SELECT a1, a2, count(*) AS n, CAST(sum(coalesce(to_pax, 0)) AS BIGINT) AS to_pax, CAST(sum(coalesce(from_pax, 0)) AS BIGINT) AS from_pax FROM res GROUP BY a1, a2")
def jon04_pair_endpoints(spark, root):
    return resolved_pairs(spark, root).groupBy("a1", "a2").agg(F.sum("n_rows").alias("n"), canonical.sum0("to_pax").cast("bigint").alias("to_pax"), canonical.sum0("from_pax").cast("bigint").alias("from_pax"))


@query(f"""WITH {DIM}, o AS (SELECT DISTINCT n_name AS label, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT label, year, quarter, {_AT.format(c="o.label", p="(o.year * 12 + o.quarter * 3 - 2)")} AS canonical FROM o""")
def jon05_quarter_midpoint(spark, root):
    o = read_table(spark, root, "orders").join(read_table(spark, root, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(read_table(spark, root, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    q = o.select(F.col("n_name").alias("label"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter")).distinct().withColumn("p", resolve.quarter_month("year", "quarter"))
    return resolve.resolve(q, label_dim(spark), "label", "p").drop("p")


@query(f"WITH {DIM} SELECT n_name AS label, coalesce({_AT.format(c='n_name', p='24000')}, trim(n_name)) AS airline FROM nation")
def jon06_resolve_or_raw(spark, root):
    return resolve.resolve_or_raw(read_table(spark, root, "nation").select(F.col("n_name").alias("label")), label_dim(spark), "label", 24000, "airline")


@query(f"WITH {AIRPORT}, y AS (SELECT airport, p // 12 AS year, sum(passengers) AS annual FROM airport_m GROUP BY 1, 2) SELECT m.airport, m.p, m.passengers, CAST(y.annual AS BIGINT) AS annual FROM airport_m m LEFT JOIN y ON y.airport = m.airport AND y.year = m.p // 12")
def jon07_month_with_year(spark, root):
    m = airport_months(spark, root, ("passengers",))
    return m.select("airport", "p", "passengers", F.sum("passengers").over(Window.partitionBy("airport", periods.ordinal_year("p"))).alias("annual"))


def _versions(spark, root):
    """Two published versions of the airport layer: as of the last delivery but one, and as of the last."""
    raw = read_table(spark, root, "airport_monthly").select(keys.code("airport").alias("airport"), periods.month_ordinal("year", "month").alias("p"), "passengers", "departures", "arrivals", "load_no", "loaded_at")
    last = raw.agg(F.max("load_no").alias("last"))
    cut = raw.join(F.broadcast(last), F.col("load_no") < F.col("last"))
    values = ["passengers", "departures", "arrivals"]
    return rows_that_count(cut, ["airport", "p"], values), rows_that_count(raw, ["airport", "p"], values)


_OLD = AIRPORT.replace("airport_m AS", "old_m AS").replace("FROM airport_monthly WHERE", "FROM airport_monthly WHERE load_no < (SELECT max(load_no) FROM airport_monthly) AND")


@query(f"""WITH {AIRPORT}, {_OLD} SELECT coalesce(a.airport, b.airport) AS airport, coalesce(a.p, b.p) AS p, CASE WHEN a.p IS NULL THEN 'added' WHEN b.p IS NULL THEN 'removed' ELSE 'restated' END AS kind, a.passengers AS old_value, b.passengers AS new_value
FROM old_m a FULL JOIN airport_m b ON a.airport = b.airport AND a.p = b.p WHERE a.p IS NULL OR b.p IS NULL OR a.passengers IS DISTINCT FROM b.passengers""")
def dq20_revision_changes(spark, root):
    old, new = _versions(spark, root)
    return revisions.diff(old, new, ["airport", "p"], "passengers")


@query(f"WITH {AIRPORT}, {_OLD} SELECT count(*) FILTER (WHERE a.departures IS DISTINCT FROM b.departures OR a.arrivals IS DISTINCT FROM b.arrivals) AS drifted FROM old_m a JOIN airport_m b ON a.airport = b.airport AND a.p = b.p")
def dq21_column_drift(spark, root):
    old, new = _versions(spark, root)
    return revisions.drifted_rows(old, new, ["airport", "p"], ["departures", "arrivals"])


@query(f"""WITH {AIRPORT}, {_OLD}, s AS (SELECT p, sum(passengers) AS n FROM old_m GROUP BY p), t AS (SELECT p, sum(passengers) AS n FROM airport_m GROUP BY p)
SELECT p, CASE WHEN s.n IS NULL OR s.n = 0 THEN 'none' ELSE CASE WHEN t.n > s.n THEN 'up' WHEN t.n < s.n THEN 'down' ELSE 'same' END END AS direction FROM s JOIN t USING (p)""")
def dq24_revision_direction(spark, root):
    old, new = _versions(spark, root)
    s, t = old.groupBy("p").agg(F.sum("passengers").alias("a")), new.groupBy("p").agg(F.sum("passengers").alias("b"))
    j = s.join(t, "p").withColumn("text", revisions.percent_text("a", "b"))
    return j.select("p", F.when(F.col("text") == "-", "none").when(F.col("b") > F.col("a"), "up").when(F.col("b") < F.col("a"), "down").otherwise("same").alias("direction"))


# --- canonical tables -----------------------------------------------------------------------


@query(f"WITH {PAIRS}, s AS (SELECT p, city1 AS city, coalesce(to_pax, 0) AS dep, coalesce(from_pax, 0) AS arr FROM pairs UNION ALL SELECT p, city2, coalesce(from_pax, 0), coalesce(to_pax, 0) FROM pairs) SELECT p, city, CAST(sum(dep) AS BIGINT) AS dep, CAST(sum(arr) AS BIGINT) AS arr FROM s GROUP BY p, city")
def agg01_endpoint_split(spark, root):
    sides = canonical.endpoints(city_pairs(spark, root), "city1", "city2")
    return sides.groupBy("p", F.col("endpoint").alias("city")).agg(F.sum("dep").cast("bigint").alias("dep"), F.sum("arr").cast("bigint").alias("arr"))


@query(f"WITH {RESOLVED}, {SIDES} SELECT p, airport, passengers, departures, arrivals FROM pm")
def agg03_monthly_from_pairs(spark, root):
    return canonical.monthly_throughput(resolved_pairs(spark, root))


@query(f"""WITH {RESOLVED}, d AS (SELECT p, a1 AS origin, a2 AS destination, coalesce(to_pax, 0) AS n FROM res WHERE a1 <> a2 UNION ALL SELECT p, a2, a1, coalesce(from_pax, 0) FROM res WHERE a1 <> a2)
SELECT p, origin, destination, CAST(round_even(sum(n), 0) AS BIGINT) AS passengers FROM d GROUP BY p, origin, destination""")
def agg04_directed_routes(spark, root):
    return canonical.directed_routes(resolved_pairs(spark, root))


@query(f"""WITH {RESOLVED}, s AS (SELECT p // 3 AS q, a1 AS airport, coalesce(to_pax, 0) AS dep, coalesce(from_pax, 0) AS arr FROM res UNION ALL SELECT p // 3, a2, coalesce(from_pax, 0), coalesce(to_pax, 0) FROM res)
SELECT q, airport, CAST(sum(dep) + sum(arr) AS BIGINT) AS passengers, CAST(sum(dep) AS BIGINT) AS departures, CAST(sum(arr) AS BIGINT) AS arrivals FROM s WHERE airport IN ('AAA', 'BBB', 'DUO', 'N07') GROUP BY q, airport""")
def agg05_quarterly_known(spark, root):
    known = spark.createDataFrame([("AAA",), ("BBB",), ("DUO",), ("N07",)], "airport string")
    r = resolved_pairs(spark, root).withColumn("q", F.floor(F.col("p") / 3).cast("int")).drop("p")
    return canonical.quarterly_throughput(r, known)


@query(f"""WITH {AIRPORT}, {QUARTER}, ym AS (SELECT p // 12 AS year FROM airport_m GROUP BY 1 HAVING count(DISTINCT p) = 12), yq AS (SELECT q // 4 AS year FROM quarter_m GROUP BY 1 HAVING count(DISTINCT q) = 4)
SELECT p // 12 AS year, airport, CAST(coalesce(sum(passengers), 0) AS BIGINT) AS passengers, 'domestic' AS category FROM airport_m WHERE p // 12 IN (SELECT year FROM ym) GROUP BY 1, 2
UNION ALL SELECT q // 4, airport, CAST(coalesce(sum(passengers), 0) AS BIGINT), 'international' FROM quarter_m WHERE q // 4 IN (SELECT year FROM yq) GROUP BY 1, 2""")
def agg06_yearly(spark, root):
    return canonical.yearly(airport_months(spark, root, ("passengers",)), airport_quarters(spark, root))


_SUMS = ", ".join(f"CAST(coalesce(sum(CAST({m} AS DECIMAL(24, 3))), 0) AS DOUBLE) AS {m}" for m in CARRIER_METRICS if m not in FACTORS)

_MEANS = ", ".join(f"CAST(sum(CAST({m} AS DECIMAL(24, 6))) AS DOUBLE) / nullif(count({m}), 0) AS {m}" for m in FACTORS)


@query(f"WITH {CARRIER} SELECT airline, p // 12 AS year, CAST(sum(passengers) AS BIGINT) AS passengers, {_SUMS}, {_MEANS} FROM carrier_m GROUP BY 1, 2")
def agg07_carrier_tidy(spark, root):
    c = carrier_months(spark, root).withColumn("year", periods.ordinal_year("p"))
    return canonical.tidy_carriers(c, ["airline", "year"])


@query(f"""WITH {RESOLVED}, u AS (SELECT city1 AS label, coalesce(to_pax, 0) + coalesce(from_pax, 0) AS n FROM res WHERE a1 IS NULL UNION ALL SELECT city2, coalesce(to_pax, 0) + coalesce(from_pax, 0) FROM res WHERE a2 IS NULL)
SELECT coalesce(label, '(blank)') AS label, CAST(round_even(sum(n), 0) AS BIGINT) AS passengers FROM u GROUP BY 1 ORDER BY passengers DESC, label LIMIT 5""")
def agg08_unresolved(spark, root):
    return canonical.unresolved_volume(resolved_pairs(spark, root))


@query(f"WITH {CARRIER} SELECT p, CAST(coalesce(sum(passengers), 0) AS BIGINT) AS passengers FROM carrier_m WHERE service_type = 'scheduled_domestic' GROUP BY p")
def agg09_carried(spark, root):
    return dashboard.carried(carrier_months(spark, root, ("passengers",)))


@query(f"WITH {AIRPORT}, {QUARTER} SELECT 'month' AS grain, p AS ordinal, CAST(coalesce(sum(passengers), 0) AS BIGINT) AS passengers FROM airport_m GROUP BY p UNION ALL SELECT 'quarter', q, CAST(coalesce(sum(passengers), 0) AS BIGINT) FROM quarter_m GROUP BY q")
def agg10_throughput(spark, root):
    a = dashboard.throughput(airport_months(spark, root, ("passengers",))).select(F.lit("month").alias("grain"), F.col("p").alias("ordinal"), "passengers")
    b = dashboard.throughput(airport_quarters(spark, root), "q").select(F.lit("quarter").alias("grain"), F.col("q").alias("ordinal"), "passengers")
    return a.unionByName(b)


@query(f"WITH {QUARTER}, c AS (SELECT airport, q FROM (SELECT DISTINCT airport FROM quarter_m) a, (SELECT DISTINCT q FROM quarter_m) b) SELECT c.airport, c.q, CAST(coalesce(sum(passengers), 0) AS BIGINT) AS passengers FROM c LEFT JOIN quarter_m m ON m.airport = c.airport AND m.q = c.q GROUP BY c.airport, c.q")
def agg11_matrix(spark, root):
    return windows.matrix_trailing(airport_quarters(spark, root).withColumnRenamed("q", "p"), "airport", "passengers", 1).select("airport", F.col("p").alias("q"), F.col("total").alias("passengers"))


@query(f"WITH {AIRPORT}, f AS (SELECT airport FROM airport_m GROUP BY airport ORDER BY sum(passengers) DESC NULLS LAST, airport LIMIT 1) SELECT p, CAST(sum(passengers) AS BIGINT) AS passengers FROM airport_m WHERE airport IN (SELECT airport FROM f) GROUP BY p")
def agg12_entity_series(spark, root):
    m = airport_months(spark, root, ("passengers",))
    return m.where(F.col("airport") == largest_airport(m)).groupBy("p").agg(F.sum("passengers").alias("passengers"))


def largest_airport(monthly: DataFrame) -> str:
    row = monthly.groupBy("airport").agg(F.sum("passengers").alias("n")).orderBy(F.desc_nulls_last("n"), "airport").first()
    return row.airport if row else ""


def largest_hub(routes: DataFrame) -> str:
    row = routes.groupBy("origin").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "origin").first()
    return row.origin if row else ""


HUB = "hub AS (SELECT origin AS hub FROM route_m GROUP BY origin ORDER BY count(*) DESC, origin LIMIT 1)"
FOCUS = "focus AS (SELECT airport AS focus FROM airport_m GROUP BY airport ORDER BY sum(passengers) DESC NULLS LAST, airport LIMIT 1)"


@query(f"WITH {AIRPORT} SELECT airport, CAST(sum(passengers) AS BIGINT) AS passengers FROM airport_m GROUP BY airport ORDER BY passengers DESC NULLS LAST, airport LIMIT 10")
def agg13_top_entities(spark, root):
    return airport_months(spark, root, ("passengers",)).groupBy("airport").agg(F.sum("passengers").alias("passengers")).orderBy(F.desc_nulls_last("passengers"), "airport").limit(10)


@query(f"WITH {ROUTE} SELECT p // 12 AS year FROM route_m GROUP BY 1 HAVING count(DISTINCT p) = 12")
def agg14_complete_years(spark, root):
    return canonical.complete_years(route_months(spark, root), "p", 12)


@query(f"WITH {AIRPORT}, {ROUTE} SELECT (SELECT count(DISTINCT airport) FROM airport_m WHERE passengers > 0) AS active, (SELECT count(DISTINCT origin) FROM route_m) AS origins, (SELECT count(DISTINCT destination) FROM route_m) AS destinations")
def agg15_distinct_counts(spark, root):
    a = airport_months(spark, root, ("passengers",)).agg(F.countDistinct(F.when(F.col("passengers") > 0, F.col("airport"))).alias("active"))
    r = route_months(spark, root)
    return a.join(r.agg(F.countDistinct("origin").alias("origins")), F.lit(True)).join(r.agg(F.countDistinct("destination").alias("destinations")), F.lit(True))


@query(f"WITH {CARRIER} SELECT service_type, p // 12 AS year, median(passengers) AS median_passengers, CAST(count(*) AS BIGINT) AS n FROM carrier_m GROUP BY 1, 2")
def agg17_medians(spark, root):
    return carrier_months(spark, root, ("passengers",)).groupBy("service_type", periods.ordinal_year("p").alias("year")).agg(F.median("passengers").alias("median_passengers"), F.count(F.lit(1)).alias("n"))


@query(f"WITH {AIRPORT} SELECT airport, arg_max(p, passengers * 100000 - p) AS peak_p, max(passengers) AS peak, arg_min(p, passengers * 100000 + p) AS low_p FROM airport_m WHERE passengers IS NOT NULL GROUP BY airport")
def agg18_extremes(spark, root):
    m = airport_months(spark, root, ("passengers",)).where("passengers IS NOT NULL")
    return m.groupBy("airport").agg(F.max_by("p", F.struct("passengers", -F.col("p"))).alias("peak_p"), F.max("passengers").alias("peak"), F.min_by("p", F.struct("passengers", "p")).alias("low_p"))


@query(f"WITH {RESOLVED}, c AS (SELECT canonical, p, list_sort(list(DISTINCT label)) AS labels FROM keys WHERE canonical IS NOT NULL GROUP BY canonical, p) SELECT canonical, p, array_to_string(labels, '|') AS labels FROM c WHERE len(labels) > 1")
def agg19_label_sets(spark, root):
    return resolve.concurrent_labels(jon01_resolve(spark, root), "canonical", "p", "label").select("canonical", "p", F.array_join("labels", "|").alias("labels"))


@query(f"""WITH {RESOLVED}, u AS (SELECT k.label, x.p // 12 AS year, x.n FROM (SELECT p, city1 AS label, coalesce(to_pax, 0) + coalesce(from_pax, 0) AS n FROM pairs UNION ALL SELECT p, city2, coalesce(to_pax, 0) + coalesce(from_pax, 0) FROM pairs) x JOIN keys k ON k.p = x.p AND k.label = x.label WHERE k.canonical IS NULL)
SELECT label, count(DISTINCT year) AS years, CAST(sum(n) AS BIGINT) AS passengers, CAST(CAST(sum(n) AS BIGINT) AS DOUBLE) / greatest(count(DISTINCT year), 1) AS per_year FROM u GROUP BY label HAVING sum(n) / greatest(count(DISTINCT year), 1) >= 100""")
def dq11_unmapped_volume(spark, root):
    pairs = city_pairs(spark, root)
    sides = pairs.select("p", F.explode(F.array("city1", "city2")).alias("label"), (F.coalesce("to_pax", F.lit(0.0)) + F.coalesce("from_pax", F.lit(0.0))).alias("n")).withColumn("year", periods.ordinal_year("p"))
    return checks.unmapped_volume(resolve.resolve(sides, label_dim(spark), "label", "p"), "label", "canonical", "year", "n", 100)


@query(f"WITH {RESOLVED}, c AS (SELECT canonical, p, label FROM keys WHERE canonical IS NOT NULL) SELECT a.canonical, a.label AS label1, b.label AS label2, count(*) AS n_periods FROM c a JOIN c b ON a.canonical = b.canonical AND a.p = b.p AND a.label < b.label GROUP BY 1, 2, 3")
def jon16_co_occurrence(spark, root):
    return resolve.co_occurrence(jon01_resolve(spark, root), "canonical", "p", "label")


@query(f"WITH {RESOLVED}, c AS (SELECT canonical, p, list_sort(list(DISTINCT label)) AS labels FROM keys WHERE canonical IS NOT NULL GROUP BY canonical, p HAVING count(DISTINCT label) > 1) SELECT canonical, p, array_to_string(list_filter(labels, lambda x: x <> 'NATION_3'), '|') AS undeclared FROM c")
def dq10_undeclared_labels(spark, root):
    both = resolve.concurrent_labels(jon01_resolve(spark, root), "canonical", "p", "label")
    declared = spark.createDataFrame([("DUO", ["NATION_3"])], "canonical string, labels array<string>")
    return checks.undeclared_labels(both, declared, "canonical", "p").select("canonical", "p", F.array_join("undeclared", "|").alias("undeclared"))


# --- trailing windows -----------------------------------------------------------------------


@query(f"""WITH {AIRPORT}, d AS (SELECT DISTINCT p FROM airport_m), w AS (SELECT p FROM (SELECT p, count(*) OVER (ORDER BY p RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS n FROM d) WHERE n = 12), e AS (SELECT DISTINCT airport FROM airport_m),
c AS (SELECT e.airport, d.p, coalesce(m.passengers, 0) AS v FROM e CROSS JOIN d LEFT JOIN airport_m m ON m.airport = e.airport AND m.p = d.p),
t AS (SELECT airport, p, sum(v) OVER (PARTITION BY airport ORDER BY p RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS total FROM c) SELECT airport, p, CAST(total AS BIGINT) AS total FROM t WHERE p IN (SELECT p FROM w)""")
def win_a_matrix(spark, root):
    return windows.matrix_trailing(airport_months(spark, root, ("passengers",)), "airport", "passengers", 12)


_PULSE = f"""WITH {CARRIER}, s AS (SELECT p, coalesce(sum(passengers), 0) AS v FROM carrier_m WHERE service_type = 'scheduled_domestic' AND p <> {2021 * 12 + 2} GROUP BY p), c AS (SELECT CAST(unnest(generate_series(min(p), max(p))) AS INTEGER) AS p FROM s),
f AS (SELECT c.p, CASE WHEN s.v IS NULL AND c.p = {KNOWN_ZERO[0]} THEN 0 ELSE s.v END AS v FROM c LEFT JOIN s USING (p)),
t AS (SELECT p, v, CASE WHEN count(v) OVER w = 12 THEN sum(v) OVER w END AS total FROM f WINDOW w AS (ORDER BY p RANGE BETWEEN 11 PRECEDING AND CURRENT ROW))
SELECT p, CAST(v AS BIGINT) AS value, CAST(total AS BIGINT) AS total, CAST(v AS DOUBLE) / nullif(CAST(lag(v, 12) OVER (ORDER BY p) AS DOUBLE), 0) - 1 AS yoy, CAST(total AS DOUBLE) / nullif(CAST(lag(total, 12) OVER (ORDER BY p) AS DOUBLE), 0) - 1 AS total_yoy FROM t"""


@query(_PULSE)
def win_c_national(spark, root):
    s = dashboard.carried(carrier_months(spark, root, ("passengers",))).where(F.col("p") != 2021 * 12 + 2)
    return windows.national_trailing(s, "passengers", 12, KNOWN_ZERO)


@query(f"WITH {QUARTER}, s AS (SELECT q AS p, coalesce(sum(passengers), 0) AS v FROM quarter_m GROUP BY q) SELECT p, CAST(v AS BIGINT) AS value, CAST(CASE WHEN count(v) OVER w = 4 THEN sum(v) OVER w END AS BIGINT) AS total, CAST(lag(v, 4) OVER (ORDER BY p) AS BIGINT) AS before FROM s WINDOW w AS (ORDER BY p ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)")
def win_d_positional(spark, root):
    return windows.positional_trailing(dashboard.throughput(airport_quarters(spark, root), "q").withColumnRenamed("q", "p"), "passengers", 4)


@query(f"WITH {AIRPORT} SELECT airport, p, CASE WHEN p - lag(p) OVER w = 1 THEN passengers - lag(passengers) OVER w END AS step FROM airport_m WINDOW w AS (PARTITION BY airport ORDER BY p)")
def win_f_step(spark, root):
    return windows.step_change(airport_months(spark, root, ("passengers",)), "airport", "passengers")


@query(f"WITH {AIRPORT} SELECT airport, min(p) AS first_p FROM airport_m GROUP BY airport")
def win_g_first_seen(spark, root):
    return windows.first_seen(airport_months(spark, root, ("passengers",)), "airport")


@query(f"WITH {AIRPORT}, s AS (SELECT p, coalesce(sum(passengers), 0) AS v FROM airport_m GROUP BY p ORDER BY p DESC LIMIT 37) SELECT p, CAST(v AS DOUBLE) / first_value(v) OVER (ORDER BY p) * 100 AS idx FROM s")
def win_h_index(spark, root):
    return windows.index_to_base(dashboard.throughput(airport_months(spark, root, ("passengers",))), "passengers", 37)


@query(f"WITH {CARRIER} SELECT airline, CAST(sum(passengers) AS BIGINT) AS n, CAST(row_number() OVER (ORDER BY sum(passengers) DESC NULLS LAST, airline) AS INTEGER) AS rank FROM carrier_m GROUP BY airline")
def win_i_rank(spark, root):
    s = carrier_months(spark, root, ("passengers",)).groupBy("airline").agg(F.sum("passengers").alias("n"))
    return windows.ranked(s, [F.desc_nulls_last("n")], "airline")


@query("""WITH r AS (SELECT file, row_idx, CASE WHEN len(cells) <= 2 AND cells[1] <> '' THEN cells[1] END AS title, len(cells) AS n FROM sheet_rows)
SELECT file, row_idx, last_value(title IGNORE NULLS) OVER (PARTITION BY file ORDER BY row_idx ROWS UNBOUNDED PRECEDING) AS section, CAST(n AS INTEGER) AS n_cells FROM r""")
def win_j_fill_down(spark, root):
    r = read_table(spark, root, "sheet_rows")
    t = r.withColumn("title", F.when((F.size("cells") <= 2) & (F.get("cells", F.lit(0)) != ""), F.get("cells", F.lit(0))))
    return windows.fill_down(t, "file", "row_idx", "title", "section").select("file", "row_idx", "section", F.size("cells").alias("n_cells"))


@query(f"""WITH {ROUTE}, h AS (SELECT max(p) AS hi FROM route_m), w AS (SELECT CAST(unnest(generate_series(hi - 23, hi)) AS INTEGER) AS p, hi FROM h)
SELECT w.p, CASE WHEN w.p > hi - 12 THEN 'latest' ELSE 'previous' END AS side, w.p IN (SELECT p FROM route_m) AS present FROM w""")
def win_k_share_windows(spark, root):
    return windows.share_windows(route_months(spark, root), 12)


# --- filters, projections, sets, top-k -------------------------------------------------------


@query(f"WITH {CARRIER} SELECT airline, service_type, p, passengers FROM carrier_m WHERE service_type NOT IN ('scheduled_domestic') OR service_type IS NULL")
def flt02_not_in_keeps_null(spark, root):
    c = carrier_months(spark, root, ("passengers",))
    return c.where(~F.col("service_type").isin("scheduled_domestic") | F.col("service_type").isNull()).select("airline", "service_type", "p", "passengers")


@query(f"WITH {RESOLVED} SELECT count(*) FILTER (WHERE a1 IS NOT NULL AND a2 IS NOT NULL AND a1 <> a2) AS routable, count(*) FILTER (WHERE a1 IS NOT NULL OR a2 IS NOT NULL) AS attributable, count(*) AS n FROM res")
def flt04_routable(spark, root):
    r = resolved_pairs(spark, root)
    rows = lambda x: F.coalesce(F.sum(F.when(F.expr(x), F.col("n_rows"))), F.lit(0))
    return r.agg(rows("a1 IS NOT NULL AND a2 IS NOT NULL AND a1 <> a2").alias("routable"), rows("a1 IS NOT NULL OR a2 IS NOT NULL").alias("attributable"), rows("true").alias("n"))


@query(f"WITH {AIRPORT} SELECT airport, p, passengers, departures, arrivals FROM airport_m WHERE least(passengers, departures, arrivals) < 0")
def flt06_negative_rows(spark, root):
    return airport_months(spark, root).where(F.least("passengers", "departures", "arrivals") < 0)


@query(f"WITH {CARRIER} SELECT airline, service_type, p, passenger_load_factor FROM carrier_m WHERE passenger_load_factor NOT BETWEEN 0 AND 100")
def flt07_outside_range(spark, root):
    return carrier_months(spark, root).where(~F.col("passenger_load_factor").between(0, 100)).select("airline", "service_type", "p", "passenger_load_factor")


@query(f"WITH {ROUTE} SELECT least(origin, destination) AS a, greatest(origin, destination) AS b, CAST(sum(passengers) AS BIGINT) AS passengers FROM route_m GROUP BY 1, 2")
def prj04_undirected(spark, root):
    return route_months(spark, root).groupBy(F.least("origin", "destination").alias("a"), F.greatest("origin", "destination").alias("b")).agg(F.sum("passengers").alias("passengers"))


@query(f"WITH {AIRPORT}, {ROUTE} SELECT airport FROM (SELECT DISTINCT airport FROM airport_m) WHERE airport NOT IN (SELECT origin FROM route_m)")
def set3_airports_without_routes(spark, root):
    return airport_months(spark, root, ("passengers",)).select("airport").distinct().join(route_months(spark, root).select(F.col("origin").alias("airport")).distinct(), "airport", "left_anti")


@query(f"WITH {AIRPORT}, {CARRIER} SELECT DISTINCT p FROM airport_m INTERSECT SELECT DISTINCT p FROM carrier_m")
def set4_common_periods(spark, root):
    return airport_months(spark, root, ("passengers",)).select("p").intersect(carrier_months(spark, root, ("passengers",)).select("p"))


@query(f"WITH {AIRPORT}, {ROUTE} SELECT airport FROM airport_m UNION SELECT origin FROM route_m UNION SELECT destination FROM route_m")
def set5_all_codes(spark, root):
    r = route_months(spark, root)
    return airport_months(spark, root, ("passengers",)).select("airport").union(r.select("origin")).union(r.select("destination")).distinct()


@query("SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS involved FROM (SELECT count(*) AS n FROM airport_monthly GROUP BY year, month, airport)")
def set7_duplicates(spark, root):
    return checks.duplicate_counts(read_table(spark, root, "airport_monthly"), ["year", "month", "airport"])


_T12 = f"""{AIRPORT}, d AS (SELECT DISTINCT p FROM airport_m), e AS (SELECT DISTINCT airport FROM airport_m), cal AS (SELECT p FROM (SELECT p, count(*) OVER (ORDER BY p RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS n FROM d) WHERE n = 12),
cell AS (SELECT e.airport, d.p, coalesce(m.passengers, 0) AS v FROM e CROSS JOIN d LEFT JOIN airport_m m ON m.airport = e.airport AND m.p = d.p),
t12 AS (SELECT airport, p, CAST(total AS BIGINT) AS total FROM (SELECT airport, p, sum(v) OVER (PARTITION BY airport ORDER BY p RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS total FROM cell) WHERE p IN (SELECT p FROM cal))"""


@query(f"""WITH {_T12}, o AS (SELECT p, row_number() OVER (ORDER BY p DESC) AS back FROM cal), r AS (SELECT t12.airport, o.back, t12.total, row_number() OVER (PARTITION BY t12.p ORDER BY total DESC, airport) AS place FROM t12 JOIN o USING (p) WHERE back IN (1, 13)),
k AS (SELECT c.airport FROM (SELECT DISTINCT airport FROM r WHERE place <= 10) c JOIN (SELECT airport, total FROM r WHERE back = 1) n USING (airport) ORDER BY n.total DESC, c.airport LIMIT 12) SELECT airport, p, total FROM t12 WHERE airport IN (SELECT airport FROM k)""")
def ana02_trailing_leaders(spark, root):
    return dashboard.trailing_leaders(airport_months(spark, root, ("passengers",)))


@query(_PULSE.replace(f" AND p <> {2021 * 12 + 2}", ""))
def ana01_demand_pulse(spark, root):
    return dashboard.demand_pulse(carrier_months(spark, root, ("passengers",)), KNOWN_ZERO)


@query(f"""WITH {AIRPORT}, k AS (SELECT * FROM airport_m WHERE passengers IS NOT NULL), f AS (SELECT airport, min(p) AS first_p FROM k GROUP BY airport HAVING min(p) >= (SELECT min(p) + 12 FROM airport_m)),
r AS (SELECT k.airport, k.p - f.first_p AS month_index, k.passengers, sum(k.passengers) OVER w AS cumulative, max(k.passengers) OVER w AS peak, count(*) OVER w AS n FROM k JOIN f USING (airport) WHERE k.p < f.first_p + 24 WINDOW w AS (PARTITION BY k.airport))
SELECT airport, month_index, passengers, CAST(cumulative AS BIGINT) AS cumulative, peak FROM r WHERE n >= 3 AND (cumulative >= 100000 OR peak >= 20000)""")
def ana03_newcomer_ramps(spark, root):
    return dashboard.newcomer_ramps(airport_months(spark, root, ("passengers",)))


def _movers(cte: str, source: str, entity: str, ordinal: str, width: int, least: int, n: int) -> str:
    return f"""WITH {cte}, h AS (SELECT max({ordinal}) AS hi FROM {source}),
s AS (SELECT {entity} AS e, coalesce(sum(passengers) FILTER (WHERE {ordinal} > hi - {width}), 0) AS latest, coalesce(sum(passengers) FILTER (WHERE {ordinal} <= hi - {width}), 0) AS previous FROM {source}, h WHERE {ordinal} > hi - {2 * width} GROUP BY {entity}),
m AS (SELECT e, latest, previous, 100 * (CAST(latest AS DOUBLE) / nullif(CAST((SELECT sum(latest) FROM s) AS DOUBLE), 0)) - 100 * (CAST(previous AS DOUBLE) / nullif(CAST((SELECT sum(previous) FROM s) AS DOUBLE), 0)) AS delta FROM s WHERE (latest >= {least} OR previous >= {least}) AND (SELECT count(DISTINCT {ordinal}) FROM {source}, h WHERE {ordinal} > hi - {2 * width}) = {2 * width}),
r AS (SELECT *, row_number() OVER (ORDER BY delta DESC NULLS LAST, e) AS up, row_number() OVER (ORDER BY delta, e) AS down FROM m)
SELECT e AS {entity}, CAST(latest AS BIGINT) AS latest, CAST(previous AS BIGINT) AS previous, round(delta, 9) AS delta_pp, CASE WHEN down <= {n} THEN 'loser' ELSE 'gainer' END AS side FROM r WHERE up <= {n} OR down <= {n}"""


@query(_movers(AIRPORT, "airport_m", "airport", "p", 12, 100_000, 10))
def ana04_share_movers(spark, root):
    return dashboard.share_movers(airport_months(spark, root, ("passengers",)), "airport", "p", 12, 100_000, 10)


@query(_movers(QUARTER, "quarter_m", "airport", "q", 4, 50_000, 8))
def ana05_gateway_movers(spark, root):
    return dashboard.share_movers(airport_quarters(spark, root), "airport", "q", 4, 50_000, 8)


@query(f"""WITH {_T12}, y AS (SELECT p // 12 AS year FROM airport_m GROUP BY 1 HAVING count(DISTINCT p) = 12), k AS (SELECT airport FROM t12 GROUP BY airport HAVING arg_max(total, p) >= 100000),
r AS (SELECT airport, p // 12 AS year, p % 12 + 1 AS month, passengers FROM airport_m WHERE p // 12 IN (SELECT year FROM y)), n AS (SELECT airport FROM r GROUP BY airport HAVING count(DISTINCT year) >= 3),
q60 AS (SELECT airport FROM t12 WHERE airport IN (SELECT airport FROM n) AND airport IN (SELECT airport FROM k) GROUP BY airport ORDER BY arg_max(total, p) DESC, airport LIMIT 60),
i AS (SELECT airport, month, CAST(passengers AS DOUBLE) * 12 / nullif(CAST(sum(passengers) OVER (PARTITION BY airport, year) AS DOUBLE), 0) * 100 AS idx FROM r WHERE airport IN (SELECT airport FROM q60))
SELECT airport, CAST(month AS INTEGER) AS month, round(avg(idx), 6) AS idx FROM i GROUP BY airport, month""")
def ana07_seasonality(spark, root):
    return dashboard.seasonality(airport_months(spark, root, ("passengers",)))


@query(f"""WITH {AIRPORT}, {QUARTER}, {CARRIER}, s AS (SELECT p, coalesce(sum(passengers), 0) AS v FROM carrier_m WHERE service_type = 'scheduled_domestic' GROUP BY p), c AS (SELECT CAST(unnest(generate_series(min(p), max(p))) AS INTEGER) AS p FROM s),
f AS (SELECT c.p, CASE WHEN s.v IS NULL AND c.p = {KNOWN_ZERO[0]} THEN 0 ELSE s.v END AS v FROM c LEFT JOIN s USING (p)),
t AS (SELECT p, v, CASE WHEN count(v) OVER w = 12 THEN sum(v) OVER w END AS total FROM f WINDOW w AS (ORDER BY p RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)), l AS (SELECT * FROM t WHERE v IS NOT NULL ORDER BY p DESC LIMIT 1),
a AS (SELECT p, coalesce(sum(passengers), 0) AS n, count(DISTINCT airport) FILTER (WHERE passengers > 0) AS active FROM airport_m GROUP BY p ORDER BY p DESC LIMIT 1),
g AS (SELECT q, CASE WHEN count(*) OVER w = 4 THEN sum(v) OVER w END AS t4 FROM (SELECT q, coalesce(sum(passengers), 0) AS v FROM quarter_m GROUP BY q) WINDOW w AS (ORDER BY q ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) ORDER BY q DESC LIMIT 1)
SELECT l.p AS latest_p, CAST(l.v AS BIGINT) AS carried, CAST(l.total AS BIGINT) AS carried_t12, CAST(CASE WHEN l.p = a.p THEN a.n END AS BIGINT) AS throughput, CASE WHEN l.p = a.p THEN a.active END AS active_airports, g.q AS latest_q, CAST(g.t4 AS BIGINT) AS gateway_t4 FROM l, a, g""")
def ana08_kpis(spark, root):
    return dashboard.kpis(airport_months(spark, root, ("passengers",)), airport_quarters(spark, root), carrier_months(spark, root, ("passengers",)), KNOWN_ZERO)


@query(f"WITH {_T12}, r AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY total DESC, airport) AS place, airport, total, sum(total) OVER (PARTITION BY p) AS everyone FROM t12) SELECT p, CAST(place AS INTEGER) AS place, airport, total, CAST(everyone AS BIGINT) AS everyone FROM r WHERE place <= 10")
def ana09_race(spark, root):
    return dashboard.race(airport_months(spark, root, ("passengers",)))


@query(f"WITH {AIRPORT}, {QUARTER}, x AS (SELECT min(p) AS a, max(p) AS b FROM airport_m), y AS (SELECT min(q) AS a, max(q) AS b FROM quarter_m) SELECT 'month' AS layer, strftime(make_date(a // 12, a % 12 + 1, 1), '%b %Y') || '..' || strftime(make_date(b // 12, b % 12 + 1, 1), '%b %Y') AS coverage FROM x UNION ALL SELECT 'quarter', (a // 4) || 'Q' || (a % 4 + 1) || '..' || (b // 4) || 'Q' || (b % 4 + 1) FROM y")
def ana10_coverage(spark, root):
    a = airport_months(spark, root, ("passengers",)).agg(F.min("p").alias("a"), F.max("p").alias("b")).select(F.lit("month").alias("layer"), F.concat(periods.month_label("a"), F.lit(".."), periods.month_label("b")).alias("coverage"))
    b = airport_quarters(spark, root).agg(F.min("q").alias("a"), F.max("q").alias("b")).select(F.lit("quarter").alias("layer"), F.concat(periods.quarter_label("a"), F.lit(".."), periods.quarter_label("b")).alias("coverage"))
    return a.unionByName(b)


# --- single entities, groups, markets ---------------------------------------------------------


@query(f"""WITH {CARRIER}, s AS (SELECT p, coalesce(sum(passengers), 0) AS v FROM carrier_m WHERE service_type = 'scheduled_domestic' GROUP BY p), c AS (SELECT CAST(unnest(generate_series(min(p), max(p))) AS INTEGER) AS p FROM s),
f AS (SELECT c.p, CASE WHEN s.v IS NULL AND c.p = {KNOWN_ZERO[0]} THEN 0 ELSE s.v END AS v FROM c LEFT JOIN s USING (p)),
t AS (SELECT p, CASE WHEN count(v) OVER w = 12 THEN sum(v) OVER w END AS total FROM f WINDOW w AS (ORDER BY p RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)), k AS (SELECT * FROM t WHERE total IS NOT NULL),
h AS (SELECT max(p) AS hi, CAST(least(10, (count(*) - 1) // 12) AS INTEGER) AS years FROM k), x AS (SELECT h.*, a.total AS latest, b.total AS year_ago, d.total AS base FROM h LEFT JOIN k a ON a.p = hi LEFT JOIN k b ON b.p = hi - 12 LEFT JOIN k d ON d.p = hi - 12 * years WHERE years >= 1)
SELECT hi, years, CAST(latest AS BIGINT) AS latest, CAST(year_ago AS BIGINT) AS year_ago, CAST(base AS BIGINT) AS base, round(CAST(latest AS DOUBLE) / nullif(CAST(year_ago AS DOUBLE), 0) - 1, 6) AS yoy, round(pow(CAST(latest AS DOUBLE) / nullif(CAST(base AS DOUBLE), 0), 1.0 / years) - 1, 6) AS rate FROM x""")
def noi01_growth_rate(spark, root):
    return focus.growth_rate(dashboard.demand_pulse(carrier_months(spark, root, ("passengers",)), KNOWN_ZERO), "total")


@query(f"""WITH {CARRIER}, m AS (SELECT p, sum(passengers) AS passengers, sum(CAST(seat_km AS DECIMAL(24, 3))) AS seat_km, sum(CAST(passenger_km AS DECIMAL(24, 3))) AS passenger_km FROM carrier_m WHERE service_type = 'scheduled_domestic' GROUP BY p),
t AS (SELECT p, CAST(CASE WHEN count(passengers) OVER w = 12 THEN sum(passengers) OVER w END AS DOUBLE) AS a, CAST(CASE WHEN count(seat_km) OVER w = 12 THEN sum(seat_km) OVER w END AS DOUBLE) AS s, CAST(CASE WHEN count(passenger_km) OVER w = 12 THEN sum(passenger_km) OVER w END AS DOUBLE) AS k FROM m WINDOW w AS (ORDER BY p RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)),
l AS (SELECT * FROM t WHERE a IS NOT NULL AND s IS NOT NULL AND k IS NOT NULL ORDER BY p DESC LIMIT 37)
SELECT p, round(s / first_value(s) OVER o * 100, 6) AS idx_seat_km, round(k / first_value(k) OVER o * 100, 6) AS idx_passenger_km, round(a / first_value(a) OVER o * 100, 6) AS idx_passengers, round(k / nullif(s, 0) * 100, 6) AS load_factor FROM l WINDOW o AS (ORDER BY p)""")
def noi02_supply_demand(spark, root):
    return focus.supply_demand(carrier_months(spark, root))


@query(f"""WITH {CARRIER}, y AS (SELECT p // 12 AS year FROM carrier_m GROUP BY 1 HAVING count(DISTINCT p) = 12), r AS (SELECT p // 12 AS year, CASE lower(substr(airline, 1, 1)) WHEN 'a' THEN 'first' WHEN 'b' THEN 'first' WHEN 'c' THEN 'second' ELSE 'other' END AS grp, passengers FROM carrier_m WHERE p // 12 IN (SELECT year FROM y)),
s AS (SELECT year, grp, coalesce(sum(passengers), 0) AS n FROM r GROUP BY 1, 2) SELECT year, grp, CAST(n AS BIGINT) AS passengers, round(CAST(n AS DOUBLE) / nullif(CAST(sum(n) OVER (PARTITION BY year) AS DOUBLE), 0), 9) AS share FROM s""")
def noi03_group_shares(spark, root):
    c = carrier_months(spark, root, ("passengers",))
    initial = F.lower(F.substring("airline", 1, 1))
    members = c.select("airline").distinct().select(F.upper("airline").alias("airline"), F.when(initial.isin("a", "b"), "first").when(initial == "c", "second").alias("grp")).where("grp IS NOT NULL")
    return focus.group_shares(c, "airline", members, canonical.complete_years(c, "p", 12))


@query(f"""WITH {_T12}, {FOCUS}, s AS (SELECT p, sum(total) FILTER (WHERE airport = focus) AS f, sum(total) FILTER (WHERE airport <> focus) AS r FROM t12, focus GROUP BY p), l AS (SELECT * FROM s WHERE f > 0 AND r > 0 ORDER BY p DESC LIMIT 61)
SELECT p, CAST(f AS BIGINT) AS focus, CAST(r AS BIGINT) AS rest, round(CAST(f AS DOUBLE) / CAST(first_value(f) OVER o AS DOUBLE) * 100, 6) AS idx_focus, round(CAST(r AS DOUBLE) / CAST(first_value(r) OVER o AS DOUBLE) * 100, 6) AS idx_rest FROM l WINDOW o AS (ORDER BY p)""")
def noi06_focus_vs_rest(spark, root):
    m = airport_months(spark, root, ("passengers",))
    return focus.focus_vs_rest(m, largest_airport(m))


@query(f"""WITH {QUARTER}, fo AS (SELECT airport AS focus FROM quarter_m GROUP BY airport ORDER BY sum(passengers) DESC NULLS LAST, airport LIMIT 1), d AS (SELECT DISTINCT q FROM quarter_m), e AS (SELECT DISTINCT airport FROM quarter_m), cal AS (SELECT q FROM (SELECT q, count(*) OVER (ORDER BY q RANGE BETWEEN 3 PRECEDING AND CURRENT ROW) AS n FROM d) WHERE n = 4),
c AS (SELECT e.airport, d.q, coalesce(m.passengers, 0) AS v FROM e CROSS JOIN d LEFT JOIN quarter_m m ON m.airport = e.airport AND m.q = d.q), t AS (SELECT airport, q, sum(v) OVER (PARTITION BY airport ORDER BY q RANGE BETWEEN 3 PRECEDING AND CURRENT ROW) AS total FROM c),
s AS (SELECT q AS p, sum(total) FILTER (WHERE airport = focus) AS own, sum(total) AS everyone, max(total) AS top FROM t, fo WHERE q IN (SELECT q FROM cal) GROUP BY q), w AS (SELECT t.q AS p, max(airport) AS name FROM t JOIN s ON s.p = t.q AND s.top = t.total GROUP BY t.q)
SELECT p, CAST(own AS BIGINT) AS own, CAST(everyone AS BIGINT) AS "all", round(CAST(own AS DOUBLE) / nullif(CAST(everyone AS DOUBLE), 0), 9) AS share, w.name = (SELECT focus FROM fo) AS is_largest FROM s JOIN w USING (p)""")
def noi07_gateway_share(spark, root):
    q = airport_quarters(spark, root)
    return focus.gateway_share(q, largest_airport(q))


_SEASON = f"""WITH {AIRPORT}, r AS (SELECT airport, p // 12 AS year, p % 12 + 1 AS month, passengers, count(*) OVER w AS n, sum(passengers) OVER w AS annual FROM airport_m WHERE passengers IS NOT NULL WINDOW w AS (PARTITION BY airport, p // 12)),
s AS (SELECT airport, CAST(month AS INTEGER) AS month, round(median(CAST(passengers AS DOUBLE) * 1200 / CAST(annual AS DOUBLE)), 6) AS idx, count(*) AS years FROM r WHERE n = 12 AND annual > 0 GROUP BY airport, month)"""


@query(f"{_SEASON} SELECT airport, month, idx, years FROM s")
def noi08_median_season(spark, root):
    return focus.median_season(airport_months(spark, root, ("passengers",)))


@query(f"{_SEASON} SELECT airport, first(month ORDER BY idx DESC, month) AS peak_month, max(idx) AS peak FROM s GROUP BY airport")
def noi08_peak_month(spark, root):
    return focus.peak_month(focus.median_season(airport_months(spark, root, ("passengers",))))


_CATCH = ["A", "B", "C", "D"]


@query(f"""WITH {AIRPORT}, t AS (SELECT airport, p, CASE WHEN count(passengers) OVER w = 12 THEN sum(passengers) OVER w END AS total FROM airport_m WHERE substr(airport, 1, 1) IN ('A', 'B', 'C', 'D') WINDOW w AS (PARTITION BY airport ORDER BY p RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)),
x AS (SELECT p, count(*) AS n, sum(total) AS total, string_agg(airport, ',' ORDER BY airport) AS who FROM t WHERE total IS NOT NULL GROUP BY p), a AS (SELECT * FROM x WHERE p > (SELECT max(p) - 12 FROM x) ORDER BY n DESC, p DESC LIMIT 1)
SELECT a.p, a.n, CAST(a.total AS BIGINT) AS total, CASE WHEN a.who = b.who THEN round(CAST(a.total AS DOUBLE) / nullif(CAST(b.total AS DOUBLE), 0) - 1, 9) END AS growth FROM a LEFT JOIN x b ON b.p = a.p - 36""")
def noi09_catchment(spark, root):
    m = airport_months(spark, root, ("passengers",))
    return focus.catchment(m, m.select("airport").where(F.substring("airport", 1, 1).isin(_CATCH)))


@query(f"""WITH {ROUTE}, y AS (SELECT p // 12 AS year FROM route_m GROUP BY 1 HAVING count(DISTINCT p) = 12), s AS (SELECT p // 12 AS year, least(origin, destination) AS a, greatest(origin, destination) AS b, coalesce(sum(passengers), 0) AS v FROM route_m WHERE p // 12 IN (SELECT year FROM y) GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY v DESC, a, b) AS place FROM s), g AS (SELECT year, count(*) AS n_pairs, sum(v) AS total, sum(v) FILTER (WHERE place <= 50) AS trunk FROM r GROUP BY year)
SELECT year, n_pairs, CAST(total AS BIGINT) AS total, CAST(trunk AS BIGINT) AS trunk, round(1 - CAST(trunk AS DOUBLE) / nullif(CAST(total AS DOUBLE), 0), 9) AS beyond FROM g""")
def noi10_concentration(spark, root):
    return focus.concentration(route_months(spark, root))


@query(f"""WITH {ROUTE}, {HUB}, h AS (SELECT max(p) AS hi FROM route_m), s AS (SELECT CASE WHEN origin = hub THEN destination ELSE origin END AS partner, coalesce(sum(passengers) FILTER (WHERE p > hi - 12), 0) AS latest, coalesce(sum(passengers) FILTER (WHERE p <= hi - 12), 0) AS previous FROM route_m, hub, h WHERE (origin = hub OR destination = hub) AND p > hi - 24 AND (SELECT count(DISTINCT p) FROM route_m, h WHERE p > hi - 24) = 24 GROUP BY 1),
x AS (SELECT partner, latest, previous, CAST(latest AS DOUBLE) / nullif(CAST(previous AS DOUBLE), 0) - 1 AS yoy FROM s ORDER BY latest DESC, partner LIMIT 15)
SELECT partner, CAST(latest AS BIGINT) AS latest, CAST(previous AS BIGINT) AS previous, round(yoy, 9) AS yoy, CASE WHEN yoy IS NULL THEN 'new' WHEN yoy >= 0.01 THEN 'up' WHEN yoy <= -0.01 THEN 'down' ELSE 'flat' END AS trend FROM x""")
def noi11_hub_markets(spark, root):
    r = route_months(spark, root)
    return focus.hub_markets(r, largest_hub(r))


@query(f"WITH {AIRPORT}, f AS (SELECT airport, min(p) AS first_p FROM airport_m WHERE passengers IS NOT NULL GROUP BY airport), s AS (SELECT airport, first_p, CAST(unnest(generate_series(first_p, first_p + 23)) AS INTEGER) AS p FROM f) SELECT s.airport, s.p - first_p AS month_index, m.passengers FROM s LEFT JOIN airport_m m ON m.airport = s.airport AND m.p = s.p")
def noi12_ramp_series(spark, root):
    return focus.ramp_series(airport_months(spark, root, ("passengers",)))


_TWO = "two AS (SELECT min(airport) FILTER (WHERE k = 1) AS x, min(airport) FILTER (WHERE k = 2) AS y FROM (SELECT airport, row_number() OVER (ORDER BY sum(passengers) DESC NULLS LAST, airport) AS k FROM airport_m GROUP BY airport))"


def two_largest(m: DataFrame) -> list[str]:
    return [r.airport for r in m.groupBy("airport").agg(F.sum("passengers").alias("n")).orderBy(F.desc_nulls_last("n"), "airport").limit(2).collect()]


@query(f"""WITH {AIRPORT}, {_TWO}, s AS (SELECT p, sum(passengers) FILTER (WHERE airport = x) AS a, sum(passengers) FILTER (WHERE airport = y) AS b FROM airport_m, two WHERE passengers IS NOT NULL GROUP BY p), k AS (SELECT p, a, b, CAST(a AS DOUBLE) / nullif(CAST(a + b AS DOUBLE), 0) AS share FROM s WHERE a IS NOT NULL AND b IS NOT NULL)
SELECT p, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b, round(share, 9) AS share, round(CASE WHEN p - lag(p) OVER o = 1 THEN share - lag(share) OVER o END, 9) AS step FROM k WINDOW o AS (ORDER BY p)""")
def noi13_two_entity_share(spark, root):
    m = airport_months(spark, root, ("passengers",))
    return focus.two_entity_share(m, *two_largest(m))


@query(f"""WITH {AIRPORT}, k AS (SELECT airport, p, passengers, row_number() OVER w AS k, p - lag(p) OVER w = 1 AS adj FROM airport_m WHERE passengers IS NOT NULL WINDOW w AS (PARTITION BY airport ORDER BY p)),
c AS (SELECT airport, max(passengers) FILTER (WHERE k <= 12) AS ceiling, count(*) AS n, min(p) AS first_p, arg_max(passengers, p) AS latest FROM k GROUP BY airport HAVING count(*) >= 24 AND bool_or(adj)),
b AS (SELECT c.*, min(k.p) FILTER (WHERE k.passengers >= c.ceiling * 4) AS breakout_p, max(k.passengers) AS peak FROM c JOIN k USING (airport) WHERE k.k > 12 AND c.ceiling > 0 GROUP BY ALL)
SELECT airport, ceiling, breakout_p, CAST((breakout_p - first_p) // 12 AS INTEGER) AS quiet_years, peak, latest < peak * CAST(0.6 AS DOUBLE) AS receded FROM b WHERE breakout_p IS NOT NULL AND (breakout_p - first_p) // 12 >= 2""")
def noi15_breakouts(spark, root):
    return focus.breakouts(airport_months(spark, root, ("passengers",)))


@query(f"""WITH {ROUTE}, {HUB}, r AS (SELECT route_m.*, hub FROM route_m, hub WHERE p > (SELECT max(p) - 12 FROM route_m)), e AS (SELECT airport, sum(n) AS volume FROM (SELECT origin AS airport, passengers AS n FROM r UNION ALL SELECT destination, passengers FROM r) GROUP BY airport HAVING sum(n) >= 100000),
s AS (SELECT CASE WHEN origin = hub THEN destination ELSE origin END AS airport FROM r WHERE origin = hub OR destination = hub GROUP BY 1 HAVING sum(passengers) > 0) SELECT airport, CAST(volume AS BIGINT) AS volume FROM e WHERE airport NOT IN (SELECT airport FROM s) AND airport <> (SELECT hub FROM hub) AND (SELECT count(*) FROM s) >= 30 AND (SELECT count(DISTINCT p) FROM r) = 12""")
def noi16_white_space(spark, root):
    r = route_months(spark, root)
    return focus.white_space(r, largest_hub(r))


# --- data quality ---------------------------------------------------------------------------


@query(f"""SELECT 'cadence.layer1_unique' AS "check", CASE WHEN sum(n - 1) > 0 THEN 'fail' ELSE 'pass' END AS status, 'BLOCKING' AS severity FROM (SELECT count(*) AS n FROM airport_monthly GROUP BY year, month, airport)
UNION ALL SELECT 'cadence.layer1_no_quarter', 'pass', 'BLOCKING'
UNION ALL SELECT 'cadence.layer2_unique', CASE WHEN sum(n - 1) > 0 THEN 'fail' ELSE 'pass' END, 'BLOCKING' FROM (SELECT count(*) AS n FROM airport_international_quarterly GROUP BY year, quarter, airport)
UNION ALL SELECT 'cadence.layer2_quarter_domain', CASE WHEN count(*) FILTER (WHERE quarter IS NULL OR quarter NOT BETWEEN 1 AND 4) > 0 THEN 'fail' ELSE 'pass' END, 'BLOCKING' FROM airport_international_quarterly""")
def dq01_cadence(spark, root):
    return checks.cadence(read_table(spark, root, "airport_monthly"), read_table(spark, root, "airport_international_quarterly")).drop("message")


@query(f"""WITH {AIRPORT}, a AS (SELECT count(*) FILTER (WHERE passengers IS DISTINCT FROM departures + arrivals) AS off, count(*) FILTER (WHERE least(passengers, departures, arrivals) < 0) AS neg FROM airport_m)
SELECT 'definitional.sum.airport_monthly' AS "check", CASE WHEN off > 0 THEN 'fail' ELSE 'pass' END AS status, 'BLOCKING' AS severity, CASE WHEN off > 0 THEN off || ' rows do not add up' ELSE 'ok' END AS message FROM a
UNION ALL SELECT 'definitional.nonneg.airport_monthly', CASE WHEN neg > 0 THEN 'fail' ELSE 'pass' END, 'BLOCKING', CASE WHEN neg > 0 THEN neg || ' rows are negative' ELSE 'ok' END FROM a
UNION ALL SELECT 'definitional.int.airport_monthly', 'pass', 'BLOCKING', 'ok' FROM a""")
def dq02_definitional(spark, root):
    return checks.definitional(airport_months(spark, root), "airport_monthly")


@query("""SELECT * FROM (VALUES ('schema.airport_monthly.present', 'pass'), ('schema.airport_monthly.columns', 'fail'), ('schema.airport_monthly.dtypes', 'pass'), ('schema.carrier_monthly.present', 'pass'), ('schema.carrier_monthly.columns', 'fail'), ('schema.carrier_monthly.dtypes', 'pass'),
('schema.airport_international_quarterly.present', 'pass'), ('schema.airport_international_quarterly.columns', 'fail'), ('schema.airport_international_quarterly.dtypes', 'pass'), ('schema.domestic_route_monthly.present', 'pass'), ('schema.domestic_route_monthly.columns', 'fail'), ('schema.domestic_route_monthly.dtypes', 'pass'), ('schema.airport_yearly.present', 'fail')) t("check", status)""")
def dq03_schema(spark, root):
    tables = {n: read_table(spark, root, n) for n in SPECS if n != "airport_yearly"}
    return checks.schema_findings(spark, tables).select("check", "status")


@query(f"WITH {AIRPORT}, s AS (SELECT p, sum(departures) AS departures, sum(arrivals) AS arrivals FROM airport_m GROUP BY p) SELECT p, CAST(departures AS BIGINT) AS departures, CAST(arrivals AS BIGINT) AS arrivals FROM s WHERE departures <> arrivals")
def dq04_conservation(spark, root):
    return checks.conservation(airport_months(spark, root))


_FINE = ", ".join(f"count(*) FILTER (WHERE round({m}, 3) <> {m}) AS fine_{m}" for m in CARRIER_METRICS)
_OUT = ", ".join(f"count(*) FILTER (WHERE {f} NOT BETWEEN 0 AND 100) AS out_{f}" for f in FACTORS)
_NEG = ", ".join(m for m in CARRIER_METRICS if m not in FACTORS)

_ANY = " + ".join([*(f"out_{f}" for f in FACTORS), *(f"fine_{m}" for m in CARRIER_METRICS), "negative"])


def _count_finding(check: str, column: str, severity: str, text_: str) -> str:
    return f"SELECT '{check}' AS \"check\", CASE WHEN {column} > 0 THEN 'fail' ELSE 'pass' END AS status, '{severity}' AS severity, CASE WHEN {column} > 0 THEN {column} || ' {text_}' ELSE 'ok' END AS message FROM a"


@query(
    f"WITH {CARRIER}, a0 AS (SELECT {_FINE}, {_OUT}, count(*) FILTER (WHERE least(passengers, {_NEG}) < 0) AS negative, 0 AS extra FROM carrier_m), a AS (SELECT *, {_ANY} AS tot FROM a0) "
    + " UNION ALL ".join(
        [_count_finding("carrier.unique", "extra", "BLOCKING", "rows repeat a key"), *(_count_finding(f"carrier.load_factor.{f}", f"out_{f}", "ADVISORY", "outside 0 to 100") for f in FACTORS),
         *(_count_finding(f"carrier.precision.{m}", f"fine_{m}", "BLOCKING", "beyond three decimals") for m in CARRIER_METRICS),
         _count_finding("carrier.negative_metrics", "negative", "ADVISORY", "negative"), _count_finding("carrier.value_domain", "tot", "ADVISORY", "values out of order")]
    )
)
def dq05_carrier(spark, root):
    return checks.carrier_checks(carrier_months(spark, root), CARRIER_METRICS, FACTORS)


@query(f"""WITH {AIRPORT}, {CARRIER}, t AS (SELECT p, sum(passengers) AS t FROM airport_m GROUP BY p), c AS (SELECT p, coalesce(sum(passengers), 0) AS c FROM carrier_m WHERE service_type = 'scheduled_domestic' GROUP BY p), j AS (SELECT p, t, c, CAST(t AS DOUBLE) / nullif(CAST(c AS DOUBLE), 0) AS ratio FROM t JOIN c USING (p))
SELECT p, CAST(t AS BIGINT) AS throughput, CAST(c AS BIGINT) AS carried, ratio, coalesce(ratio BETWEEN 1.8 AND 2.2, t = 0) AS in_band FROM j""")
def dq06_semantics(spark, root):
    return checks.throughput_ratio(airport_months(spark, root, ("passengers",)), dashboard.carried(carrier_months(spark, root, ("passengers",))))


@query(f"WITH {QUARTER}, h AS (SELECT q FROM quarter_m WHERE airport IN (SELECT airport FROM quarter_m GROUP BY airport ORDER BY count(*), airport LIMIT 1)), c AS (SELECT CAST(unnest(generate_series(min(q), max(q))) AS INTEGER) AS p FROM h) SELECT p FROM c WHERE p NOT IN (SELECT q FROM h)")
def dq07_missing_periods(spark, root):
    q = airport_quarters(spark, root).withColumnRenamed("q", "p")
    least = q.groupBy("airport").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "airport").limit(1)
    return windows.missing_periods(q.join(least, "airport", "left_semi"))


@query(f"WITH {PAIRS} SELECT p, least(city1, city2) AS a, greatest(city1, city2) AS b, count(*) AS n FROM pairs GROUP BY 1, 2, 3 HAVING count(*) > 1")
def dq08_source_duplicates(spark, root):
    return checks.undirected_duplicates(city_pairs(spark, root))


@query(f"""WITH {AIRPORT}, {ROUTE}, d AS (SELECT p, origin AS airport, sum(passengers) AS n FROM route_m GROUP BY 1, 2), a AS (SELECT p, destination AS airport, sum(passengers) AS n FROM route_m GROUP BY 1, 2),
j AS (SELECT p, airport, greatest(coalesce(d.n, 0) - coalesce(m.departures, 0), 0) AS x, greatest(coalesce(a.n, 0) - coalesce(m.arrivals, 0), 0) AS y FROM (SELECT p, airport, departures, arrivals FROM airport_m) m FULL JOIN d USING (p, airport) FULL JOIN a USING (p, airport))
SELECT p, airport, CAST(x AS BIGINT) AS over_departures, CAST(y AS BIGINT) AS over_arrivals FROM j WHERE x > 0 OR y > 0""")
def dq09_containment(spark, root):
    return checks.endpoint_containment(route_months(spark, root), airport_months(spark, root))


@query(f"WITH {AIRPORT}, {ROUTE} SELECT DISTINCT airport FROM (SELECT origin AS airport FROM route_m UNION SELECT destination FROM route_m) WHERE airport NOT IN (SELECT airport FROM airport_m)")
def dq09_unknown_endpoints(spark, root):
    return checks.unknown_endpoints(route_months(spark, root), airport_months(spark, root, ("passengers",)).select("airport").distinct())


@query(f"""WITH {AIRPORT}, {ROUTE}, h AS (SELECT max(p) AS hi FROM route_m), r AS (SELECT route_m.*, hi FROM route_m, h WHERE p >= hi - 12), s AS (SELECT p, hi, count(*) AS n FROM r GROUP BY 1, 2), j AS (SELECT max(n) FILTER (WHERE p = hi) >= 0.7 * median(n) FILTER (WHERE p < hi) AS ok FROM s),
k AS (SELECT origin, destination, count(DISTINCT p) AS n_periods, sum(passengers) AS passengers FROM r WHERE p < hi GROUP BY 1, 2 HAVING count(DISTINCT p) >= 9 AND sum(passengers) >= 20000), n AS (SELECT origin, destination FROM r WHERE p = hi), x AS (SELECT airport AS a FROM airport_m WHERE p = (SELECT hi FROM h))
SELECT k.origin, k.destination, k.n_periods, CAST(k.passengers AS BIGINT) AS passengers FROM k, j WHERE j.ok AND NOT EXISTS (SELECT 1 FROM n WHERE n.origin = k.origin AND n.destination = k.destination) AND k.origin IN (SELECT a FROM x) AND k.destination IN (SELECT a FROM x)""")
def dq09_disappeared(spark, root):
    return checks.disappeared_routes(route_months(spark, root), airport_months(spark, root, ("passengers",)), volume=20_000)


@query(None)
def dq23_summary(spark, root):
    m = airport_months(spark, root)
    c = carrier_months(spark, root)
    parts = [checks.definitional(m, "airport_monthly"), checks.conservation_finding(m), checks.carrier_checks(c, CARRIER_METRICS, FACTORS), checks.coverage(m, "coverage.domestic_months")]
    return checks.summary(checks.gather(parts))


# --- sources, text and numbers ----------------------------------------------------------------


@query("SELECT file, CAST(row_idx AS INTEGER) AS header_idx FROM (SELECT file, min(row_idx) AS row_idx FROM sheet_rows WHERE contains(regexp_replace(upper(array_to_string(cells, ' ')), '[^A-Z0-9]+', ' ', 'g'), 'AIRLINE') AND contains(regexp_replace(upper(array_to_string(cells, ' ')), '[^A-Z0-9]+', ' ', 'g'), 'MONTH') GROUP BY file)")
def par01_header_rows(spark, root):
    return sheets.header_rows(read_table(spark, root, "sheet_rows"), ["AIRLINE", "MONTH"]).select("file", F.col("header_idx").cast("int").alias("header_idx"))


@query("""WITH h AS (SELECT file, arg_min(cells, row_idx) AS header FROM sheet_rows WHERE contains(regexp_replace(upper(array_to_string(cells, ' ')), '[^A-Z0-9]+', ' ', 'g'), 'AIRLINE') AND contains(regexp_replace(upper(array_to_string(cells, ' ')), '[^A-Z0-9]+', ' ', 'g'), 'MONTH') GROUP BY file),
c AS (SELECT file, unnest(generate_series(1, len(header))) AS i, header FROM h) SELECT h.file, CAST(min(c.i) - 1 AS INTEGER) AS pos FROM h LEFT JOIN c ON c.file = h.file AND contains(regexp_replace(upper(c.header[c.i]), '[^A-Z0-9]+', ' ', 'g'), 'FREIGHT') GROUP BY h.file""")
def par02_column_position(spark, root):
    h = sheets.header_rows(read_table(spark, root, "sheet_rows"), ["AIRLINE", "MONTH"])
    return h.select("file", sheets.column_position(F.col("header"), "FREIGHT").alias("pos"))


@query("""SELECT DISTINCT cell, CASE WHEN replace(trim(cell), ',', '') IN ('', '-') THEN 0.0 ELSE TRY_CAST(CASE WHEN regexp_matches(replace(trim(cell), ',', ''), '^[-+]?[0-9.]+$') THEN replace(trim(cell), ',', '') END AS DOUBLE) END AS number FROM (SELECT unnest(cells) AS cell FROM sheet_rows)""")
def str03_tolerant_number(spark, root):
    cells = read_table(spark, root, "sheet_rows").select(F.explode("cells").alias("cell")).distinct()
    return cells.select("cell", text.tolerant_number("cell").alias("number"))


@query("SELECT DISTINCT source_label, trim(regexp_replace(regexp_replace(upper(source_label), '[^A-Z0-9]+', ' ', 'g'), ' +', ' ', 'g')) AS key, upper(trim(regexp_replace(source_label, '\\s+', ' ', 'g'))) AS form FROM entity_windows")
def str02_label_keys(spark, root):
    labels = read_table(spark, root, "entity_windows").select("source_label").distinct()
    return labels.select("source_label", text.clean_key("source_label").alias("key"), text.label_form("source_label").alias("form"))


@query("SELECT DISTINCT file, CAST(regexp_extract(file, '_([0-9]{2})[.]xlsx$', 1) AS INTEGER) + 2000 AS stem_year FROM sheet_rows")
def str07_stem_year(spark, root):
    return read_table(spark, root, "sheet_rows").select("file").distinct().select("file", text.stem_year("file").alias("stem_year"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%B') AS name, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders")
def str05_month_number(spark, root):
    o = read_table(spark, root, "orders").select("o_orderkey", F.date_format("o_orderdate", "MMMM").alias("name"))
    return o.select("o_orderkey", "name", text.month_number("name").alias("month"))


@query("SELECT DISTINCT airline, CAST(CAST('0x' || substr(sha256(airline), 1, 8) AS BIGINT) % 8 AS INTEGER) AS bucket FROM (SELECT trim(airline) AS airline FROM carrier_monthly)")
def str14_stable_bucket(spark, root):
    return read_table(spark, root, "carrier_monthly").select(F.trim("airline").alias("airline")).distinct().select("airline", text.stable_bucket("airline").alias("bucket"))


@query(f"WITH {AIRPORT}, s AS (SELECT airport, max(passengers) AS v FROM airport_m GROUP BY airport), x AS (SELECT airport, v, pow(10.0, floor(log10(v))) AS k FROM s WHERE v > 0) SELECT airport, v, CASE WHEN v <= k THEN k WHEN v <= 1.25 * k THEN 1.25 * k WHEN v <= 1.5 * k THEN 1.5 * k WHEN v <= 2 * k THEN 2 * k WHEN v <= 2.5 * k THEN 2.5 * k WHEN v <= 5 * k THEN 5 * k WHEN v <= 7.5 * k THEN 7.5 * k ELSE 10 * k END AS bound FROM x")
def str18_upper_bound(spark, root):
    s = airport_months(spark, root, ("passengers",)).groupBy("airport").agg(F.max("passengers").alias("v")).where("v > 0")
    return s.select("airport", "v", text.upper_bound("v").alias("bound"))


@query(f"WITH {AIRPORT} SELECT DISTINCT p, strftime(make_date(p // 12, p % 12 + 1, 1), '%b %Y') AS label FROM airport_m")
def str21_period_label(spark, root):
    return airport_months(spark, root, ("passengers",)).select("p").distinct().select("p", periods.month_label("p").alias("label"))


@query(f"WITH {AIRPORT}, {ROUTE} SELECT r.origin, least(r.origin, r.destination) AS a, greatest(r.origin, r.destination) AS b, r.p, r.passengers FROM route_m r")
def src03_route_reader(spark, root):
    return route_months(spark, root).select("origin", F.least("origin", "destination").alias("a"), F.greatest("origin", "destination").alias("b"), "p", "passengers")


@query("SELECT CAST(y AS INTEGER) AS year, CAST(q AS INTEGER) AS quarter, CAST(t AS INTEGER) AS table_no, lpad(CAST(y % 100 AS VARCHAR), 2, '0') || 'Q' || q || '_' || t || '.xlsx' AS name FROM generate_series(2015, 2024) a(y), generate_series(1, 4) b(q), generate_series(1, 4) c(t)")
def src16_candidate_names(spark, root):
    return links.candidate_names(spark, 2015, 2024)


@query("""WITH f AS (SELECT DISTINCT regexp_extract(file, '_([0-9]{4})_', 1) AS y, CAST(regexp_extract(file, '_([0-9]{2})[.]xlsx$', 1) AS INTEGER) AS m, CAST(regexp_extract(file, '^carrier_([0-9]+)_', 1) AS INTEGER) % 3 + 1 AS t FROM sheet_rows),
s AS (SELECT CAST(y AS INTEGER) AS year, (m - 1) // 3 + 1 AS quarter, list(DISTINCT t) AS have FROM f GROUP BY 1, 2) SELECT year, CAST(quarter AS INTEGER) AS quarter FROM s WHERE list_has_any(have, [1, 2, 3]) AND NOT list_contains(have, 4)""")
def src17_fallback_periods(spark, root):
    part = lambda k: F.regexp_extract("file", r"^carrier_(\d+)_(\d{4})_(\d{2})\.xlsx$", k).try_cast("int")
    f = read_table(spark, root, "sheet_rows").select("file").distinct().select(part(2).alias("year"), F.floor((part(3) - 1) / 3 + 1).cast("int").alias("quarter"), (part(1) % 3 + 1).alias("table_no"))
    return links.fallback_periods(f)


@query("SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, 'carrier_[0-9]+_[0-9]{4}_[0-9]{2}[.]xlsx'))) AS file FROM documents")
def src12_extracted_names(spark, root):
    names = F.array_distinct(F.regexp_extract_all("text", F.lit(r"carrier_[0-9]+_[0-9]{4}_[0-9]{2}\.xlsx"), F.lit(0)))
    return read_table(spark, root, "documents").select("doc_id", F.explode(names).alias("file"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def src13_nested_values(spark, root):
    return read_table(spark, root, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


@query("""SELECT file AS source, 'excel' AS source_type, CAST(sum(len(array_to_string(cells, '|'))) AS BIGINT) AS content_length, sha256(string_agg(array_to_string(cells, '|'), chr(10) ORDER BY row_idx)) AS sha256 FROM sheet_rows GROUP BY file""")
def man03_fingerprints(spark, root):
    r = read_table(spark, root, "sheet_rows")
    line = F.array_join("cells", "|")
    whole = r.groupBy("file").agg(F.sum(F.length(line)).alias("content_length"), F.transform(F.array_sort(F.collect_list(F.struct("row_idx", line.alias("line")))), lambda x: x["line"]).alias("lines"))
    return whole.select(F.col("file").alias("source"), manifest.source_type(F.col("file")).alias("source_type"), "content_length", F.sha2(F.array_join("lines", "\n"), 256).alias("sha256"))


@query("""WITH f AS (SELECT DISTINCT file, regexp_extract(file, '^carrier_([0-9]+)_', 1) AS feed, regexp_extract(file, '_([0-9]{4}_[0-9]{2})[.]', 1) AS month FROM sheet_rows), a AS (SELECT feed AS source, md5(month) AS h FROM f WHERE month = '2023_01'), b AS (SELECT feed AS source, md5(CASE WHEN feed LIKE '%3' THEN month ELSE '2023_01' END) AS h FROM f WHERE month = '2023_02')
SELECT coalesce(a.source, b.source) AS source, CASE WHEN a.source IS NULL THEN 'added' WHEN b.source IS NULL THEN 'removed' ELSE 'changed' END AS change FROM a FULL JOIN b ON a.source = b.source WHERE a.h IS DISTINCT FROM b.h""")
def man04_manifest_diff(spark, root):
    part = lambda p: F.regexp_extract("file", p, 1)
    f = read_table(spark, root, "sheet_rows").select("file").distinct().select(part(r"^carrier_([0-9]+)_").alias("source"), part(r"_([0-9]{4}_[0-9]{2})[.]").alias("month"))
    a = f.where("month = '2023_01'").select("source", F.md5("month").alias("sha256"))
    b = f.where("month = '2023_02'").select("source", F.md5(F.when(F.col("source").endswith("3"), F.col("month")).otherwise("2023_01")).alias("sha256"))
    return manifest.diff_manifests(a, b)


@query("SELECT c_custkey, CASE WHEN c_name = s_name OR CAST(round(c_acctbal) AS BIGINT) = CAST(round(s_acctbal) AS BIGINT) THEN 'unchanged' WHEN s_name IS NULL AND s_acctbal IS NULL THEN 'unknown' ELSE 'changed' END AS verdict FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey")
def man06_head_change(spark, root):
    j = read_table(spark, root, "customer").join(read_table(spark, root, "supplier"), F.col("c_custkey") == F.col("s_suppkey"), "left")
    n = lambda c: F.round(c).cast("bigint")
    return j.select("c_custkey", manifest.head_change(F.col("c_name"), F.col("s_name"), n("c_acctbal"), n("s_acctbal")).alias("verdict"))


_PUBLISHED = ("airport_monthly", "carrier_monthly", "domestic_route_monthly")


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, (SELECT count(*) FROM {t}) AS n_rows, (SELECT string_agg(column_name, ',') FROM (DESCRIBE {t})) AS columns, '{SPECS[t].version}' AS version" for t in _PUBLISHED))
def snk03_metadata(spark, root):
    found = sinks.table_metadata({t: read_table(spark, root, t) for t in _PUBLISHED})
    return spark.createDataFrame([(t, m["rows"], ",".join(m["columns"]), m["version"]) for t, m in found.items()], "name string, n_rows long, columns string, version string")


@query(None)
def par07_token_rows(spark, root):
    """Events as positioned tokens: a day is a page, the value is the height."""
    e = read_table(spark, root, "events")
    tokens = e.select(F.dayofyear("ts").alias("page"), F.col("value").alias("y0"), (F.col("event_id") % 500).alias("x0"), F.col("event_type").alias("text"))
    return sheets.cluster_tokens(tokens)
