"""Data-quality checks: every check is a frame of findings (check, status, severity, message).

Checks are aggregates; none brings data to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom.operators import windows
from flightloom.sources.tables import SPECS, TableSpec

BLOCKING, TRIPWIRE, ADVISORY = "BLOCKING", "TRIPWIRE", "ADVISORY"
FINDING = "check string, status string, severity string, message string"
#: Throughput counts a journey twice; the ratio to passengers carried must lie inside.
BAND = (1.8, 2.2)


def finding(agg: DataFrame, check: str | Column, bad: Column, severity: str, message: Column) -> DataFrame:
    """One finding per row of ``agg``: failed where ``bad`` is positive or true."""
    failed = F.coalesce(bad.cast("long") > 0, F.lit(False))
    name = F.lit(check) if isinstance(check, str) else check
    return agg.select(name.alias("check"), F.when(failed, "fail").otherwise("pass").alias("status"), F.lit(severity).alias("severity"), F.when(failed, message).otherwise("ok").alias("message"))


def gather(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def duplicate_counts(df: DataFrame, key: list[str]) -> DataFrame:
    """``extra``: rows beyond the first of their key; ``involved``: all rows of keys that repeat."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("involved"))


def key_unique(df: DataFrame, key: list[str], check: str, severity: str = BLOCKING) -> DataFrame:
    return finding(duplicate_counts(df, key), check, F.col("extra"), severity, F.format_string("%d rows repeat a key", F.col("extra")))


def cadence(monthly: DataFrame, quarterly: DataFrame) -> DataFrame:
    """Keys of both layers are unique, the monthly one has no quarter, quarters are 1 to 4."""
    no_quarter = monthly.agg(F.lit(int("quarter" in monthly.columns)).alias("n"))
    domain = quarterly.agg(F.count_if(~F.col("quarter").between(1, 4) | F.col("quarter").isNull()).alias("n"))
    return gather(
        [
            key_unique(monthly, ["year", "month", "airport"], "cadence.layer1_unique"),
            finding(no_quarter, "cadence.layer1_no_quarter", F.col("n"), BLOCKING, F.lit("monthly layer has a quarter")),
            key_unique(quarterly, ["year", "quarter", "airport"], "cadence.layer2_unique"),
            finding(domain, "cadence.layer2_quarter_domain", F.col("n"), BLOCKING, F.format_string("%d rows outside quarter 1 to 4", F.col("n"))),
        ]
    )


def definitional(df: DataFrame, layer: str) -> DataFrame:
    """passengers = departures + arrivals, nothing negative, whole numbers."""
    whole = all(df.schema[c].dataType.simpleString() in ("bigint", "int") for c in ("passengers", "departures", "arrivals"))
    agg = df.agg(
        F.count_if(~F.col("passengers").eqNullSafe(F.col("departures") + F.col("arrivals"))).alias("off"),
        F.count_if(F.least("passengers", "departures", "arrivals") < 0).alias("negative"),
        F.lit(int(not whole)).alias("kind"),
    )
    return gather(
        [
            finding(agg, f"definitional.sum.{layer}", F.col("off"), BLOCKING, F.format_string("%d rows do not add up", F.col("off"))),
            finding(agg, f"definitional.nonneg.{layer}", F.col("negative"), BLOCKING, F.format_string("%d rows are negative", F.col("negative"))),
            finding(agg, f"definitional.int.{layer}", F.col("kind"), BLOCKING, F.lit("measures are not whole numbers")),
        ]
    )


def schema_findings(spark: SparkSession, tables: dict[str, DataFrame], versions: dict[str, str] | None = None, specs: dict[str, TableSpec] = SPECS) -> DataFrame:
    """Presence, exact column order, types and version of each declared table."""
    rows = []
    for name, spec in sorted(specs.items()):
        df = tables.get(name)
        rows.append((f"schema.{name}.present", "pass" if df is not None else "fail", BLOCKING, "ok" if df is not None else "table is missing"))
        if df is None:
            continue
        want, have = [c for c, _ in spec.columns], df.columns
        rows.append((f"schema.{name}.columns", "pass" if want == have else "fail", BLOCKING, "ok" if want == have else f"columns are {', '.join(have)}"))
        off = [c for c, t in spec.columns if c in have and df.schema[c].dataType.simpleString() != t]
        rows.append((f"schema.{name}.dtypes", "fail" if off else "pass", BLOCKING, f"types differ: {', '.join(off)}" if off else "ok"))
        if versions is not None:
            same = versions.get(name) == spec.version
            rows.append((f"schema.{name}.version", "pass" if same else "fail", BLOCKING, "ok" if same else f"version is {versions.get(name)}"))
    return spark.createDataFrame(rows, FINDING)


def conservation(monthly: DataFrame) -> DataFrame:
    """Per period, departures equal arrivals over all airports: (p, departures, arrivals) where they do not."""
    sums = monthly.groupBy("p").agg(F.sum("departures").alias("departures"), F.sum("arrivals").alias("arrivals"))
    return sums.where("departures <> arrivals")


def conservation_finding(monthly: DataFrame) -> DataFrame:
    off = conservation(monthly).agg(F.count(F.lit(1)).alias("n"), F.slice(F.array_sort(F.collect_list("p")), 1, 3).alias("first"))
    return finding(off, "conservation.tripwire", F.col("n"), TRIPWIRE, F.format_string("%d periods out of balance, first %s", F.col("n"), F.array_join(F.transform("first", lambda p: p.cast("string")), ", ")))


def carrier_checks(carrier: DataFrame, metrics: tuple[str, ...], factors: tuple[str, ...]) -> DataFrame:
    """One pass over carrier facts: factors in 0 to 100, at most three decimals, no negative metric."""
    outside = lambda c: F.count_if(~F.col(c).between(0, 100))
    fine = lambda c: F.count_if(F.round(c, 3) != F.col(c))
    agg = carrier.agg(
        *(outside(c).alias(f"out_{c}") for c in factors), *(fine(c).alias(f"fine_{c}") for c in metrics),
        F.count_if(F.array_min(F.array("passengers", *(c for c in metrics if c not in factors))) < 0).alias("negative"),
    )
    counts = [*(f"out_{c}" for c in factors), *(f"fine_{c}" for c in metrics), "negative"]
    agg = agg.withColumn("any", reduce(lambda a, b: a + b, map(F.col, counts)))
    parts = [key_unique(carrier, ["airline", "service_type", "p"], "carrier.unique")]
    parts += [finding(agg, f"carrier.load_factor.{c}", F.col(f"out_{c}"), ADVISORY, F.format_string("%d outside 0 to 100", F.col(f"out_{c}"))) for c in factors]
    parts += [finding(agg, f"carrier.precision.{c}", F.col(f"fine_{c}"), BLOCKING, F.format_string("%d beyond three decimals", F.col(f"fine_{c}"))) for c in metrics]
    parts += [finding(agg, "carrier.negative_metrics", F.col("negative"), ADVISORY, F.format_string("%d negative", F.col("negative")))]
    parts += [finding(agg, "carrier.value_domain", F.col("any"), ADVISORY, F.format_string("%d values out of order", F.col("any")))]
    return gather(parts)


def throughput_ratio(monthly: DataFrame, carried: DataFrame) -> DataFrame:
    """(p, throughput, carried, ratio, in_band) for periods that both layers have."""
    t = monthly.groupBy("p").agg(F.sum("passengers").alias("throughput"))
    both = t.join(carried.groupBy("p").agg(F.sum("passengers").alias("carried")), "p")
    ratio = F.try_divide(F.col("throughput").cast("double"), F.col("carried").cast("double"))
    return both.select("p", "throughput", "carried", ratio.alias("ratio"), F.coalesce(ratio.between(*BAND), F.col("throughput") == 0).alias("in_band"))


def coverage(df: DataFrame, check: str) -> DataFrame:
    gaps = windows.missing_periods(df).agg(F.count(F.lit(1)).alias("n"), F.slice(F.array_sort(F.collect_list("p")), 1, 5).alias("first"))
    return finding(gaps, check, F.col("n"), ADVISORY, F.format_string("%d periods missing, first %s", F.col("n"), F.array_join(F.transform("first", lambda p: p.cast("string")), ", ")))


def undirected_duplicates(pairs: DataFrame) -> DataFrame:
    """Pair rows that occur more than once in one period, whichever end comes first: (p, a, b, n)."""
    ends = pairs.select("p", F.least("city1", "city2").alias("a"), F.greatest("city1", "city2").alias("b"))
    return ends.groupBy("p", "a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def endpoint_containment(routes: DataFrame, monthly: DataFrame) -> DataFrame:
    """By how much routes exceed the airport layer: (p, airport, over_departures, over_arrivals) where they do."""
    dep = routes.groupBy("p", F.col("origin").alias("airport")).agg(F.sum("passengers").alias("out"))
    arr = routes.groupBy("p", F.col("destination").alias("airport")).agg(F.sum("passengers").alias("inn"))
    joined = monthly.select("p", "airport", "departures", "arrivals").join(dep, ["p", "airport"], "full").join(arr, ["p", "airport"], "full").na.fill(0, ["departures", "arrivals", "out", "inn"])
    over = lambda a, b: F.greatest(F.col(a) - F.col(b), F.lit(0))
    return joined.select("p", "airport", over("out", "departures").alias("over_departures"), over("inn", "arrivals").alias("over_arrivals")).where("over_departures > 0 OR over_arrivals > 0")


def unknown_endpoints(routes: DataFrame, known: DataFrame) -> DataFrame:
    """Endpoints of routes that are no known airport."""
    ends = routes.select(F.explode(F.array("origin", "destination")).alias("airport")).distinct()
    return ends.join(known, "airport", "left_anti")


def disappeared_routes(routes: DataFrame, monthly: DataFrame, months: int = 9, volume: int = 100_000, usual: float = 0.7) -> DataFrame:
    """Routes gone from the latest period though they were regular and large, and both ends are still active airports.

    Nothing is reported if the latest period has less than ``usual`` of the median number of rows of
    the twelve periods before: it is not complete then.
    """
    last = routes.agg(F.max("p").alias("hi")).where("hi IS NOT NULL")
    recent = routes.join(F.broadcast(last), (F.col("p") <= F.col("hi")) & (F.col("p") >= F.col("hi") - 12))
    sizes = recent.groupBy("p", "hi").agg(F.count(F.lit(1)).alias("n"))
    judge = sizes.groupBy("hi").agg(F.max(F.when(F.col("p") == F.col("hi"), F.col("n"))).alias("now"), F.median(F.when(F.col("p") < F.col("hi"), F.col("n"))).alias("usual")).where(F.col("now") >= usual * F.col("usual"))
    past = recent.where("p < hi").groupBy("origin", "destination", "hi").agg(F.countDistinct("p").alias("n_periods"), F.sum("passengers").alias("passengers")).where(f"n_periods >= {months} AND passengers >= {volume}")
    now = routes.join(F.broadcast(last), F.col("p") == F.col("hi"))
    active = monthly.join(F.broadcast(last), F.col("p") == F.col("hi")).select("airport").distinct()
    gone = past.join(F.broadcast(judge), "hi", "left_semi").join(now.select("origin", "destination"), ["origin", "destination"], "left_anti")
    gone = gone.join(active.withColumnRenamed("airport", "origin"), "origin", "left_semi").join(active.withColumnRenamed("airport", "destination"), "destination", "left_semi")
    return gone.select("origin", "destination", "n_periods", "passengers")


def undeclared_labels(concurrent: DataFrame, declared: DataFrame, canonical: str, period: str) -> DataFrame:
    """Concurrent labels not all declared for their entity: (canonical, p, labels, undeclared)."""
    joined = concurrent.join(declared.select(canonical, F.col("labels").alias("__d")), canonical, "left")
    out = joined.withColumn("undeclared", F.array_except("labels", F.coalesce("__d", F.array().cast("array<string>"))))
    return out.where("size(undeclared) > 0").select(canonical, period, "labels", "undeclared")


def unmapped_volume(resolved: DataFrame, label: str, canonical: str, year: str, value: str, least: int) -> DataFrame:
    """Labels without an entity by their passengers per observed year, if large: (label, years, passengers, per_year)."""
    loose = resolved.where(F.col(canonical).isNull() & F.col(label).isNotNull())
    out = loose.groupBy(F.col(label).alias("label")).agg(F.countDistinct(year).alias("years"), F.sum(value).cast("bigint").alias("passengers"))
    return out.withColumn("per_year", F.col("passengers") / F.greatest(F.col("years"), F.lit(1))).where(F.col("per_year") >= least)


def summary(findings: DataFrame) -> DataFrame:
    """Findings counted by outcome, and the exit code: 1 if anything blocking or a tripwire failed."""
    failed = F.col("status") == "fail"
    agg = findings.agg(
        F.count_if(~failed).alias("passed"),
        F.count_if(failed & (F.col("severity") == BLOCKING)).alias("blocking"),
        F.count_if(failed & (F.col("severity") == TRIPWIRE)).alias("tripwire"),
        F.count_if(failed & (F.col("severity") == ADVISORY)).alias("advisory"),
    )
    return agg.withColumn("exit_code", F.when((F.col("blocking") > 0) | (F.col("tripwire") > 0), 1).otherwise(0))
