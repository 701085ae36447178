"""Labels whose meaning changes with time, resolved to canonical keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightloom.functions.text import label_form

#: Month of a quarter at which its labels are looked up: the middle one.
QUARTER_MONTH = {1: 2, 2: 5, 3: 8, 4: 11}


class LabelConflict(ValueError):
    """One label stands for two entities at the same time."""


def label_windows(entities: DataFrame, variants: DataFrame, aliases: DataFrame) -> DataFrame:
    """Dimension (label, canonical, lo, hi, seq) from configuration.

    ``entities`` (canonical, city, name) give their city and name as labels for all time, unless
    ``variants`` (canonical, label, lo, hi, seq) names labels of their own, which replace
    them; ``aliases`` (label, canonical) are added for all time.
    """
    own = variants.select(label_form("label").alias("label"), "canonical", F.col("lo").cast("int").alias("lo"), F.col("hi").cast("int").alias("hi"), F.col("seq").cast("int").alias("seq"))
    bare = entities.join(variants.select("canonical").distinct(), "canonical", "left_anti")
    implicit = bare.select("canonical", F.explode(F.array_distinct(F.array("city", "name"))).alias("label")).where("label IS NOT NULL")
    always = implicit.unionByName(aliases.select("canonical", "label"))
    rest = always.select(label_form("label").alias("label"), "canonical", F.lit(None).cast("int").alias("lo"), F.lit(None).cast("int").alias("hi"), F.lit(1_000_000).alias("seq"))
    return own.unionByName(rest).distinct()


def conflicts(windows: DataFrame) -> DataFrame:
    """Pairs of windows of one label that overlap but stand for different entities.

    An equi-join on the label, so only windows of one label meet.  To lose no
    pair and yet not compare all windows of a crowded label, it is first reduced to its
    distinct windows.
    """
    w = windows.select("label", "canonical", F.coalesce("lo", F.lit(-(2**31) + 1)).alias("lo"), F.coalesce("hi", F.lit(2**31 - 1)).alias("hi")).where("label IS NOT NULL AND lo <= hi").distinct()
    b = w.select("label", F.col("canonical").alias("other"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    return w.join(b, "label").where("canonical < other AND lo <= hi2 AND lo2 <= hi").select("label", "canonical", "other", F.greatest("lo", "lo2").alias("lo"), F.least("hi", "hi2").alias("hi"))


def assert_no_conflicts(windows: DataFrame) -> None:
    found = conflicts(windows).limit(5).collect()
    if found:
        raise LabelConflict("; ".join(f"{r.label}: {r.canonical} and {r.other}" for r in found))


def resolve(facts: DataFrame, windows: DataFrame, label: str, period: str, out: str = "canonical") -> DataFrame:
    """``facts`` with the canonical key of each label at its period; null if no window holds.

    Of several windows that hold, the first by ``seq`` counts, so no fact is multiplied.  Windows
    are gathered per label (a reviewed, bounded dimension) and meet the facts in one
    equi-join, which Spark broadcasts if it is small; the period is looked up inside the row.
    """
    per_label = windows.groupBy(F.col("label").alias("__label")).agg(F.sort_array(F.collect_list(F.struct("seq", "canonical", "lo", "hi"))).alias("__w"))
    joined = facts.withColumn("__label", label_form(label)).join(per_label, "__label", "left")
    p = F.col(period)
    holds = lambda w: (w["lo"].isNull() | (p >= w["lo"])) & (w["hi"].isNull() | (p <= w["hi"]))
    return joined.withColumn(out, F.get(F.filter("__w", holds), F.lit(0))["canonical"]).drop("__label", "__w")


def resolve_pairs(pairs: DataFrame, windows: DataFrame, period: str = "p") -> DataFrame:
    """Both endpoints of city pairs: adds ``a1`` and ``a2``."""
    return resolve(resolve(pairs, windows, "city1", period, "a1"), windows, "city2", period, "a2")


def resolve_or_raw(facts: DataFrame, windows: DataFrame, label: str, at: int, out: str) -> DataFrame:
    """Resolve at one fixed period; labels without a window keep their trimmed spelling."""
    found = resolve(facts.withColumn("__p", F.lit(at)), windows, label, "__p", "__found").drop("__p")
    return found.withColumn(out, F.coalesce("__found", F.trim(label))).drop("__found")


def quarter_month(year: str, quarter: str):
    """Month ordinal at which a quarter's labels are resolved."""
    return (F.col(year) * 12 + F.col(quarter) * 3 - 2).cast("int")


def concurrent_labels(resolved: DataFrame, canonical: str, period: str, label: str) -> DataFrame:
    """(canonical, p, labels) where several labels feed one entity in the same period."""
    known = resolved.where(F.col(canonical).isNotNull())
    return known.groupBy(canonical, period).agg(F.array_sort(F.collect_set(label_form(label))).alias("labels")).where("size(labels) > 1")


def co_occurrence(resolved: DataFrame, canonical: str, period: str, label: str) -> DataFrame:
    """Pairs of labels of one entity and the number of periods they share.

    Pairs come from the sorted label sets, not from a self-join of the facts.
    """
    sets = concurrent_labels(resolved, canonical, period, label)
    pairs = F.flatten(F.transform("labels", lambda a, i: F.transform(F.slice("labels", i + 2, F.size("labels")), lambda b: F.struct(a.alias("label1"), b.alias("label2")))))
    return sets.select(canonical, period, F.explode(pairs).alias("x")).groupBy(canonical, "x.label1", "x.label2").agg(F.count(F.lit(1)).alias("n_periods"))


def first_window(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of rows with equal keys the first by ``order``."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")
