"""Assumptions that data can falsify: named tests, their verdicts, and what no assumption covers.

A test is a function from parameters and tables to one row (verdict, detail); tests are looked up by name,
so further ones can be registered.  Everything stays in frames until a caller collects the verdicts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightloom.functions.text import label_form

HOLDS, TRIGGERED, ORPHANED, STALE = "HOLDS", "TRIGGERED", "ORPHANED", "STALE"


@dataclass(frozen=True)
class Assumption:
    id: str
    test: str
    params: dict = field(default_factory=dict)
    covers: tuple[str, ...] = ()
    #: ``YYYY-MM`` after which a verdict that holds is stale
    recheck_by: str | None = None


@dataclass(frozen=True)
class Context:
    """Tables that tests look at: airport months, (label, p) facts, carrier months, declared label sets."""

    monthly: DataFrame
    labels: DataFrame
    carriers: DataFrame
    declared: dict[str, frozenset[str]] = field(default_factory=dict)


def parse_front_matter(text: str) -> tuple[dict, str]:
    """Head (YAML between ``---`` lines) and body of a note; notes without a head have an empty one."""
    if not text.startswith("---"):
        return {}, text
    _, head, body = text.split("---", 2)
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading notes needs a YAML parser") from e
    return yaml.safe_load(head) or {}, body.strip()


def _present(df: DataFrame, column: str, names: list[str]) -> DataFrame:
    """One row: the ``names`` that occur in the column, sorted, and whether the table has rows at all."""
    return df.agg(F.array_sort(F.collect_set(F.when(F.col(column).isin(names), F.col(column)))).alias("have"), (F.count(F.lit(1)) > 0).alias("any"))


def _verdict(df: DataFrame, verdict: Column, detail: Column) -> DataFrame:
    return df.select(verdict.alias("verdict"), detail.alias("detail"))


def size_ordering(params: dict, ctx: Context) -> DataFrame:
    """The total of one airport is at least that of another; an absent one triggers."""
    big, small = params["bigger"], params["smaller"]
    total = lambda a: F.sum(F.when(F.col("airport") == a, F.col("passengers")))
    sums = ctx.monthly.agg(total(big).alias("a"), total(small).alias("b"))
    holds = F.coalesce(F.col("a") >= F.col("b"), F.lit(False))
    absent = F.col("a").isNull() | F.col("b").isNull()
    return _verdict(sums, F.when(holds, HOLDS).otherwise(TRIGGERED), F.when(absent, f"{big} or {small} is absent").otherwise(F.format_string(f"{big} %d, {small} %d", "a", "b")))


def airports_distinct(params: dict, ctx: Context) -> DataFrame:
    """All named airports occur; a missing one may have been merged into another."""
    names = list(params["airports"])
    missing = F.array_except(F.array(*map(F.lit, names)), F.col("have"))
    return _verdict(_present(ctx.monthly, "airport", names), F.when(F.size(missing) == 0, HOLDS).otherwise(TRIGGERED), F.concat(F.lit("missing: "), F.array_join(missing, ", ")))


def airlines_distinct(params: dict, ctx: Context) -> DataFrame:
    """All named airlines occur in the carrier table; without that table the assumption is orphaned."""
    names = list(params["airlines"])
    missing = F.array_except(F.array(*map(F.lit, names)), F.col("have"))
    verdict = F.when(~F.col("any"), ORPHANED).when(F.size(missing) == 0, HOLDS).otherwise(TRIGGERED)
    return _verdict(_present(ctx.carriers, "airline", names), verdict, F.concat(F.lit("missing: "), F.array_join(missing, ", ")))


def _shared_periods(ctx: Context, labels: list[str]) -> DataFrame:
    """One row: how many of the labels occur, and the periods in which two of them do."""
    wanted = sorted({x.upper() for x in labels})
    own = ctx.labels.select(label_form("label").alias("label"), "p").where(F.col("label").isin(wanted)).distinct()
    per = own.groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    shared = per.agg(F.count_if(F.col("n") > 1).alias("shared"), F.min(F.when(F.col("n") > 1, F.col("p"))).alias("first"))
    return shared.join(own.agg(F.countDistinct("label").alias("present")), F.lit(True))


def labels_disjoint(params: dict, ctx: Context) -> DataFrame:
    """A rename: the labels never occur in the same period; none of them at all orphans it."""
    verdict = F.when(F.col("shared") > 0, TRIGGERED).when(F.col("present") == 0, ORPHANED).otherwise(HOLDS)
    return _verdict(_shared_periods(ctx, params["labels"]), verdict, F.format_string("%d labels, %d shared periods", "present", "shared"))


def concurrent_declared(params: dict, ctx: Context) -> DataFrame:
    """Labels that run side by side are declared as one airport; if they no longer do, it is orphaned."""
    declared = {x.upper() for x in params["labels"]} <= {x.upper() for x in ctx.declared.get(params["airport"], ())}
    verdict = F.when(F.col("shared") == 0, ORPHANED).otherwise(HOLDS if declared else TRIGGERED)
    return _verdict(_shared_periods(ctx, params["labels"]), verdict, F.format_string("%d shared periods", "shared"))


#: The names under which assumptions ask for their tests.
TESTS: dict[str, Callable[[dict, Context], DataFrame]] = {
    "size-ordering-holds": size_ordering,
    "distinct-airports-not-merged": airports_distinct,
    "month-disjoint-rename": labels_disjoint,
    "concurrent-merge-declared": concurrent_declared,
    "airlines-linked-not-collapsed": airlines_distinct,
}


def evaluate(assumptions: list[Assumption], ctx: Context, today: str, tests: dict | None = None) -> DataFrame:
    """(id, test, verdict, detail) of each assumption.

    An unknown test or missing parameters trigger; a verdict that holds is stale once ``recheck_by`` is before
    ``today`` (both ``YYYY-MM``).
    """
    tests = TESTS if tests is None else tests
    spark = ctx.monthly.sparkSession
    parts = []
    for a in assumptions:
        try:
            row = tests[a.test](a.params, ctx)
        except (KeyError, TypeError, AttributeError) as e:
            row = spark.createDataFrame([(TRIGGERED, f"test or parameter {e} is not known")], "verdict string, detail string")
        if a.recheck_by and a.recheck_by < today:
            late = F.col("verdict") == HOLDS
            row = row.select(F.when(late, STALE).otherwise(F.col("verdict")).alias("verdict"), F.when(late, f"to be checked by {a.recheck_by}").otherwise(F.col("detail")).alias("detail"))
        parts.append(row.select(F.lit(a.id).alias("id"), F.lit(a.test).alias("test"), "verdict", "detail"))
    if not parts:
        return spark.createDataFrame([], "id string, test string, verdict string, detail string")
    return reduce(DataFrame.unionByName, parts)


def uncovered_merges(concurrent: DataFrame, assumptions: list[Assumption], canonical: str = "canonical") -> DataFrame:
    """Entities fed by several labels at a time that no assumption covers: (canonical, labels)."""
    covered = sorted({c for a in assumptions for c in a.covers})
    merged = concurrent.groupBy(canonical).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("labels")))).alias("labels"))
    return merged.where(~F.col(canonical).isin(covered)) if covered else merged


def worklist(undeclared: DataFrame, unmapped: DataFrame, assumptions: list[Assumption], canonical: str = "canonical", period: str = "p") -> DataFrame:
    """What needs a decision: (kind, key, labels, months), undeclared merges without cover and large unknown labels.

    ``months`` are the first six periods concerned.
    """
    covered = sorted({c for a in assumptions for c in a.covers})
    first = F.slice(F.array_sort(F.collect_set(period)), 1, 6)
    merges = undeclared.groupBy(canonical).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("labels")))).alias("labels"), first.alias("months"))
    if covered:
        merges = merges.where(~F.col(canonical).isin(covered))
    a = merges.select(F.lit("undeclared_concurrent").alias("kind"), F.col(canonical).alias("key"), "labels", "months")
    b = unmapped.select(F.lit("unmapped_high_volume").alias("kind"), F.col("label").alias("key"), F.array("label").alias("labels"), F.array().cast("array<int>").alias("months"))
    return a.unionByName(b).orderBy("kind", "key")
