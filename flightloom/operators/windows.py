"""Trailing windows in four distinct meanings, and other functions along a calendar.

Series that are one row per period are ordered in one task on purpose: they are
aggregated to a few hundred periods first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightloom.functions.periods import calendar


def along():
    """Window over a whole series in the order of its periods."""
    return Window.partitionBy(F.lit(0)).orderBy("p")


def matrix_trailing(df: DataFrame, entity: str, value: str, width: int) -> DataFrame:
    """Zero-filled: a period is emitted for every entity if all ``width`` periods up to it exist somewhere in the table."""
    periods = df.select("p").distinct()
    whole = periods.withColumn("n", F.count("p").over(along().rangeBetween(-(width - 1), 0))).where(F.col("n") == width).select("p")
    sums = df.groupBy(entity, "p").agg(F.coalesce(F.sum(value), F.lit(0)).alias("v"))
    # a value counts in the `width` periods from its own on; only those that are emitted stay
    reach = sums.select(entity, "v", F.explode(F.sequence(F.col("p"), F.col("p") + (width - 1))).alias("p")).join(whole, "p", "left_semi")
    got = reach.groupBy(entity, "p").agg(F.sum("v").alias("total"))
    # the calendar is one row of a few hundred periods; entities stay where they are
    periods_row = F.broadcast(whole.agg(F.sort_array(F.collect_list("p")).alias("__ps")))
    spots = df.select(entity).where(F.col(entity).isNotNull()).distinct().join(periods_row, F.lit(True)).select(entity, F.explode("__ps").alias("p"))
    return spots.join(got, [entity, "p"], "left").select(entity, "p", F.coalesce("total", F.lit(0)).alias("total"))


def gap_honest_trailing(df: DataFrame, entity: str, value: str, width: int) -> DataFrame:
    """Per entity: null unless all ``width`` periods are published; one row per published period."""
    w = Window.partitionBy(entity).orderBy("p").rangeBetween(-(width - 1), 0)
    return df.select(entity, "p", F.when(F.count(value).over(w) == width, F.sum(value).over(w)).alias("total"))


def national_trailing(series: DataFrame, value: str, width: int, known_zero: list[int]) -> DataFrame:
    """One series on its full calendar: only periods known to be zero are filled, other gaps void the windows over them."""
    filled = calendar(series).join(series, "p", "left").withColumn("v", F.when(F.col(value).isNull() & F.col("p").isin(known_zero or [-1]), F.lit(0)).otherwise(F.col(value)))
    w = along().rangeBetween(-(width - 1), 0)
    total = F.when(F.count("v").over(w) == width, F.sum("v").over(w))
    out = filled.withColumn("total", total)
    return out.select("p", F.col("v").alias("value"), "total", yoy("v", width).alias("yoy"), yoy("total", width).alias("total_yoy"))


def yoy(value: str, lag: int):
    """Change against ``lag`` rows before on a gap-free calendar; a zero base gives null."""
    return F.try_divide(F.col(value).cast("double"), F.lag(value, lag).over(along()).cast("double")) - 1


def positional_trailing(series: DataFrame, value: str, width: int) -> DataFrame:
    """By rows, not by calendar: gaps are not seen."""
    rows = along().rowsBetween(-(width - 1), 0)
    return series.select("p", F.col(value).alias("value"), F.when(F.count(value).over(rows) == width, F.sum(value).over(rows)).alias("total"), F.lag(value, width).over(along()).alias("before"))


def step_change(df: DataFrame, entity: str, value: str) -> DataFrame:
    """Difference to the period before; null across a gap."""
    w = Window.partitionBy(entity).orderBy("p")
    return df.select(entity, "p", F.when(F.col("p") - F.lag("p").over(w) == 1, F.col(value) - F.lag(value).over(w)).alias("step"))


def first_seen(df: DataFrame, entity: str) -> DataFrame:
    return df.groupBy(entity).agg(F.min("p").alias("first_p"))


def index_to_base(series: DataFrame, value: str, points: int) -> DataFrame:
    """Last ``points`` known values relative to the first of them, as 100."""
    known = series.where(F.col(value).isNotNull()).orderBy(F.desc("p")).limit(points)
    return known.select("p", (F.col(value).cast("double") / F.first(value).over(along().rowsBetween(Window.unboundedPreceding, 0)) * 100).alias("idx"))


def ranked(df: DataFrame, by: list, key: str, name: str = "rank") -> DataFrame:
    """Rank over the whole (already aggregated) frame; ties go by key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*by, key)))


def fill_down(df: DataFrame, group: str, order: str, value: str, out: str) -> DataFrame:
    """The last value that was given so far in each group."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))


def missing_periods(df: DataFrame) -> DataFrame:
    """Periods inside the observed span in which nothing is observed."""
    return calendar(df).join(df.select("p").distinct(), "p", "left_anti")


def share_windows(df: DataFrame, width: int) -> DataFrame:
    """The latest ``width`` periods and the ``width`` before them: (p, side); missing ones have ``present`` false."""
    last = df.agg(F.max("p").alias("hi")).where("hi IS NOT NULL")
    wanted = last.select(F.explode(F.sequence(F.col("hi") - (2 * width - 1), F.col("hi"))).alias("p"), "hi")
    seen = df.select("p").distinct().withColumn("present", F.lit(True))
    return wanted.join(seen, "p", "left").select("p", F.when(F.col("p") > F.col("hi") - width, "latest").otherwise("previous").alias("side"), F.coalesce("present", F.lit(False)).alias("present"))
