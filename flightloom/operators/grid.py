"""Irregular readings onto a regular grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Periods per block.  A source is cut into blocks of this many periods, each
#: of which is ordered in a task of its own; a block brings along the readings of the
#: periods before it that can still reach into it.
BLOCK = 4096


def with_blocks(df: DataFrame, period: str, reach: int, block: int = BLOCK) -> DataFrame:
    """Rows with their block ``__b`` and, as ``__halo``, copies for later blocks they reach."""
    own = F.floor(F.col(period) / F.lit(block)).cast("long")
    last = F.floor((F.col(period) + F.lit(reach)) / F.lit(block)).cast("long")
    return df.withColumn("__b", F.explode(F.sequence(own, last))).withColumn("__halo", F.col("__b") != own)


def block_calendar(span: DataFrame, keys: list[str], period: str, block: int = BLOCK) -> DataFrame:
    """All periods between ``lo`` and ``hi`` of each key, with their block; no row holds more than a block."""
    number = lambda c: F.floor(F.col(c) / F.lit(block)).cast("long")
    blocks = span.select(*keys, "lo", "hi", F.explode(F.sequence(number("lo"), number("hi"))).alias("__b"))
    first = F.greatest(F.col("lo").cast("long"), F.col("__b") * block)
    final = F.least(F.col("hi").cast("long"), F.col("__b") * block + (block - 1))
    return blocks.select(*keys, "__b", F.explode(F.sequence(first, final)).alias(period))


def regular_grid(readings: DataFrame, source: str | Column, period: str | Column, value: str | Column, order: str | Column | None = None, max_gap: int = 2, block: int = BLOCK) -> DataFrame:
    """One row per source and period from its first to its last reading.

    Result: ``source, period, reading, n_readings, value, age, status``.  ``reading``
    is the bucket's reading (the latest by ``order``; ties go to the larger value),
    ``value`` the reading or, for up to ``max_gap`` periods after it, the last
    observation carried forward; ``status`` is ``observed``, ``carried`` or ``missing``.

    Rows without source, period or value are no readings; repeated rows count once
    as a reading and are counted in ``n_readings``; an empty table gives an empty
    grid; other columns of the input, whatever their names, are left out.

    Plan: one aggregate with map-side combine, a per-source calendar made from the
    spans, a left join of both, and a window per source *and block*, so that a
    source with a third of all rows is spread over as many tasks as it has blocks.
    """
    one = lambda x: F.col(x) if isinstance(x, str) else x
    base = readings.select(one(source).alias("source"), one(period).cast("long").alias("period"), one(value).alias("__v"), (one(order) if order is not None else F.lit(0)).alias("__o"))
    buckets = (
        base.where("source IS NOT NULL AND period IS NOT NULL AND __v IS NOT NULL")
        .groupBy("source", "period")
        .agg(F.max_by("__v", F.struct("__o", "__v")).alias("reading"), F.count(F.lit(1)).alias("n_readings"))
    )
    span = buckets.groupBy("source").agg(F.min("period").alias("lo"), F.max("period").alias("hi"))
    placed = with_blocks(buckets, "period", max_gap, block)
    own = placed.where(~F.col("__halo")).select("source", "__b", "period", "reading", "n_readings")
    grid = block_calendar(span, ["source"], "period", block).join(own, ["source", "__b", "period"], "left").withColumn("__halo", F.lit(False))
    halo = placed.where("__halo").select("source", "__b", "period", "reading", "n_readings", "__halo")
    past = Window.partitionBy("source", "__b").orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = F.last(F.when(F.col("reading").isNotNull(), F.struct("period", "reading")), ignorenulls=True).over(past)
    age = (F.col("period") - F.col("__seen.period")).cast("int")
    filled = grid.unionByName(halo).withColumn("__seen", seen).where(~F.col("__halo"))
    near = F.col("__seen").isNotNull() & (age <= max_gap)
    return filled.select(
        "source",
        "period",
        "reading",
        F.coalesce("n_readings", F.lit(0)).alias("n_readings"),
        F.when(near, F.col("__seen.reading")).alias("value"),
        F.when(near, age).alias("age"),
        F.when(F.col("reading").isNotNull(), "observed").when(near, "carried").otherwise("missing").alias("status"),
    )
