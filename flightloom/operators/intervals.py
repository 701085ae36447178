"""Overlapping and gapped time intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Stands for an open start and an open end.
OPEN_LO, OPEN_HI = 0, 99_999
#: Time points per block of the sweep.
BLOCK = 4096


def coverage_spans(intervals: DataFrame, entity: str | Column, lo: str | Column, hi: str | Column, open_lo: int = OPEN_LO, open_hi: int = OPEN_HI, block: int = BLOCK) -> DataFrame:
    """Continuous periods of each entity and the gaps between them.

    Result: ``entity, span_kind (period or gap), lo, hi``, both ends inclusive.
    Intervals are whole numbers with inclusive ends; those that touch at the next
    number form one period.  A null end is open and stands at ``open_lo`` or
    ``open_hi``; an interval that ends before it begins covers nothing; nested,
    overlapping and repeated ones count once; a null entity drops the row.

    Sweep line: every interval gives +1 at its start and -1 after its end.  Events
    of one point are added up before the shuffle, so an entity with a third of
    all intervals sends at most its distinct points.  The prefix sum runs in two
    steps, within blocks of time and over the blocks' totals, and so does the
    search for the next boundary; no entity is swept in one task.
    """
    one = lambda x: F.col(x) if isinstance(x, str) else x
    base = intervals.select(one(entity).alias("entity"), F.coalesce(one(lo).cast("long"), F.lit(open_lo)).alias("lo"), F.coalesce(one(hi).cast("long"), F.lit(open_hi)).alias("hi"))
    base = base.where("entity IS NOT NULL AND lo <= hi")
    events = base.select("entity", F.explode(F.array(F.struct(F.col("lo").alias("t"), F.lit(1).alias("d")), F.struct((F.col("hi") + 1).alias("t"), F.lit(-1).alias("d")))).alias("e"))
    points = events.groupBy("entity", F.col("e.t").alias("t")).agg(F.sum("e.d").alias("d")).where("d <> 0")
    points = points.withColumn("b", F.floor(F.col("t") / F.lit(block)))
    inner = Window.partitionBy("entity", "b").orderBy("t")
    blocks = points.groupBy("entity", "b").agg(F.sum("d").alias("total"))
    over = Window.partitionBy("entity").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("entity", "b", F.coalesce(F.sum("total").over(over), F.lit(0)).alias("offset"))
    active = points.join(offsets, ["entity", "b"]).withColumn("after", F.col("offset") + F.sum("d").over(inner.rowsBetween(Window.unboundedPreceding, 0)))
    # where the count leaves or reaches zero; starts and ends alternate
    turns = active.where((F.col("after") == 0) | (F.col("after") == F.col("d"))).select("entity", "b", "t", (F.col("after") > 0).alias("starts"))
    firsts = turns.groupBy("entity", "b").agg(F.min("t").alias("first"))
    ahead = firsts.select("entity", "b", F.lead("first").over(Window.partitionBy("entity").orderBy("b")).alias("beyond"))
    paired = turns.join(ahead, ["entity", "b"]).withColumn("next", F.coalesce(F.lead("t").over(inner), F.col("beyond")))
    return paired.where("next IS NOT NULL").select("entity", F.when(F.col("starts"), "period").otherwise("gap").alias("span_kind"), F.col("t").cast("int").alias("lo"), (F.col("next") - 1).cast("int").alias("hi"))
