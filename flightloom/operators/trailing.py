"""Rolling totals over trailing periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightloom.operators.grid import BLOCK, block_calendar, with_blocks


def trailing_totals(activity: DataFrame, entity: list[str], period: str, value: str, windows: tuple[int, ...] = (3, 12), block: int = BLOCK) -> DataFrame:
    """Totals and averages of the trailing periods for every period of each entity's span.

    Result: the entity columns, ``period``, ``value`` (the period's own total),
    and for each window ``w`` ``total_w``, ``avg_w`` (``total_w / w``: the
    denominator is fixed, so idle periods count and so do those before the first)
    and ``active_w`` (periods with activity in the window).

    A null value is no activity, repeated rows of a period add up, a null entity or
    period drops the row, an empty table gives an empty result, and columns not
    named are left out, whatever their names.

    Plan: sparse period totals by one aggregate with map-side combine, calendar rows
    for idle periods, and RANGE frames over integer period numbers.  An entity
    is cut into blocks of periods; each block brings along the ``max(windows) - 1``
    periods before it, so no entity is ordered in a single task.
    """
    reach = max(windows) - 1
    base = activity.select(*entity, F.col(period).cast("long").alias("period"), F.col(value).alias("__v"))
    sparse = base.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*entity, "period"])).groupBy(*entity, "period").agg(F.sum("__v").alias("value"))
    sparse = sparse.where("value IS NOT NULL")
    span = sparse.groupBy(*entity).agg(F.min("period").alias("lo"), F.max("period").alias("hi"))
    calendar = block_calendar(span, entity, "period", block).select(*entity, "period", "__b", F.lit(None).cast(sparse.schema["value"].dataType).alias("value"), F.lit(True).alias("__day"))
    placed = with_blocks(sparse, "period", reach, block).select(*entity, "period", "__b", "value", F.lit(False).alias("__day"))
    # a calendar row and the activity of its period are peers in every RANGE frame, so
    # they need not be joined: frames are read off the calendar rows
    rows = placed.unionByName(calendar)
    out = rows
    for w in windows:
        frame = Window.partitionBy(*entity, "__b").orderBy("period").rangeBetween(-(w - 1), 0)
        out = out.withColumn(f"total_{w}", F.coalesce(F.sum("value").over(frame), F.lit(0))).withColumn(f"active_{w}", F.count("value").over(frame).cast("int"))
    own = F.sum("value").over(Window.partitionBy(*entity, "__b").orderBy("period").rangeBetween(0, 0))
    days = out.withColumn("value", F.coalesce(own, F.lit(0))).where("__day")
    cols = [c for w in windows for c in (F.col(f"total_{w}"), (F.col(f"total_{w}") / F.lit(float(w))).alias(f"avg_{w}"), F.col(f"active_{w}"))]
    return days.select(*entity, "period", "value", *cols)
