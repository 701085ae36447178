"""Deliveries as a stream: late and restated rows are merged, and every change is logged.

Publishing is by restatement, so a delivery is a micro-batch that is compared with what was
published before; event-time windows would drop exactly the late rows that matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom.quality import revisions
from flightloom.sources.tables import rows_that_count


def merge_delivery(published: DataFrame | None, delivery: DataFrame, key: list[str], values: list[str], order: str) -> DataFrame:
    """The published rows after a delivery: of each key the row delivered last."""
    fresh = delivery.select(*key, *values, order)
    both = fresh if published is None else published.select(*key, *values, order).unionByName(fresh)
    return rows_that_count(both, key, [*values, order], order)


def run_deliveries(spark: SparkSession, stream: DataFrame, folder: str, checkpoint: str, key: list[str], values: list[str], order: str = "loaded_at"):
    """Start a query that merges each micro-batch into ``folder/version=n`` and logs its changes to ``folder/changes``.

    A batch writes a version of its own from the version before it, so a batch that is run
    again after a failure writes the same files again.  A new checkpoint over a folder that holds versions is
    refused, as it would begin them anew.
    """
    context = spark.sparkContext
    exists = lambda path: context._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(context._jsc.hadoopConfiguration()).exists(context._jvm.org.apache.hadoop.fs.Path(path))
    if exists(f"{folder}/version=0") and not exists(f"{checkpoint}/offsets"):
        raise ValueError(f"{folder} holds versions that {checkpoint} does not know")

    def publish(delivery: DataFrame, batch: int) -> None:
        before = None if batch == 0 else spark.read.parquet(f"{folder}/version={batch - 1}")
        after = merge_delivery(before, delivery, key, values, order)
        after.write.mode("overwrite").parquet(f"{folder}/version={batch}")
        after = spark.read.parquet(f"{folder}/version={batch}")
        old = after.limit(0) if before is None else before
        every = [revisions.changes(old, after, key, v).withColumn("measure", F.lit(v)) for v in values]
        changed = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), every).withColumn("batch", F.lit(batch))
        changed.write.mode("overwrite").parquet(f"{folder}/changes/batch={batch}")

    return stream.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
