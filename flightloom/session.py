"""Session helpers that hold on a laptop and on a cluster alike."""

from __future__ import annotations

import atexit
import hashlib
import io
import shutil
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def shared_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    A cluster names a folder that all executors share in ``spark.checkpoint.dir``;
    it is used as it is.  Only where the setting is absent and all executors run on
    this machine (tests) is a folder of our own made; a cluster without one is an error.
    """
    context = spark.sparkContext
    named = context.getConf().get(CHECKPOINT_KEY, None) or spark.conf.get(CHECKPOINT_KEY, None)
    current = context._jsc.sc().getCheckpointDir()
    if named:
        if not current.isDefined():
            context.setCheckpointDir(named)
        return named
    if current.isDefined():
        return current.get()
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="flightloom-checkpoint-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    context.setCheckpointDir(own)
    return own


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there afterwards."""
    shared_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per context.

    Functions that run in Python workers are found there by their module, which need not be installed on
    the executors.  The archive is served by the driver and named by its content.
    """
    context = spark.sparkContext
    if getattr(context, "_flightloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.writestr(zipfile.ZipInfo(str(path.relative_to(root.parent))), path.read_bytes())
    name = f"{root.name}-{hashlib.sha256(data.getvalue()).hexdigest()[:16]}.zip"
    target = Path(tempfile.mkdtemp(prefix=f"{root.name}-")) / name
    target.write_bytes(data.getvalue())
    context.addPyFile(str(target))
    context._flightloom_shipped = True


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``query`` on a session whose executors have this package."""

    @wraps(query)
    def run(spark: SparkSession, root: str) -> DataFrame:
        ship_package(spark)
        return query(spark, root)

    return run
