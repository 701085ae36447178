"""Sinks for published tables: parquet inside, CSV and JSON as exports."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.sources.tables import SPECS


def write_csv(df: DataFrame, path: str, decimals: int = 3) -> None:
    """CSV with a header and doubles at a fixed number of decimals."""
    fixed = {f.name: F.col(f.name).cast(f"decimal(28,{decimals})") for f in df.schema.fields if f.dataType.simpleString() in ("double", "float")}
    df.withColumns(fixed).write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, name: str) -> None:
    """A declared table as parquet: exactly its columns, in order and type."""
    spec = SPECS[name]
    df.select(*(F.col(c).cast(t).alias(c) for c, t in spec.columns)).write.mode("overwrite").parquet(path)


def table_metadata(tables: dict[str, DataFrame]) -> dict:
    """Rows, columns and version of each published table; one count per table."""
    return {n: {"rows": df.count(), "columns": df.columns, "version": SPECS[n].version if n in SPECS else None} for n, df in sorted(tables.items())}


def write_json(data: dict, path: str) -> None:
    """JSON with sorted keys, written under another name and renamed, so readers never see half a file."""
    target = Path(path)
    part = target.with_name(target.name + ".tmp")
    part.write_text(json.dumps(data, indent=2, sort_keys=True, default=str))
    part.replace(target)


def summary_row(df: DataFrame) -> dict:
    """A frame of one row as a dictionary; empty if there is none."""
    row = df.limit(1).collect()
    return row[0].asDict(recursive=True) if row else {}
