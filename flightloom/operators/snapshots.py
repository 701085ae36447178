"""What changed between full snapshots of a table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightloom.session import cut_lineage

#: Rows of compact hashes (40 bytes each) that a bucket should hold.
ROWS_PER_BUCKET = 1_000_000

_KEYS = "__at int, __k1 long, __k2 long, __kind string"


def _bucket_differences(pdf: pd.DataFrame) -> pd.DataFrame:
    """Differing keys of one hash bucket; ``__at`` counts the snapshots from 1 to ``__last``."""
    keys = np.empty(len(pdf), dtype=[("a", "<i8"), ("b", "<i8")])
    keys["a"], keys["b"] = pdf["__k1"].to_numpy(), pdf["__k2"].to_numpy()
    distinct, ids = np.unique(keys, return_inverse=True)
    at, rows, last = pdf["__at"].to_numpy(), pdf["__rh"].to_numpy(), int(pdf["__last"].iloc[0])
    order = np.lexsort((rows, ids, at))
    ids, at, rows = ids[order], at[order], rows[order]
    # several different rows of one key in one snapshot fold into one hash
    first = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (at[1:] != at[:-1])])
    ids, at, rows = ids[first], at[first], np.bitwise_xor.reduceat(rows, first)
    found: list[tuple[int, np.ndarray, str]] = []
    # only snapshots with rows here, and those after them, can differ
    here = np.unique(at)
    for k in np.unique(np.r_[here, here + 1]).tolist():
        if not 2 <= k <= last:
            continue
        cut = np.searchsorted(at, [k - 1, k, k + 1])
        old, new = slice(cut[0], cut[1]), slice(cut[1], cut[2])
        a, b = ids[old], ids[new]
        to = np.searchsorted(a, b)
        inside = to < len(a)
        same = np.zeros(len(b), dtype=bool)
        same[inside] = a[to[inside]] == b[inside]
        back = np.searchsorted(b, a)
        kept = np.zeros(len(a), dtype=bool)
        ok = back < len(b)
        kept[ok] = b[back[ok]] == a[ok]
        changed = np.flatnonzero(same)[rows[new][same] != rows[old][to[same]]]
        found += [(k, b[~same], "added"), (k, a[~kept], "removed"), (k, b[changed], "changed")]
    parts = [pd.DataFrame({"__at": k, "__k1": distinct["a"][i], "__k2": distinct["b"][i], "__kind": kind}) for k, i, kind in found if len(i)]
    if not parts:
        return pd.DataFrame({"__at": pd.Series(dtype="int32"), "__k1": pd.Series(dtype="int64"), "__k2": pd.Series(dtype="int64"), "__kind": pd.Series(dtype=str)})
    return pd.concat(parts).astype({"__at": "int32"})


def snapshot_changes(snapshots: DataFrame, number: str, key: dict[str, Column], shown: dict[str, Column], measures: list[Column], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Records added, removed or changed from each snapshot to the next.

    ``key`` names the columns by which records are compared, ``shown`` the form in
    which keys and values are reported, ``measures`` the values that count as
    the record.  Result: ``snapshot_no`` (the later one), ``change_kind``,
    the ``shown`` columns, ``before`` and ``after`` (the measures as arrays of text).

    Rows without a snapshot number are left out; a null in a key or measure is a value
    of its own; repeated rows count once; if a snapshot holds several different
    rows of one key, they are compared as a set and the least one is shown; one
    snapshot or none gives no change.  Columns not named are left out.

    Rows shrink to a 128-bit key hash and a 64-bit row hash, duplicates fold before
    the shuffle, and hash buckets are compared by sorting and ``searchsorted``.
    Full values are fetched only for the keys that differ, where an exact comparison
    of the values confirms each change.
    """
    text = lambda c: F.coalesce(c.cast("string"), F.lit("\x00"))
    joined = lambda cs: F.concat_ws("\x1f", *(text(c) for c in cs))
    rows = snapshots.select(
        F.col(number).cast("int").alias("__sno"),
        joined(key.values()).alias("__key"),
        F.array(*(c.cast("string") for c in measures)).alias("__m"),
        *(c.alias(n) for n, c in shown.items()),
    ).where("__sno IS NOT NULL")
    rows = rows.withColumn("__k1", F.xxhash64("__key")).withColumn("__k2", F.xxhash64(F.lit("second"), F.reverse("__key")))
    flat = F.concat_ws("\x1f", F.transform("__m", lambda x: F.coalesce(x, F.lit("\x00"))))
    compact = rows.select("__sno", "__k1", "__k2", F.xxhash64(flat).alias("__rh")).distinct()
    # one row per snapshot: its place among them, the number before it, and its rows
    per_snapshot = rows.groupBy("__sno").agg(F.count(F.lit(1)).alias("__n"))
    steps = per_snapshot.select("__sno", "__n", F.row_number().over(Window.orderBy("__sno")).alias("__at"), F.lag("__sno").over(Window.orderBy("__sno")).alias("__old"), F.count(F.lit(1)).over(Window.partitionBy()).cast("int").alias("__last"))
    steps = cut_lineage(steps)
    n_rows = steps.agg(F.sum("__n")).first()[0] or 0
    partitions = int(snapshots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, n_rows // rows_per_bucket + 1)
    placed = compact.join(steps.select("__sno", "__at", "__last"), "__sno").drop("__sno")
    differing = placed.groupBy(F.pmod("__k1", F.lit(buckets)).alias("__bucket")).applyInPandas(_bucket_differences, _KEYS)
    differing = differing.join(steps.select("__at", "__sno", "__old"), "__at").drop("__at")
    wanted = differing.select("__k1", "__k2", "__kind", F.col("__sno").alias("__new"), "__old", F.explode(F.array("__sno", "__old")).alias("__sno"))
    full = rows.join(wanted, ["__k1", "__k2", "__sno"])
    side = lambda which: F.array_sort(F.collect_set(F.when(F.col("__sno") == F.col(which), F.col("__m"))))
    per_key = full.groupBy("__new", "__kind", "__key").agg(
        side("__old").alias("__before"),
        side("__new").alias("__after"),
        *(F.coalesce(F.min(F.when(F.col("__sno") == F.col("__new"), F.col(n))), F.min(n)).alias(n) for n in shown),
    )
    exact = (
        F.when(F.size("__before") == 0, "added")
        .when(F.size("__after") == 0, "removed")
        .when(F.col("__before") != F.col("__after"), "changed")
    )
    checked = per_key.withColumn("change_kind", exact).where("change_kind IS NOT NULL")
    first = lambda c: F.when(F.size(c) > 0, F.element_at(c, 1))
    return checked.select(F.col("__new").alias("snapshot_no"), "change_kind", *shown, first("__before").alias("before"), first("__after").alias("after"))


def to_thousandths(x: str) -> Column:
    """Doubles at three decimals, as an exact whole number of thousandths."""
    return F.round(F.col(x) * 1000).cast("long")


