"""Fingerprints of source files, and what changed between two manifests."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def source_type(name: Column) -> Column:
    return F.when(F.lower(name).endswith(".pdf"), "pdf").otherwise("excel")


def fingerprint_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(source, source_type, content_length, md5, sha256) of every file below a folder; temporary files are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    kept = files.where(~F.col("path").endswith(".tmp"))
    return kept.select(name.alias("source"), source_type(name).alias("source_type"), F.col("length").alias("content_length"), F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256"))


def diff_manifests(old: DataFrame, new: DataFrame) -> DataFrame:
    """(source, change) with change added, removed or changed."""
    a, b = old.select("source", F.col("sha256").alias("__a")), new.select("source", F.col("sha256").alias("__b"))
    kind = F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed").when(F.col("__a") != F.col("__b"), "changed")
    return a.join(b, "source", "full").withColumn("change", kind).where("change IS NOT NULL").select("source", "change")


def is_unchanged(old: DataFrame, new: DataFrame) -> bool:
    return old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty()


def head_change(etag_old: Column, etag_new: Column, length_old: Column, length_new: Column) -> Column:
    """Verdict of a header comparison: an equal tag or an equal length is unchanged, no tag and no length unknown."""
    same = lambda a, b: F.coalesce(a == b, F.lit(False))
    tag = F.when(F.trim(F.replace(etag_new, F.lit('"'), F.lit(""))) != "", F.replace(etag_new, F.lit('"'), F.lit("")))
    return F.when(same(tag, etag_old) | same(length_new, length_old), "unchanged").when(tag.isNull() & length_new.isNull(), "unknown").otherwise("changed")


def combined_fingerprint(paths: dict[str, bytes]) -> str:
    """One hash over the sorted names and hashes of small driver-side inputs."""
    h = hashlib.sha256()
    for name in sorted(paths):
        h.update(name.encode() + b"\0" + hashlib.sha256(paths[name]).hexdigest().encode() + b"\0")
    return h.hexdigest()
