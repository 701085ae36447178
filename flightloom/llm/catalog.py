"""Queries on texts, and SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom.llm import leakage, mixing, pii
from flightloom.sources.tables import read_table


def p8_found(spark: SparkSession, root: str) -> DataFrame:
    return leakage.leaked_items(read_table(spark, root, "documents"), read_table(spark, root, "eval_items"))


def p8_items(spark: SparkSession, root: str) -> DataFrame:
    """Which items leaked, and into how many documents."""
    return p8_found(spark, root).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_documents"))


def _mix(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    return mixing.mixture(read_table(spark, root, "documents"), read_table(spark, root, "mix_targets"))


def p9_mixture(spark: SparkSession, root: str) -> DataFrame:
    return _mix(spark, root)[0]


def p9_shares(spark: SparkSession, root: str) -> DataFrame:
    return _mix(spark, root)[1]


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    return pii.personal_details(read_table(spark, root, "documents"))


def p10_texts(spark: SparkSession, root: str) -> DataFrame:
    return pii.sanitised(read_table(spark, root, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (p8_found, p8_items, p9_mixture, p9_shares, p10_found, p10_texts)}


def oracle_sql() -> dict[str, str]:
    return {}
