"""Month and quarter ordinals.

A month ordinal is ``year * 12 + month - 1`` and a quarter ordinal
``year * 4 + quarter - 1``; both are plain integers, so that RANGE frames and
``sequence`` are exact on the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def full_year(year: Column | str) -> Column:
    """Years written with two digits belong to this century; others stay."""
    year = F.col(year) if isinstance(year, str) else year
    return F.when(year.between(0, 99), year + 2000).otherwise(year).cast("int")


def month_ordinal(year: Column | str, month: Column | str) -> Column:
    month = F.col(month) if isinstance(month, str) else month
    return (full_year(year) * 12 + month - 1).cast("int")


def quarter_ordinal(year: Column | str, quarter: Column | str) -> Column:
    quarter = F.col(quarter) if isinstance(quarter, str) else quarter
    return (full_year(year) * 4 + quarter - 1).cast("int")


def ordinal_year(p: Column | str, per_year: int = 12) -> Column:
    p = F.col(p) if isinstance(p, str) else p
    return F.floor(p / F.lit(per_year)).cast("int")


def ordinal_month(p: Column | str, per_year: int = 12) -> Column:
    p = F.col(p) if isinstance(p, str) else p
    return (F.pmod(p, F.lit(per_year)) + 1).cast("int")


def month_label(p: Column | str) -> Column:
    """``Mon YYYY``."""
    return F.date_format(F.make_date(ordinal_year(p), ordinal_month(p), F.lit(1)), "MMM yyyy")


def quarter_label(q: Column | str) -> Column:
    """``YYYYQn``."""
    return F.concat(ordinal_year(q, 4).cast("string"), F.lit("Q"), ordinal_month(q, 4).cast("string"))


def parse_year_month(text: Column | str) -> Column:
    """``YYYY-MM`` to a month ordinal; null or anything else gives null (an open bound)."""
    text = F.col(text) if isinstance(text, str) else text
    y = F.regexp_extract(text, r"^(\d{4})-(\d{2})$", 1)
    m = F.regexp_extract(text, r"^(\d{4})-(\d{2})$", 2)
    return F.when(y != "", (y.try_cast("int") * 12 + m.try_cast("int") - 1)).cast("int")


def calendar(df: DataFrame, period: str = "p") -> DataFrame:
    """Every period between the first and the last one present in ``df``."""
    span = df.agg(F.min(period).alias("lo"), F.max(period).alias("hi")).where("lo is not null")
    return span.select(F.explode(F.sequence("lo", "hi")).alias(period))
