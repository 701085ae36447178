"""Links in pages and messages: extraction, canonical form, candidates and plans."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightloom.functions.text import MONTHS


#: Fixed value: page paths that are named outside of attributes.
BARE_LINK = r"jsp[/a-zA-Z0-9 _%,.()-]+"
ENTITIES = {"&quot;": '"', "&#39;": "'", "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def unescaped(x: Column) -> Column:
    for entity, sign in ENTITIES.items():
        x = F.replace(x, F.lit(entity), F.lit(sign))
    return x


def data_urls(html: Column) -> Column:
    """Distinct links of a page, sorted: ``data-url`` attributes and bare page paths, entities undone."""
    attributes = F.regexp_extract_all(html, F.lit(r"""data-url\s*=\s*["']([^"']+)["']"""), F.lit(1))
    bare = F.regexp_extract_all(html, F.lit(BARE_LINK), F.lit(0))
    links = F.transform(F.concat(attributes, bare), lambda u: F.trim(unescaped(u)))
    return F.array_sort(F.array_distinct(F.filter(links, lambda u: u != "")))


def canonical_url(raw: Column, base: str, replaced: tuple[str, ...] = (), kept: tuple[str, ...] = ()) -> Column:
    """Absolute form of a link: absolute ones stay, a prefix in ``replaced`` gives way to ``base``,
    paths under a folder in ``kept`` are put below it; others have none."""
    u = F.trim(unescaped(raw))
    out = F.when(u.startswith("http"), u)
    for prefix in replaced:
        out = out.when(u.startswith(prefix), F.concat(F.lit(base), F.substr(u, F.lit(len(prefix) + 1))))
    for folder in kept:
        out = out.when(u.startswith(folder), F.concat(F.lit(base + "/"), u))
    return out


def is_workbook(url: Column) -> Column:
    return F.lower(url).rlike(r"\.xlsx?$")


def content_id(url: Column) -> Column:
    """Of a link to a page, the last path segment that is a number of three or more digits."""
    page = F.lower(url).contains("/html") | F.lower(url).endswith(".html")
    parts = F.filter(F.split(url, "/"), lambda s: s.rlike(r"^\d{3,}$"))
    return F.when(page & (F.size(parts) > 0), F.element_at(parts, -1))


def nested_strings(messages: DataFrame, column: str, depth: int = 10) -> DataFrame:
    """All strings inside JSON texts, also inside JSON written in strings: one row each, ``value``."""

    def walk(x, left: int) -> Iterator[str]:
        if isinstance(x, dict):
            x = list(x.values())
        if isinstance(x, list):
            for y in x:
                yield from walk(y, left)
        elif isinstance(x, str):
            inner = None
            if left and x[:1] in "{[" and x:
                try:
                    inner = json.loads(x)
                except ValueError:
                    inner = None
            if inner is None:
                yield x
            else:
                yield from walk(inner, left - 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found: list[str] = []
            for text in pdf["text"]:
                if text:
                    found.extend(walk(text, depth))
            yield pd.DataFrame({"value": pd.Series(found, dtype=object)})

    return messages.select(F.col(column).alias("text")).mapInPandas(run, "value string")


def candidate_names(spark: SparkSession, first: int, last: int, tables: int = 4) -> DataFrame:
    """Names of quarterly tables that may exist: (year, quarter, table_no, name)."""
    years = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year"))
    grid = years.withColumn("quarter", F.explode(F.sequence(F.lit(1), F.lit(4)))).withColumn("table_no", F.explode(F.sequence(F.lit(1), F.lit(tables))))
    return grid.withColumn("name", F.format_string("%02dQ%d_%d.xlsx", F.col("year") % 100, "quarter", "table_no"))


def fallback_periods(files: DataFrame) -> DataFrame:
    """Periods with one of tables 1 to 3 but without table 4, from (year, quarter, table_no)."""
    sets = files.groupBy("year", "quarter").agg(F.collect_set("table_no").alias("have"))
    return sets.where(F.arrays_overlap("have", F.array(F.lit(1), F.lit(2), F.lit(3))) & ~F.array_contains("have", 4)).select("year", "quarter")


def obsolete_fallbacks(fallbacks: DataFrame, workbooks: DataFrame, key: list[str]) -> DataFrame:
    """Fallback files whose workbook has since arrived."""
    return fallbacks.join(workbooks.select(*key).distinct(), key, "left_semi")


def name_variants(name: Column) -> Column:
    """Other spellings under which a monthly file may lie: the month in upper case, and a blank more before it."""
    names = "|".join(sorted(MONTHS, key=lambda m: (-len(m), m)))
    pattern = rf"(?i)^(.*?)\b({names})\b\s*,?\s*(20\d{{2}})(.*)$"
    part = lambda k: F.regexp_extract(name, pattern, k)
    tail = F.concat(F.upper(part(2)), F.lit(" "), part(3), part(4))
    options = F.array(F.concat(part(1), tail), F.concat(part(1), F.lit(" "), tail))
    return F.when(part(2) != "", F.array_distinct(F.filter(options, lambda o: o != name))).otherwise(F.array().cast("array<string>"))
