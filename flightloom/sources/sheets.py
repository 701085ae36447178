"""Semi-structured sheet rows (file, sheet_idx, row_idx, cells) to typed rows."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightloom.functions.text import clean_key, month_number, service_of_text, tolerant_number
from flightloom.operators.windows import fill_down

#: Fixed value: the metrics of a carrier sheet in the order of its cells after the month.
CARRIER_CELLS = (
    "aircraft_number", "aircraft_hours", "aircraft_km", "passengers", "passenger_km", "seat_km", "passenger_load_factor", "freight_tonnes", "mail_tonnes", "cargo_tonnes",
    "passenger_tonne_km", "freight_tonne_km", "mail_tonne_km", "total_tonne_km", "available_tonne_km", "weight_load_factor",
)
#: Least number of cells of a row in each of the international tables.
TABLE_WIDTH = {1: 6, 2: 14, 3: 6, 4: 7}


def row_text(cells: str | Column = "cells") -> Column:
    """All cells of a row as one key text."""
    cells = F.col(cells) if isinstance(cells, str) else cells
    return clean_key(F.array_join(cells, " ", ""))


def header_rows(rows: DataFrame, terms: list[str]) -> DataFrame:
    """(file, sheet_idx, header_idx, header): the first row of each sheet whose text holds all terms."""
    has = F.lit(True)
    for t in terms:
        has = has & row_text().contains(t.upper())
    return rows.where(has).groupBy("file", "sheet_idx").agg(F.min("row_idx").alias("header_idx"), F.min_by("cells", "row_idx").alias("header"))


def column_position(header: Column, *terms: str) -> Column:
    """Position of the first header cell that holds all terms; null if none does."""
    has = lambda c: reduce(lambda a, b: a & b, (clean_key(c).contains(t.upper()) for t in terms))
    marked = F.transform(header, lambda c, i: F.when(has(c), i))
    return F.array_min(F.array_compact(marked))


def city_pairs(rows: DataFrame) -> DataFrame:
    """City pairs of domestic sheets: (file, row_idx, city1, city2, to_pax, from_pax, freight and mail either way).

    Below the header row; without blank cities, totals, and rows in which either number of passengers
    cannot be read; freight and mail are 0 where a sheet has no such column; of a file the first sheet that
    yields rows counts.
    """
    heads = header_rows(rows, ["TO CITY", "FROM CITY"])
    body = rows.join(heads, ["file", "sheet_idx"]).where("row_idx > header_idx")
    header = F.col("header")
    cell = lambda *terms: F.get("cells", column_position(header, *terms))
    optional = lambda *terms: F.when(column_position(header, *terms).isNull(), F.lit(0.0)).otherwise(tolerant_number(cell(*terms)))
    out = body.select(
        "file", "sheet_idx", "row_idx", clean_key(cell("CITY", "1")).alias("city1"), clean_key(cell("CITY", "2")).alias("city2"),
        tolerant_number(cell("PASSENGER", "TO")).alias("to_pax"), tolerant_number(cell("PASSENGER", "FROM")).alias("from_pax"),
        optional("FREIGHT", "TO").alias("freight_to"), optional("FREIGHT", "FROM").alias("freight_from"), optional("MAIL", "TO").alias("mail_to"), optional("MAIL", "FROM").alias("mail_from"),
    )
    good = out.where("city1 <> '' AND city2 <> '' AND NOT contains(city1, 'TOTAL') AND to_pax IS NOT NULL AND from_pax IS NOT NULL")
    firsts = good.groupBy("file").agg(F.min("sheet_idx").alias("sheet_idx"))
    return good.join(firsts, ["file", "sheet_idx"], "left_semi").drop("sheet_idx")


def carrier_rows(rows: DataFrame) -> DataFrame:
    """Carrier sheets: section headers name the service type of the rows below them.

    A row with a month in any cell is a data row; the 16 cells after it are its metrics, with the
    names of :data:`CARRIER_CELLS`.  Rows before any section or without passengers are dropped.
    """
    month_at = F.array_min(F.array_compact(F.transform("cells", lambda c, i: F.when(month_number(c).isNotNull(), i))))
    marked = rows.withColumn("month_at", month_at).withColumn("section", service_of_text(row_text()))
    filled = fill_down(marked, "file", "row_idx", "section", "service_type")
    data = filled.where("section IS NULL AND month_at IS NOT NULL AND service_type IS NOT NULL")
    values = [tolerant_number(F.get("cells", F.col("month_at") + 1 + k)).alias(n) for k, n in enumerate(CARRIER_CELLS)]
    return data.select("file", "row_idx", "service_type", month_number(F.get("cells", F.col("month_at"))).alias("month"), *values).where("passengers IS NOT NULL")


def numbered_rows(rows: DataFrame, table_no: int) -> DataFrame:
    """Rows of an international table: wide enough, with a numeric serial in front, without totals; (file, row_idx, serial, rest)."""
    wide = rows.where(F.size("cells") >= TABLE_WIDTH[table_no])
    serial = F.trim(F.get("cells", F.lit(0))).try_cast("double")
    return wide.withColumn("serial", serial).where(F.col("serial").isNotNull() & ~row_text().contains("TOTAL")).select("file", "row_idx", F.col("serial").cast("int").alias("serial"), F.slice("cells", 2, 50).alias("rest"))


def either_side_pairs(rows: DataFrame) -> DataFrame:
    """Positional reader of city rows for the label gate: two rows per sheet row, (label, year, month, passengers).

    Rows of fewer than six cells are skipped, two-digit years belong to this century, and if either
    side cannot be read the whole row counts 0.
    """
    cell = lambda k: F.get("cells", F.lit(k))
    year = F.trim(cell(0)).try_cast("int")
    both = F.coalesce(F.trim(cell(4)).try_cast("double") + F.trim(cell(5)).try_cast("double"), F.lit(0.0))
    wide = rows.where(F.size("cells") >= 6).withColumn("year", F.when(year < 100, year + 2000).otherwise(year)).withColumn("month", F.trim(cell(1)).try_cast("int")).withColumn("passengers", both)
    return wide.select("year", "month", "passengers", F.explode(F.array(cell(2), cell(3))).alias("label")).where("label IS NOT NULL AND trim(label) <> ''")


def cluster_tokens(tokens: DataFrame, near: float = 1.2) -> DataFrame:
    """Positioned tokens (page, y0, x0, text) put into rows: (page, row_no, y0, text).

    Tokens go by falling height; one joins the current row if it is within ``near`` of the row's
    *first* token, which depends on where that row began and so needs the tokens of a page in
    order.  A page is a bounded group: what fits on a sheet of paper.
    """

    def rows(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["y0", "x0"], ascending=[False, True], kind="stable")
        y = pdf["y0"].to_numpy()
        row, numbers, start = -1, np.empty(len(y), dtype="int32"), np.inf
        for i, v in enumerate(y):
            if start - v > near or row < 0:
                row, start = row + 1, v
            numbers[i] = row
        pdf = pdf.assign(row_no=numbers)
        out = pdf.sort_values(["row_no", "x0"], kind="stable").groupby("row_no", sort=True).agg(page=("page", "first"), y0=("y0", "max"), text=("text", " ".join)).reset_index()
        return out[["page", "row_no", "y0", "text"]]

    known = tokens.where("page IS NOT NULL AND y0 IS NOT NULL").select(F.col("page").cast("long").alias("page"), F.col("y0").cast("double").alias("y0"), F.col("x0").cast("double").alias("x0"), F.coalesce("text", F.lit("")).alias("text"))
    return known.groupBy("page").applyInPandas(rows, "page long, row_no int, y0 double, text string")
