"""Text and number normalisation as column expressions; none of them throws on junk."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names and abbreviations, with the misspellings that occur.
MONTHS = {
    "JANUARY": 1, "JAN": 1, "FEBRUARY": 2, "FEB": 2, "FEBURUARY": 2, "MARCH": 3, "MAR": 3, "APRIL": 4, "APR": 4, "MAY": 5, "JUNE": 6, "JUN": 6,
    "JULY": 7, "JUL": 7, "AUGUST": 8, "AUG": 8, "SEPTEMBER": 9, "SEP": 9, "SEPT": 9, "OCTOBER": 10, "OCT": 10, "NOVEMBER": 11, "NOV": 11, "DECEMBER": 12, "DEC": 12,
}


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_text(x: Column | str) -> Column:
    """White space collapsed and trimmed; null becomes the empty text."""
    return F.coalesce(F.trim(F.regexp_replace(col(x), r"\s+", " ")), F.lit(""))


#: Fixed value: a misspelling in headers, and what it stands for.
HEADER_TYPO = ("PASSENEGER", "PASSENGER")


def clean_key(x: Column | str) -> Column:
    """Upper case, everything but letters and digits one blank, the known misspelling mended."""
    return F.replace(F.trim(F.regexp_replace(F.upper(clean_text(x)), r"[^A-Z0-9]+", " ")), *map(F.lit, HEADER_TYPO))


def label_form(x: Column | str) -> Column:
    """Form in which labels are compared: upper case, single blanks."""
    return F.upper(F.trim(F.regexp_replace(col(x), r"\s+", " ")))


def tolerant_number(x: Column | str) -> Column:
    """Commas are dropped; blank and ``-`` are 0; null and junk are null."""
    t = F.replace(F.trim(col(x)), F.lit(","), F.lit(""))
    return F.when(t.isin("", "-"), F.lit(0.0)).otherwise(t.try_cast("double"))


def source_number(x: Column | str) -> Column:
    """As :func:`tolerant_number`, null is 0."""
    return F.coalesce(tolerant_number(x), F.lit(0.0))


def month_number(x: Column | str) -> Column:
    """Month of a full, abbreviated or misspelt name; null if there is none."""
    table = F.create_map(*(F.lit(v) for pair in MONTHS.items() for v in pair))
    return F.try_element_at(table, clean_key(x)).cast("int")


def title_label(x: Column | str, known: dict[str, str] | None = None) -> Column:
    """Label of an airline file: digits, ``%20``, ``_`` and ``-`` out, then the known spelling or title case."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(col(x), "%20|[_-]", " "), "[0-9]", ""), r"\s+", " "))
    fallback = F.initcap(plain)
    if not known:
        return fallback
    table = F.create_map(*(F.lit(v) for k, n in known.items() for v in (k.lower(), n)))
    return F.coalesce(F.try_element_at(table, F.lower(plain)), fallback)


def stem_year(x: Column | str) -> Column:
    """2000 plus the last group of two digits in a file name's stem."""
    stem = F.regexp_replace(col(x), r"\.[A-Za-z]+$", "")
    found = F.regexp_extract(stem, r"(\d{2})(?!.*\d)", 1)
    return F.when(found != "", found.try_cast("int") + 2000)


def name_period(x: Column | str) -> Column:
    """Month and year named in a file name, the longest month name first; split ``APR IL`` is mended.

    Struct of year and month; null unless a month is followed by a year of this century.
    """
    text = F.regexp_replace(F.regexp_replace(F.upper(col(x)), "%20", " "), r"\bAPR\s+IL\b", "APRIL")
    names = "|".join(sorted(MONTHS, key=lambda m: (-len(m), m)))
    part = lambda k: F.regexp_extract(text, rf"\b({names})\b\s*,?\s*(20\d{{2}})", k)
    return F.when(part(1) != "", F.struct(part(2).try_cast("int").alias("year"), month_number(part(1)).alias("month")))


def quarter_file(x: Column | str) -> Column:
    """``YYQn_t`` in a file name: struct of year, quarter and table, null if absent."""
    part = lambda k: F.regexp_extract(col(x), r"(\d{2})Q([1-4])_(\d)", k).try_cast("int")
    return F.when(part(1).isNotNull(), F.struct((part(1) + 2000).alias("year"), part(2).alias("quarter"), part(3).alias("table_no")))


def service_of_text(x: Column | str) -> Column:
    """Service type named by the key words of a section header; null if it names none."""
    t = clean_key(x)
    side = F.when(t.contains("DOMESTIC"), "domestic").when(t.contains("INTERNATIONAL"), "international")
    return F.when(t.contains("SERVICE") & side.isNotNull(), F.concat(F.when(t.contains("NON"), "nonscheduled_").otherwise("scheduled_"), side))


def split_combined(combined: Column | str, labels: Column) -> Column:
    """``CITY1CITY2`` split before the longest known label that ends it: struct of head and tail.

    ``labels`` is an array; they are compared without blanks, and those of fewer than three
    characters do not count.  No label, or nothing before it: null.
    """
    compact = F.replace(F.upper(F.trim(col(combined))), F.lit(" "), F.lit(""))
    fits = lambda l: (F.length(F.replace(F.upper(l), F.lit(" "), F.lit(""))) >= 3) & F.endswith(compact, F.replace(F.upper(l), F.lit(" "), F.lit("")))  # noqa: E731, E741
    ranked = F.sort_array(F.transform(F.filter(labels, fits), lambda l: F.struct(F.length(F.replace(l, F.lit(" "), F.lit(""))).alias("n"), l.alias("label"))), asc=False)  # noqa: E741
    best = F.get(ranked, F.lit(0))
    # the tail's length in the text itself, blanks included, is found from its compact length
    text = F.upper(F.trim(col(combined)))
    head = F.aggregate(
        F.sequence(F.lit(1), F.length(text)), F.lit(0),
        lambda keep, k: F.when(F.length(F.replace(F.substr(text, k), F.lit(" "), F.lit(""))) >= best["n"], k - 1).otherwise(keep),
    )
    return F.when(best.isNotNull() & (head > 0), F.struct(F.trim(F.substr(text, F.lit(1), head)).alias("head"), F.upper(best["label"]).alias("tail")))


def stable_bucket(x: Column | str, n: int = 8) -> Column:
    """A number below ``n`` from the hash of a key; the same on every run."""
    return F.pmod(F.conv(F.substring(F.sha2(col(x), 256), 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int")


def display_label(code: Column | str, city: Column | str) -> Column:
    return F.when(col(city).isNull(), col(code)).otherwise(F.format_string("%s (%s)", col(code), col(city)))


def compact_number(x: Column | str) -> Column:
    """``1.2M``, ``3.4K`` or the whole number; halves go to the even digit."""
    v = col(x).cast("double")
    return F.when(F.abs(v) >= 1e6, F.format_string("%.1fM", F.bround(v / 1e6, 1))).when(F.abs(v) >= 1e3, F.format_string("%.1fK", F.bround(v / 1e3, 1))).otherwise(F.format_string("%.0f", F.bround(v, 0)))


def growth_phrase(share: Column | str, band: float = 0.05) -> Column:
    """Signed growth in words: within ``band`` percent it is flat."""
    pct = F.bround(col(share) * 100, 1)
    return F.when(col(share).isNull(), "no base").when(F.abs(col(share) * 100) < band, "flat").when(pct > 0, F.format_string("up %.1f%%", pct)).otherwise(F.format_string("down %.1f%%", F.abs(pct)))


def upper_bound(x: Column | str) -> Column:
    """The next round number of 1, 1.25, 1.5, 2, 2.5, 5, 7.5 or 10 times a power of ten."""
    v = col(x).cast("double")
    power = F.pow(F.lit(10.0), F.floor(F.log10(v)))
    steps = F.array(*(F.lit(s) for s in (1.0, 1.25, 1.5, 2.0, 2.5, 5.0, 7.5, 10.0)))
    return F.when(v > 0, F.get(F.filter(F.transform(steps, lambda s: s * power), lambda s: s >= v), F.lit(0))).otherwise(F.lit(1.0))


def spread(positions: Column, gap: float) -> Column:
    """Sorted positions pushed upwards until neighbours are ``gap`` apart."""
    return F.aggregate(
        F.sort_array(positions), F.array().cast("array<double>"),
        lambda done, x: F.array_append(done, F.when(F.size(done) == 0, x).otherwise(F.greatest(x, F.element_at(done, -1) + gap))),
    )


def nullable_share(x: Column | str) -> Column:
    """Percent to one decimal, half to even; null for nan and infinite."""
    v = col(x)
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), F.bround(v * 100, 1))
