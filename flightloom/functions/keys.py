"""Canonical forms of the keys that deliveries write in several ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def code(x: Column | str) -> Column:
    """Airport code: trimmed and upper case."""
    return F.upper(F.trim(_col(x)))


def service_type(x: Column | str) -> Column:
    """``Scheduled Domestic`` and ``SCHEDULED_DOMESTIC`` become ``scheduled_domestic``."""
    return F.regexp_replace(F.lower(F.trim(_col(x))), r"[\s_]+", "_")


def loose(x: Column | str) -> Column:
    """Comparison form: case, outer blanks and blank against underscore do not count."""
    return F.replace(F.lower(F.trim(_col(x))), F.lit("_"), F.lit(" "))
