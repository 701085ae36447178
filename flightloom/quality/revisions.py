"""What changed between two versions of a published table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.quality.checks import duplicate_counts


def changes(old: DataFrame, new: DataFrame, key: list[str], value: str) -> DataFrame:
    """Rows added, removed or restated: key, kind, old and new value.  Null equals null."""
    a = old.select(*key, F.col(value).alias("old_value"), F.lit(1).alias("__a"))
    b = new.select(*key, F.col(value).alias("new_value"), F.lit(1).alias("__b"))
    joined = a.join(b, key, "full")
    kind = F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed").when(~F.col("old_value").eqNullSafe(F.col("new_value")), "restated")
    return joined.withColumn("kind", kind).where("kind IS NOT NULL").select(*key, "kind", "old_value", "new_value")


def drifted_rows(old: DataFrame, new: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Number of rows of both versions in which any of ``columns`` differs."""
    a = old.select(*key, *(F.col(c).alias(f"__{c}") for c in columns))
    joined = a.join(new.select(*key, *columns), key)
    differs = reduce(lambda x, y: x | y, (~F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns))
    return joined.agg(F.count_if(differs).alias("drifted"))


def assert_unique(df: DataFrame, key: list[str]) -> None:
    """A diff over a key that is not unique would multiply rows."""
    extra = duplicate_counts(df, key).first().extra
    if extra:
        raise ValueError(f"{extra} rows repeat the key {', '.join(key)}")


def diff(old: DataFrame, new: DataFrame, key: list[str], value: str) -> DataFrame:
    assert_unique(old, key)
    assert_unique(new, key)
    return changes(old, new, key, value)


def percent_text(old: str, new: str):
    """Change in percent as text; a dash where there is no old value to compare with."""
    share = F.try_divide((F.col(new) - F.col(old)).cast("double"), F.col(old).cast("double"))
    return F.when(share.isNull(), "-").otherwise(F.format_string("%+.1f%%", F.bround(share * 100, 1)))
