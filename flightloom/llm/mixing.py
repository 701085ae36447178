"""Mixing sources to target weights.

Efraimidis-Spirakis sampling: every document gets the key ``u ** (1 / w)``, with ``u`` a
hash of its id and ``w`` its quality; within a source documents are taken from the
largest key down until the token budget is full.  Complete epochs of a source come
first, the fractional selection after them.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

from flightloom.session import cut_lineage

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how byte-level BPE vocabularies of this kind split text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEED = 20_177
#: Documents that a key range holds at most, about; only the one range per source that a budget cuts is put in order.
ROWS_PER_RANGE = 100_000


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(vocabulary: str = VOCABULARY):
    """Pandas UDF: number of tokens of a text; null and empty texts have none."""

    @F.pandas_udf(LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = _encoding(vocabulary)
        for texts in batches:
            yield pd.Series([len(t) for t in encoding.encode_ordinary_batch([x or "" for x in texts], num_threads=1)], dtype="int64")

    return count


def quality(text: Column) -> Column:
    """Weight of a document, 0.05 to 1: share of letters among its visible characters, times fullness."""
    visible = F.greatest(F.length(F.regexp_replace(text, r"\s", "")), F.lit(1))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    full = F.least(F.lit(1.0), F.length(text) / F.lit(400.0))
    return F.greatest(F.lit(0.05), F.coalesce(letters / visible * F.sqrt(full), F.lit(0.05)))


def source_name(source: Column) -> Column:
    """Sources written with other case, blanks or underscores are one source."""
    return F.regexp_replace(F.lower(F.trim(source)), r"[\s_]+", "_")


def sized(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", vocabulary: str = VOCABULARY, seed: int = SEED) -> DataFrame:
    """(doc_id, source, n_tokens, key): the columns that sampling needs, each text read once."""
    base = documents.select(F.col(doc_id).alias("doc_id"), source_name(F.col(source)).alias("source"), F.col(text).alias("text"))
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11).cast("double") + 0.5) / F.lit(float(2**53))
    return base.select("doc_id", "source", token_counts(vocabulary)("text").alias("n_tokens"), F.pow(u, F.lit(1.0) / quality(F.col("text"))).alias("key"))


def plan_mixture(totals: list[tuple[str, int]], targets: list[tuple[str, float, int]], total_tokens: float | None = None) -> dict[str, dict]:
    """Budgets per source: ``epochs`` complete ones and ``rest`` tokens of a fraction.

    Without ``total_tokens`` the mixture is as large as the scarcest source allows at its
    highest number of repeats.  A target without documents cannot be met; the shares of
    the others are scaled up to 1.  With ``total_tokens`` a source stops at its repeats.
    """
    have = {s: n for s, n in totals if s is not None and n > 0}
    open_targets = {s: (share, cap) for s, share, cap in targets if s in have and share and share > 0 and cap and cap > 0}
    weight = sum(share for share, _ in open_targets.values())
    if not weight:
        return {}
    size = min(cap * have[s] / (share / weight) for s, (share, cap) in open_targets.items())
    if total_tokens is not None:
        size = total_tokens
    plan = {}
    for s, (share, cap) in open_targets.items():
        budget = min(size * share / weight, float(cap * have[s]))
        epochs = min(cap, math.floor(budget / have[s] + 1e-9))
        plan[s] = {"planned_share": share / weight, "budget": budget, "epochs": epochs, "rest": max(0.0, budget - epochs * have[s]) if epochs < cap else 0.0}
    return plan


def mixture(documents: DataFrame, targets: DataFrame, total_tokens: float | None = None, vocabulary: str = VOCABULARY, seed: int = SEED, rows_per_range: int = ROWS_PER_RANGE) -> tuple[DataFrame, DataFrame]:
    """The mixture, (doc_id, source, n_tokens, copies), and its report by source.

    Report: ``source, target_share, planned_share, actual_share, tokens_available,
    tokens_used, documents_used, max_repeats, status`` (``met``, ``short``, ``no documents`` or ``no
    target``).  Documents of null source or of sources without target are not used; null and empty
    texts have no tokens and cost nothing; ids are taken as unique; ties of keys go by id;
    several targets for one source add up; extra columns are left out; without documents the mixture is
    empty.

    Texts are read and tokenized once; the small sized table is cut off in the shared
    folder.  Totals per source and per key range are aggregates with map-side combine;
    a window orders only the one range per source that the budget cuts, so a source with a
    third of all documents is not sorted in one task.
    """
    rows = cut_lineage(sized(documents, vocabulary=vocabulary, seed=seed))
    wanted = targets.groupBy(source_name(F.col("source")).alias("source")).agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("cap")).where("source IS NOT NULL")
    wanted_rows = [tuple(r) for r in wanted.collect()]
    spark = documents.sparkSession
    targeted = rows.join(wanted.select("source"), "source", "left_semi")
    sizes = targeted.groupBy("source").agg(F.sum("n_tokens"), F.count(F.lit(1))).collect()
    totals = [(r[0], r[1]) for r in sizes]
    plan = plan_mixture(totals, wanted_rows, total_tokens)
    # -log(key) is exponential whatever the weight, and the logarithm of an exponential has a density of 0.37 at most:
    # no range of this width holds more documents, also where low quality piles up at one end of the keys
    width = min(0.005, rows_per_range / (0.37 * max((r[2] for r in sizes), default=1)))
    distance = F.greatest(-F.log(F.greatest(F.col("key"), F.lit(1e-300))), F.lit(1e-300))
    piece = F.floor(F.log(distance) / F.lit(width)).cast("long")
    placed = targeted.withColumn("range", piece)
    budgets = spark.createDataFrame([(s, p["epochs"], p["rest"]) for s, p in sorted(plan.items())], "source string, epochs int, rest double")
    sums = placed.groupBy("source", "range").agg(F.sum("n_tokens").alias("t"))
    upto = sums.withColumn("before", F.sum("t").over(Window.partitionBy("source").orderBy("range")) - F.col("t"))
    cuts = upto.join(budgets, "source").where("before <= rest AND before + t > rest").groupBy("source").agg(F.min("range").alias("cut"), F.min_by("before", "range").alias("before"))
    per_source = budgets.join(cuts, "source", "left")
    joined = placed.join(per_source, "source")
    # no range is cut if the rest takes all documents of the source
    whole = joined.where("cut IS NULL OR range <> cut").withColumn("extra", F.when(F.col("rest") <= 0, 0).when(F.col("cut").isNull() | (F.col("range") < F.col("cut")), 1).otherwise(0))
    order = Window.partitionBy("source").orderBy(F.desc("key"), "doc_id")
    split = joined.where("range = cut").withColumn("extra", F.when(F.col("before") + F.sum("n_tokens").over(order) <= F.col("rest"), 1).otherwise(0))
    mixed = whole.unionByName(split).select("doc_id", "source", "n_tokens", (F.col("epochs") + F.col("extra")).cast("int").alias("copies")).where("copies > 0")
    used = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens_used"), F.count(F.lit(1)).alias("documents_used"))
    available = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens_available"))
    planned = spark.createDataFrame([(s, p["planned_share"], p["budget"]) for s, p in sorted(plan.items())], "source string, planned_share double, budget double")
    report = available.where("source IS NOT NULL").join(wanted, "source", "full").join(planned, "source", "left").join(used, "source", "left")
    all_used = F.sum("tokens_used").over(Window.partitionBy(F.lit(1)))  # one row per source
    zero = lambda c: F.coalesce(c, F.lit(0))
    status = (
        F.when(F.col("share").isNull(), "no target")
        .when(zero("tokens_available") == 0, "no documents")
        .when(zero("tokens_used") < F.col("budget") * 0.99, "short")
        .otherwise("met")
    )
    shares = report.select(
        "source", F.col("share").alias("target_share"), "planned_share", F.try_divide(zero("tokens_used"), all_used).alias("actual_share"), zero("tokens_available").alias("tokens_available"),
        zero("tokens_used").alias("tokens_used"), zero("documents_used").alias("documents_used"), F.col("cap").cast("int").alias("max_repeats"), status.alias("status"),
    )
    return mixed, shares
