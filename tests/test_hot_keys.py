"""One key with a third of all rows: results stay whole and equal to brute force."""

import random

from pyspark.sql import functions as F

from flightloom.operators.grid import regular_grid
from flightloom.operators.intervals import coverage_spans
from flightloom.operators.snapshots import snapshot_changes
from flightloom.operators.trailing import trailing_totals
from flightloom.sources.tables import rows_that_count

N = 12_000


def keys(rng):
    return ["hot" if rng.random() < 1 / 3 else f"k{rng.randrange(200)}" for _ in range(N)]


def test_grid_and_totals(spark):
    rng = random.Random(1)
    data = [(k, rng.randrange(0, 3000 if k == "hot" else 40), rng.randrange(100)) for k in keys(rng)]
    df = spark.createDataFrame(data, "k string, p int, v long")
    span = {}
    for k, p, v in data:
        lo, hi = span.get(k, (p, p))
        span[k] = (min(lo, p), max(hi, p))
    cells = {(k, p) for k, p, _ in data}
    got = regular_grid(df, "k", "p", "v", block=256).groupBy("status").count().collect()
    assert sum(r["count"] for r in got) == sum(b - a + 1 for a, b in span.values())
    assert {r.status: r["count"] for r in got}["observed"] == len(cells)
    own = {}
    for k, p, v in data:
        if k == "hot":
            own[p] = own.get(p, 0) + v
    totals = {r.period: r.total_12 for r in trailing_totals(df, ["k"], "p", "v", (3, 12), block=256).where("k = 'hot'").collect()}
    assert totals == {p: sum(own.get(q, 0) for q in range(p - 11, p + 1)) for p in range(span["hot"][0], span["hot"][1] + 1)}


def test_spans(spark):
    rng = random.Random(2)
    data = []
    for k in keys(rng):
        lo = rng.randrange(0, 40_000)
        data.append((k, lo, lo + rng.randrange(0, 8)))
    df = spark.createDataFrame(data, "k string, lo int, hi int")
    want = []
    for k in {d[0] for d in data}:
        end = None
        for _, lo, hi in sorted(d for d in data if d[0] == k):
            if end is None or lo > end + 1:
                if end is not None:
                    want += [(k, "period", start, end), (k, "gap", end + 1, lo - 1)]
                start, end = lo, hi
            else:
                end = max(end, hi)
        want.append((k, "period", start, end))
    assert sorted(tuple(r) for r in coverage_spans(df, "k", "lo", "hi", block=512).collect()) == sorted(want)


def test_repeated_rows_of_one_key(spark):
    many = spark.range(N).select(F.lit("hot").alias("k"), F.lit(1).alias("n"), F.lit(5.0).alias("v"), F.lit(0).alias("t"))
    few = spark.createDataFrame([("a", 1, 1.0, 0), ("a", 2, 2.0, 1), ("hot", 2, 6.0, 1)], "k string, n int, v double, t int")
    out = snapshot_changes(many.unionByName(few), "n", {"k": F.col("k")}, {"k": F.col("k")}, [F.col("v")])
    assert sorted((r.k, r.change_kind, r.before, r.after) for r in out.collect()) == [("a", "changed", ["1.0"], ["2.0"]), ("hot", "changed", ["5.0"], ["6.0"])]
    assert sorted(tuple(r) for r in rows_that_count(many.unionByName(few), ["k"], ["v"], "t").collect()) == [("a", 2.0), ("hot", 6.0)]
