"""Interval spans and snapshot changes against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from flightloom.operators.intervals import coverage_spans
from flightloom.operators.snapshots import snapshot_changes, to_thousandths


def brute_spans(data):
    out = []
    for e in {r[0] for r in data if r[0] is not None}:
        covered = set()
        for x, lo, hi in data:
            if x == e:
                covered |= set(range(0 if lo is None else lo, (60 if hi is None else hi) + 1))
        if not covered:
            continue
        start, kind = min(covered), "period"
        for t in range(min(covered), max(covered) + 2):
            now = "period" if t in covered else "gap"
            if now != kind:
                out.append((e, kind, start, t - 1))
                start, kind = t, now
        # the last run is a gap that begins after the end; it is none
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_spans_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    data = []
    for _ in range(40):
        lo = rng.choice([None, *range(1, 50)])
        data.append((rng.choice(["a", "b", "c", None]), lo, rng.choice([None, (lo or 0) + rng.randrange(-3, 6)]) if rng.random() < 0.1 else (lo or 0) + rng.randrange(-3, 6)))
    df = spark.createDataFrame(data + data[:5], "entity string, lo int, hi int")
    got = sorted(tuple(r) for r in coverage_spans(df, "entity", "lo", "hi", open_hi=60, block=7).collect())
    assert got == brute_spans(data)


def test_spans_touch_nest_and_open(spark):
    df = spark.createDataFrame([("a", 1, 3), ("a", 4, 6), ("a", 9, None), ("a", 10, 12), ("b", 5, 2), (None, 1, 2)], "entity string, lo int, hi int")
    assert sorted(tuple(r) for r in coverage_spans(df, "entity", "lo", "hi").collect()) == [("a", "gap", 7, 8), ("a", "period", 1, 6), ("a", "period", 9, 99999)]
    assert coverage_spans(df.limit(0), "entity", "lo", "hi").collect() == []


SCHEMA = "n int, k string, v double, before string, entity int"


def test_snapshot_kinds(spark):
    data = [(1, "a", 1.0), (1, "b", 2.0), (1, "B", 2.0), (1, "c", None), (1, None, 1.0), (3, "A", 1.0001), (3, "b", 2.5), (3, "d", 1.0), (3, None, 2.0), (4, "a", None), (4, "b", 2.5), (4, "b", 2.5), (4, "d", 1.0), (4, None, 2.0)]
    assert changes_set(spark, data) == {(3, "added", "D"), (3, "changed", "B"), (3, "changed", None), (3, "removed", "C"), (4, "changed", "A")}


def changes_set(spark, data):
    df = spark.createDataFrame([(*r, "x", 1) for r in data], SCHEMA)
    return {tuple(r)[:3] for r in snapshot_changes(df, "n", {"k": F.lower("k")}, {"k": F.upper("k")}, [to_thousandths("v")], rows_per_bucket=50).collect()}


@pytest.mark.parametrize("seed", range(2))
def test_snapshots_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    data = [(n, f"k{i}", float(rng.randrange(3))) for n in (1, 2, 5) for i in range(120) if rng.random() < 0.8]
    data += [rng.choice(data) for _ in range(100)] + [(None, "z", 1.0)]
    by = {n: {k: v for m, k, v in data if m == n} for n in (1, 2, 5)}
    want = set()
    for a, b in ((1, 2), (2, 5)):
        for k in by[a].keys() | by[b].keys():
            if k not in by[a]:
                want.add((b, "added", k.upper()))
            elif k not in by[b]:
                want.add((b, "removed", k.upper()))
            elif by[a][k] != by[b][k]:
                want.add((b, "changed", k.upper()))
    assert changes_set(spark, data) == want


def test_one_snapshot_or_none(spark):
    assert changes_set(spark, [(1, "a", 1.0)]) == set()
    assert changes_set(spark, []) == set()
