"""Regular grids and trailing totals against brute force, with blocks small enough to matter."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flightloom.operators.grid import regular_grid
from flightloom.operators.trailing import trailing_totals

SCHEMA = "source string, p int, v long, o int, __v string, period string"


def brute_grid(readings, gap):
    out = []
    for s in {r[0] for r in readings if r[0] is not None}:
        mine = {}
        for src, p, v, o in readings:
            if src == s and p is not None and v is not None:
                best = mine.get(p)
                if best is None or (o if o is not None else -(10**9), v) > best:
                    mine[p] = (o if o is not None else -(10**9), v)
        if not mine:
            continue
        last = None
        for p in range(min(mine), max(mine) + 1):
            if p in mine:
                last = p
            near = p - last <= gap
            out.append((s, p, mine[p][1] if p in mine else None, mine[last][1] if near else None, "observed" if p in mine else "carried" if near else "missing"))
    return sorted(out, key=repr)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-12, 30)), st.one_of(st.none(), st.integers(0, 9)), st.integers(0, 3)), max_size=40), st.integers(0, 4))
def test_grid_equals_brute_force(spark, readings, gap):
    df = spark.createDataFrame([(*r, "x", "y") for r in readings], SCHEMA)
    got = regular_grid(df, "source", "p", "v", "o", max_gap=gap, block=5).select("source", "period", "reading", "value", "status")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_grid(readings, gap)


def test_grid_of_nothing(spark):
    assert regular_grid(spark.createDataFrame([], SCHEMA), "source", "p", "v").collect() == []
    assert regular_grid(spark.createDataFrame([("a", 1, None, 1, "", "")], SCHEMA), "source", "p", "v").collect() == []


def test_grid_counts_repeats_and_prefers_the_latest(spark):
    df = spark.createDataFrame([("a", 1, 5, 1, "", ""), ("a", 1, 5, 1, "", ""), ("a", 1, 3, 2, "", "")], SCHEMA)
    r = regular_grid(df, "source", "p", "v", "o").collect()
    assert [(x.reading, x.n_readings) for x in r] == [(3, 3)]


@pytest.mark.parametrize("block", [4, 4096])
def test_trailing_equals_brute_force(spark, block):
    rng = random.Random(7)
    data = [(rng.choice(["a", "b"]), rng.randrange(0, 40), rng.choice([None, 1, 2, 5])) for _ in range(60)] + [(None, 1, 1), ("a", None, 4)]
    df = spark.createDataFrame(data, "e string, p int, v long")
    got = {(r.e, r.period): r for r in trailing_totals(df, ["e"], "p", "v", (3, 12), block).collect()}
    want = {}
    for e in ("a", "b"):
        own = {}
        for x, p, v in data:
            if x == e and p is not None and v is not None:
                own[p] = own.get(p, 0) + v
        for p in range(min(own), max(own) + 1):
            want[e, p] = tuple((sum(own.get(q, 0) for q in range(p - w + 1, p + 1)), sum(q in own for q in range(p - w + 1, p + 1))) for w in (3, 12))
    assert set(got) == set(want)
    for k, ((t3, a3), (t12, a12)) in want.items():
        r = got[k]
        assert (r.total_3, r.active_3, r.total_12, r.active_12) == (t3, a3, t12, a12)
        assert r.avg_12 == t12 / 12.0


def test_trailing_of_nothing(spark):
    assert trailing_totals(spark.createDataFrame([], "e string, p int, v long"), ["e"], "p", "v").collect() == []
