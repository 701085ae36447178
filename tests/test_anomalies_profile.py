"""Planted anomalies and faulty loads."""

import itertools
import math
import random

import numpy as np
import pandas as pd

from flightloom.operators import anomalies as A
from flightloom.operators import profile as P

RULES = {"pax": A.Rule(True, 0.0, math.inf, math.log(4)), "lf": A.Rule(False, 0.0, 100.0, 25.0)}
SCHEMA = "measure string, source string, period int, value double, network double"


def series(n_sources=30, n=60, seed=1):
    rng = random.Random(seed)
    out = {}
    for s in range(n_sources):
        base = 10 ** rng.uniform(3, 6)
        for t in range(n):
            season = 5.0 if s == 3 and t % 12 == 6 else 1.0
            step = 6.0 if s == 4 and t >= 30 else 1.0
            shared = 0.2 if 40 <= t < 43 else 1.0
            out["pax", f"s{s}", t] = round(base * season * step * shared * rng.uniform(0.95, 1.05))
            out["lf", f"s{s}", t] = round((70 if t not in (20, 21) else 30) + rng.uniform(-4, 4), 3)
    return out


def run(spark, data):
    df = spark.createDataFrame([(*k, None if v is None else float(v), 9.0) for k, v in data.items()], SCHEMA)
    return {(r.measure, r.source, r.period): r.flag for r in A.flag_implausible(df, RULES).collect()}


def test_planted_cases_and_decoys(spark):
    data = series()
    want = {}

    def plant(key, value, flag):
        data[key], want[key] = value, flag

    plant(("pax", "s0", 10), data["pax", "s0", 10] * 8, "spike")
    plant(("pax", "s1", 10), data["pax", "s1", 10] / 8, "spike")
    plant(("pax", "s1", 11), data["pax", "s1", 11] / 9, "spike")
    plant(("pax", "s2", 5), -data["pax", "s2", 5], "out_of_range")
    for t in range(16, 21):
        data["pax", "s5", t] = data["pax", "s5", 15]
        want["pax", "s5", t] = "stuck"
    for t in (31, 32):
        data["pax", "s6", t] = data["pax", "s6", 30]  # three equal ones are no case
    plant(("lf", "s7", 9), 104.0, "out_of_range")
    plant(("lf", "s8", 9), 25.0, "spike")
    data["pax", "s9", 20] = None
    assert run(spark, data) == want


def test_seasons_with_a_spike_on_top(spark):
    data = series()
    key = ("pax", "s3", 25)
    data[key] *= 7
    assert run(spark, data) == {key: "spike"}


def test_nothing_known(spark):
    assert run(spark, {}) == {}
    assert run(spark, {("pax", "a", 1): None, ("other", "a", 1): 5.0, ("pax", "a", 2): 7.0}) == {}


def _paths(e, entry):
    """State probabilities by adding up every path."""
    n, k = len(e), A.STATES
    step = A._SHARED + A._FREE[:, None] * entry
    total = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        if path[-1] in A._UNFINISHED:
            continue
        w = entry[path[0]] * e[0, path[0]]
        for t in range(1, n):
            w *= step[path[t - 1], path[t]] * e[t, path[t]]
            if not w:
                break
        for t, s in enumerate(path):
            total[t, s] += w
    return total / total.sum(axis=1, keepdims=True)


def test_forward_backward_equals_all_paths():
    z = np.array([[0.0, 1.3, 1.6, 0.1]])
    flags = lambda *on: np.array([[k in on for k in range(4)]])
    own = A._first_guess(z)
    for equal, out, known in ((flags(), flags(), flags(0, 1, 2, 3)), (flags(1, 2, 3), flags(), flags(0, 1, 2, 3)), (flags(), flags(2), flags(0, 2, 3))):
        e = A._emissions(np.where(known & ~out, z, np.nan), own, equal, out, known)
        assert np.allclose(A._posterior(e, own.entry)[0], _paths(e[0], own.entry[0]), atol=1e-9)


def test_lengths_are_part_of_the_chain():
    """One or two periods are a spike, three are a movement; three equal steps are stuck, two are not."""

    def flags(z, equal):
        z = np.array([z], float)
        own = A._first_guess(np.zeros_like(z) + 0.05)
        equal = np.array([equal], bool)
        p = A._posterior(A._emissions(z, own, equal, np.zeros(z.shape, bool), np.ones(z.shape, bool)), own.entry)[0]
        return A._FLAG[[int(x) for x in p.argmax(axis=1)]].tolist()

    none = [0] * 8
    assert flags([0, 0, 2, 0, 0, 0, 0, 0], none) == [0, 0, A.SPIKE, 0, 0, 0, 0, 0]
    assert flags([0, 0, -2, -2, 0, 0, 0, 0], none) == [0, 0, A.SPIKE, A.SPIKE, 0, 0, 0, 0]
    assert flags([0, 0, 2, 2, 2, 0, 0, 0], none) == none
    assert flags([0] * 8, [0, 0, 1, 1, 1, 0, 0, 0]) == [0, 0, A.STUCK, A.STUCK, A.STUCK, 0, 0, 0]
    assert flags([0] * 8, [0, 0, 1, 1, 0, 0, 0, 0]) == none


def test_what_is_implausible_depends_on_the_source(spark):
    """The same departure is a spike of a calm source and nothing of a noisy one."""
    rng = random.Random(4)
    calm = {("lf", f"c{s}", t): 60 + rng.uniform(-0.4, 0.4) for s in range(12) for t in range(60)}
    noisy = {("lf", "n", t): 50 + rng.choice((-1, 1)) * rng.expovariate(1 / 7.0) for t in range(60)}
    calm["lf", "c3", 30] = 60 + 25.5
    noisy["lf", "n", 30] = float(np.median([v for v in noisy.values()])) + 27.0
    assert run(spark, calm | noisy) == {("lf", "c3", 30): "spike"}


def test_rows_come_from_the_posterior(spark, monkeypatch):
    """Without forward-backward, states told from one period each, other rows come out."""
    data = series(n_sources=6)
    for t in (30, 31, 32):
        data["lf", "s2", t] = 10.0 + t
    rules = {"lf": RULES["lf"]}
    rows = pd.DataFrame([(m, s, 0, t, v, 0.0) for (m, s, t), v in sorted(data.items()) if m == "lf" and not 19 < t < 22], columns=["measure", "source", "__b", "period", "value", "network"])
    whole = set(A._flag_rows(rows, rules)["period"])
    monkeypatch.setattr(A, "_posterior", lambda e, entry: e * entry[:, None, :] / (e * entry[:, None, :]).sum(axis=2, keepdims=True))
    assert not whole and {30, 31} <= set(A._flag_rows(rows, rules)["period"])


def test_blocks_chunks_and_batches_do_not_change_flags(spark, monkeypatch):
    data = series(n_sources=9)
    data["pax", "s0", 33] *= 9
    data["lf", "s1", 50] = 2.0
    for t in range(29, 34):
        data["lf", "s5", t] = 61.5
    whole = run(spark, data)
    rows = pd.DataFrame([(m, s, t, float(v)) for (m, s, t), v in data.items()], columns=["measure", "source", "period", "value"])
    rows["network"], rows["__b"] = 0.0, 0
    rows = rows[rows["measure"] == "lf"].sort_values(["measure", "source", "__b", "period"])
    one = A._flag_rows(rows, RULES)
    monkeypatch.setattr(A, "CELLS", 70)
    monkeypatch.setattr(A, "ROWS", 37)
    many = pd.concat(list(A._flag_batches(RULES)(rows.iloc[k : k + 23] for k in range(0, len(rows), 23))))
    key = ["source", "period", "flag"]
    assert sorted(map(tuple, one[key].values.tolist())) == sorted(map(tuple, many[key].values.tolist()))
    monkeypatch.setattr(A, "BLOCK", 40)
    assert run(spark, data) == whole and len(whole) == 6


def test_a_stray_year_costs_no_memory():
    first, last = np.array([0, 5, 24_000, 0]), np.array([100, 110, 24_100, 90])
    assert list(A._chunks(first, last)) == [(0, 2), (2, 4)]


def loads(spark, rows, columns=("v",)):
    df = spark.createDataFrame(rows, "load_no int, id int, " + ", ".join(f"{c} double" for c in columns))
    checks = [P.ColumnCheck(c, 0.0, None, 1.0) for c in columns]
    return P.profile_loads(P.base_profile(P.load_cells(df, "t", "load_no", checks)), P.discrimination(P.features(df, "t", "load_no", checks, ["id"]), {"t": list(columns)}))


def test_faulty_loads(spark):
    rng = random.Random(2)
    rows = []
    for load in range(1, 8):
        for i in range(400):
            v = float(rng.randrange(5_000, 50_000))
            if load == 2 and i % 5 == 0:
                v = None
            if load == 3 and i % 20 == 0:
                v = -v
            if load == 4:
                v *= 100
            if load == 5:
                v -= v % 10
            rows.append((load, load * 1000 + i, v))
    got = {(r.load_no, r.issue_kind) for r in P.load_issues(loads(spark, rows)).collect()}
    assert got == {(2, "nulls"), (3, "domain"), (4, "scale"), (4, "precision"), (5, "precision")}


def test_profile_figures(spark):
    rows = [(1, i, float(v)) for i, v in enumerate([3, 1, 2, 10])] + [(2, 9, None), (2, 10, 7.0), (None, 1, 1.0)]
    got = {r.load_no: r for r in loads(spark, rows).collect()}
    assert (got[1].n_rows, got[1].n_null, got[1].median, got[1].median_of_others, got[1].least, got[1].most) == (4, 0, 2.5, 7.0, 1.0, 10.0)
    assert (got[2].n_rows, got[2].n_null, got[2].median) == (2, 1, 7.0)
    assert loads(spark, [(2, 1, None)]).collect()[0].n_null == 1
    assert loads(spark, []).collect() == []


def test_medians_of_loads_and_of_the_others(spark):
    rng = random.Random(9)
    rows = [(load, i, rng.choice([None, -4.0, 0.0, 12.0, 150.0, 999.0, 2000.0])) for load in (1, 2, 3, 4) for i in range(load * 100, load * 100 + rng.randrange(3, 9))]
    rows += rows[:3] + [(5, 1, None), (5, 2, None)]
    got = {r.load_no: (r.median, r.median_of_others) for r in loads(spark, rows).collect()}
    median = lambda v: float(np.median(v)) if v else None
    want = {k: (median([v for a, _, v in rows if a == k and v is not None]), median([v for a, _, v in rows if a != k and v is not None])) for k in range(1, 6)}
    assert got == want


def test_classifier_sees_a_change_only_where_there_is_one(spark):
    rng = random.Random(5)
    rows = [(load, load * 1000 + i, float(rng.lognormvariate(9 + (load == 3), 0.5))) for load in (1, 2, 3) for i in range(600)]
    got = {r.load_no: r for r in loads(spark, [(a, b, float(round(c))) for a, b, c in rows]).collect()}
    assert got[3].discrimination > 0.7 and got[3].scale_lost > 0.2 and abs(got[3].precision_lost) < 0.05
    same = [(load, load * 1000 + i, float(rng.randrange(100, 900))) for load in (1, 2, 3) for i in range(600)]
    assert all(abs(r.discrimination - 0.5) < 0.08 and r.scale_lost is None for r in loads(spark, same).collect())


def test_ablation_names_the_column_that_changed(spark):
    """Also next to a column that moves with it, and where one load has two faults."""
    rng = random.Random(6)
    rows = []
    for load in (1, 2, 3, 4, 5):
        for i in range(load * 1000, load * 1000 + 800):
            a = rng.randrange(1000, 9000)
            b = a // 2 + rng.randrange(-40, 40)
            rows.append((load, i, float(a * 5000 - a * 5000 % 10 if load == 2 else a), float(b)))
    got = {(r.load_no, r.column_name): r for r in loads(spark, rows, ("a", "b")).collect()}
    assert got[2, "a"].discrimination > 0.95 and got[2, "a"].scale_lost > 0.2 and got[2, "a"].precision_lost > 0.2
    assert abs(got[2, "b"].scale_lost) < 0.15 and abs(got[2, "b"].precision_lost) < 0.05
    assert {(r.column_name, r.load_no, r.issue_kind) for r in P.load_issues(loads(spark, rows, ("a", "b"))).collect()} == {("a", 2, "scale"), ("a", 2, "precision")}


def test_issues_come_from_the_classifier(spark, monkeypatch):
    """Medians far apart by the toss of a coin are no change of scale; without the classifier none is found, and with a blind one these are."""
    rng = random.Random(3)
    toss = [(load, load * 1000 + i, float((100 if i < 400 + 25 * (load == 2) - 20 * (load != 2) else 90_000) + rng.randrange(100))) for load in (1, 2, 3) for i in range(800)]
    fault = [(load, load * 1000 + i, float(rng.randrange(100, 200) * (100_000 if load == 4 else 1) + rng.randrange(100))) for load in (1, 3, 4) for i in range(800)]
    issues = lambda rows: {(r.load_no, r.issue_kind) for r in P.load_issues(loads(spark, rows)).collect() if r.load_no in (2, 4)}
    assert issues(toss) == set() and issues(fault) == {(4, "scale")}
    monkeypatch.setattr(P, "EXPLAINS", 0.6)
    assert issues(fault) == set()
    monkeypatch.setattr(P, "EXPLAINS", -1.0)
    monkeypatch.setattr(P, "DIFFERENT", 0.0)
    assert issues(toss) == {(2, "scale")}


def test_regression_equals_one_machine(spark, monkeypatch):
    """Sums over the cluster, in portions of loads, give the same areas as plain steps on all rows at once."""
    rng = random.Random(8)
    rows = [(load, i, float(rng.randrange(1, 50) * load)) for load in (1, 2, 3) for i in range(load * 1000, load * 1000 + 300)]
    monkeypatch.setattr(P, "LOADS_PER_PASS", 2)
    df = spark.createDataFrame(rows, "load_no int, id int, v double")
    cells = P.features(df, "t", "load_no", [P.ColumnCheck("v")], ["id"])
    got = {r.load_no: r.discrimination for r in P.discrimination(cells, {"t": ["v"]}).collect()}
    own = cells.toPandas()
    x, fold = P._design(own["f"]), own["fold"].to_numpy()
    for load in (1, 2, 3):
        y = (own["load_no"] == load).to_numpy()
        areas = []
        for f in (0, 1):
            t = fold == f
            w = np.where(y[t], 2 / 300, 2 / 600)
            h = np.linalg.inv((x[t] * w[:, None]).T @ x[t] / 4 + P.RIDGE * np.eye(x.shape[1]))
            beta = np.zeros(x.shape[1])
            for _ in range(P.STEPS):
                beta += h @ (x[t].T @ (w * (y[t] - 1 / (1 + np.exp(-x[t] @ beta)))) - P.RIDGE * beta)
            s = np.clip(np.rint(x[~t] @ beta / P.SCORE_BIN), -P.SCORE_BINS, P.SCORE_BINS)
            a, b = s[y[~t]], s[~y[~t]]
            areas.append(np.mean((a[:, None] > b) + 0.5 * (a[:, None] == b)))
        assert math.isclose(got[load], np.mean(areas), abs_tol=1e-9)


def test_fitted_rows_are_bounded_and_all_rows_scored(spark, monkeypatch):
    rng = random.Random(10)
    rows = [(load, load * 10_000 + i, float(rng.randrange(10, 90) * (50 if load == 1 else 1))) for load in (1, 2, 3) for i in range(3000)]
    monkeypatch.setattr(P, "FITTED_ROWS", 200)
    seen = []
    monkeypatch.setattr(P, "cut_lineage", lambda df: seen.append(df.count()) or df)
    cells = P.features(spark.createDataFrame(rows, "load_no int, id int, v double"), "t", "load_no", [P.ColumnCheck("v")], ["id"])
    got = {r.load_no: r for r in P.discrimination(cells, {"t": ["v"]}).collect()}
    assert 450 < seen[0] < 750 and got[1].discrimination > 0.9 and got[1].scale_lost > 0.3


def test_rows_of_a_load_are_not_moved_for_the_sample(spark, monkeypatch):
    """The draw moves only drawn rows, whatever size Spark expects of the rates."""
    plans = []
    monkeypatch.setattr(P, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))) or df)
    df = spark.createDataFrame([(load, load * 100 + i, float(i)) for load in (1, 2) for i in range(20)], "load_no int, id int, v double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        P.discrimination(P.features(df, "t", "load_no", [P.ColumnCheck("v")], ["id"]), {"t": ["v"]}).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans and all("BroadcastHashJoin" in p and "SortMergeJoin" not in p and "ShuffledHashJoin" not in p for p in plans)


def test_like_cells_are_few(spark):
    """Sizes and last digits are counted apart, so that a load of many values has few kinds of cells, and all are counted."""
    rng = random.Random(11)
    rows = [(1, v) for v in (rng.randrange(10_000, 99_999) for _ in range(20_000))] + [(1, None), (1, -5)]
    df = spark.createDataFrame(rows, "load_no int, v long").coalesce(1)
    cells = P.load_cells(df, "t", "load_no", [P.ColumnCheck("v", 0.0, None, 1.0)]).collect()
    has = [v for _, v in rows if v is not None]
    assert len(cells) <= len({round(v, -2) if v > 0 else v for v in has}) + 11
    sized, digits = [c for c in cells if c.value is not None], [c for c in cells if c.value is None]
    assert sum(c.n for c in sized) == len(has) and (sum(c.n for c in digits), sum(c.filled for c in digits), sum(c.outside for c in digits)) == (len(rows), len(has), 1)
    assert {c.digit: c.n for c in digits if c.digit is not None} == {d: sum(abs(v) % 10 == d for v in has) for d in range(10)}


def test_moments_of_models_are_sums_over_loads():
    """What tasks send by load gives the second moments of every model, also of one without rows in a task."""
    rng = np.random.default_rng(12)
    x, load_no, rows = rng.normal(size=(60, 4)), np.repeat([1, 2, 3], 20), {1: 20, 2: 40_000, 3: 20, 4: 7}
    task = P._Task(np.array([2, 3, 4]), rows, np.zeros((2, 3, 4)))
    sums = {}
    for part in (slice(0, 25), slice(25, 60)):
        for k, v in P._moments(task, 0, x[part], load_no[part]):
            sums[k] = sums.get(k, 0) + v
    _, w = task.weights(load_no)
    own, other = task.shares
    for k in range(3):
        want = ((x * w[:, k : k + 1]).T @ x)[np.triu_indices(4)]
        mine = sums.get(k, 0)
        assert np.allclose(own[k] * mine + other[k] * (sums[-1] - mine), want)
    assert set(sums) == {-1, 0, 1}


def test_column_profile(spark):
    df = spark.createDataFrame([(1, "AB", 1), (1, "ab", None), (1, "AB", 2), (2, None, 3)], "load_no int, code string, n int")
    got = {(r.load_no, r.column_name): (r.n_rows, r.n_null, r.n_distinct, r.n_violations) for r in P.column_profile(df, "load_no", {"code": "^[A-Z]+$"}).collect()}
    assert got == {(1, "code"): (3, 0, 2, 1), (1, "n"): (3, 1, 2, 0), (2, "code"): (1, 1, 0, 0), (2, "n"): (1, 0, 1, 0)}
    ranges = {(r.load_no, r.column_name): (r.least, r.most, r["first"], r["last"]) for r in P.column_profile(df, "load_no", {}).collect()}
    assert ranges == {(1, "code"): (None, None, "AB", "ab"), (1, "n"): (1.0, 2.0, None, None), (2, "code"): (None,) * 4, (2, "n"): (3.0, 3.0, None, None)}
