"""Implausible spikes, stuck values and impossible readings per source.

Every source is a hidden Markov chain.  Its states are spelled out by duration, so that the lengths which tell
a spike from a movement and a stuck value from a coincidence are part of the chain: a spike has a first and a second period,
a lasting movement at least three, and a stuck value at least three equal steps.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Cells (sources times periods) worked on at a time, and rows gathered before work begins.
CELLS, ROWS = 65_536, 50_000
#: Periods per block of a source, and periods of its neighbours that a block brings along.
BLOCK, HALO = 4096, 64
#: Width of the bins in which the network's movements are counted.
BIN = 0.01


@dataclass(frozen=True)
class Rule:
    """What is implausible in one measure.

    ``ratio``: jumps are measured as factors (``jump`` is a natural logarithm),
    otherwise in points.  Readings outside ``lower`` to ``upper`` are impossible.
    """

    ratio: bool
    lower: float
    upper: float
    jump: float
    season: int = 12


def _median(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Median along the last axis of the ``known`` cells that are no nan; sorting puts nan last."""
    order = np.sort(x, axis=-1)
    pick = lambda k: np.take_along_axis(order, np.clip(k, 0, x.shape[-1] - 1)[..., None], axis=-1)[..., 0]
    return (pick((known - 1) // 2) + pick(known // 2)) / 2


def _side(x: np.ndarray, reach: int, ahead: bool, least: int) -> np.ndarray:
    """Median of the ``reach`` cells before or after each cell; nan where fewer than ``least`` are known."""
    pad = np.pad(x, ((0, 0), (reach, reach)), constant_values=np.nan)
    at = np.lib.stride_tricks.sliding_window_view(pad, reach, axis=1)
    around = at[:, reach + 1 : reach + 1 + x.shape[1]] if ahead else at[:, : x.shape[1]]
    known = np.sum(~np.isnan(around), axis=2)
    return np.where(known >= least, _median(around, known), np.nan)


def _departure(x: np.ndarray, level_of: np.ndarray) -> np.ndarray:
    """Distance of each reading from both of its sides: 0 between them, else the smaller one.

    A lasting step departs from one side only; a spike departs from both.
    """
    sides = []
    for ahead in (False, True):
        near = _side(level_of, 8, ahead, 3)
        sides.append(x - np.where(np.isnan(near), _side(level_of, 15, ahead, 2), near))
    left, right = sides
    whole = x - _median(level_of, np.sum(~np.isnan(level_of), axis=1))[:, None]
    both = np.where(np.sign(left) == np.sign(right), np.where(np.abs(left) < np.abs(right), left, right), 0.0)
    out = np.where(np.isnan(left), right, np.where(np.isnan(right), left, both))
    return np.where(np.isnan(out), whole, out)


def _season(departure: np.ndarray, phase: np.ndarray, length: int) -> np.ndarray:
    """The part of the departures that returns in the same month of other years."""
    found = np.zeros((departure.shape[0], length))
    for m in range(length):
        of = departure[:, phase == m]
        if of.shape[1] < 2:
            continue
        known = np.sum(~np.isnan(of), axis=1)
        # the lower median in size: half of the years must agree
        size = np.sort(np.where(np.isnan(of), np.inf, np.abs(of)), axis=1)
        lower = size[np.arange(len(of)), np.maximum(known - 1, 0) // 2]
        sign = np.sign(np.nansum(np.sign(of), axis=1))
        agree = np.sum(np.sign(of) == sign[:, None], axis=1) * 2 > known
        found[:, m] = np.where((known >= 2) & agree, sign * np.where(np.isfinite(lower), lower, 0.0), 0.0)
    return found[:, phase]


NORMAL, SPIKE, STUCK, OUT = range(4)
#: States of the chain: as usual; first and second period of a spike up or down; first, second and later periods of a lasting
#: movement up or down; first, second and later equal steps of a stuck value; out of range.
_N, _U1, _U2, _D1, _D2, _HU1, _HU2, _HU3, _HD1, _HD2, _HD3, _K1, _K2, _K3, _O = range(15)
STATES = 15
#: Which flag each state stands for, and the states in which a source's readings cannot end.
_FLAG = np.array([NORMAL, SPIKE, SPIKE, SPIKE, SPIKE, *[NORMAL] * 6, STUCK, STUCK, STUCK, OUT])
_UNFINISHED = [_HU1, _HU2, _HD1, _HD2, _K1, _K2]
#: Entries: state, share of periods in which it is entered before anything is known of the source.
_ENTRIES = {_U1: 0.0025, _D1: 0.0025, _HU1: 0.001, _HD1: 0.001, _K1: 0.003, _O: 0.004}
#: Periods that these expectations weigh against the source's own, and the steps of estimation.
PRIOR_PERIODS, EM_STEPS = 200.0, 2
#: Share of unusual movements below the limit; what a jump may be at most, in limits; share of coincidences among equal steps.
UNUSUAL, REACH, COINCIDENCE = 1e-4, 10.0, 0.002
#: Least noise of a source, and of what its surroundings lead to expect, in limits.
LEAST_NOISE, LEAST_EDGE = 0.02, 0.05


def _structure() -> tuple[np.ndarray, np.ndarray]:
    """Transitions that all sources share, and the share of each state that is left for a new entry."""
    a = np.zeros((STATES, STATES))
    for first, second in ((_U1, _U2), (_D1, _D2)):
        a[first, second] = 0.3
    for chain, stays in (((_HU1, _HU2, _HU3), 0.6), ((_HD1, _HD2, _HD3), 0.6), ((_K1, _K2, _K3), 0.8)):
        a[chain[0], chain[1]] = a[chain[1], chain[2]] = 1.0
        a[chain[2], chain[2]] = stays
    return a, 1.0 - a.sum(axis=1)


_SHARED, _FREE = _structure()


@dataclass
class _Source:
    """What is estimated per source: noise, coincidences among equal steps, and how often each state is entered."""

    noise: np.ndarray  # (sources, 1)
    coincidence: np.ndarray  # (sources, 1)
    entry: np.ndarray  # (sources, states), rows sum to 1


def _first_guess(z: np.ndarray) -> _Source:
    n = len(z)
    size = np.abs(z)
    entry = np.zeros((n, STATES))
    for state, share in _ENTRIES.items():
        entry[:, state] = share
    entry[:, _N] = 1.0 - entry.sum(axis=1)
    noise = _median(size, np.sum(~np.isnan(size), axis=1))[:, None] / np.log(2.0)
    return _Source(np.clip(np.nan_to_num(noise, nan=0.05), LEAST_NOISE, 0.25), np.full((n, 1), COINCIDENCE), entry)


def _emissions(z: np.ndarray, own: _Source, equal: np.ndarray, out: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Likelihood of each cell (its departure, and whether it repeats the reading before it) under each state.

    Usual readings depart by the source's noise, and now and then by an unusual movement below the limit.  A spike
    departs by more than the limit, a lasting movement in each period by more than half of it; both are blurred by the error
    of the expected value.
    """
    at = np.nan_to_num(z)
    size = np.abs(at)

    def over(limit: float) -> np.ndarray:
        edge = (size - limit) / np.maximum(own.noise, LEAST_EDGE)
        return np.where(edge < 0, 0.5 * np.exp(np.minimum(edge, 0.0)), 1.0 - 0.5 * np.exp(-np.maximum(edge, 0.0)))

    beyond, half = over(1.0), over(0.5)
    usual = (1.0 - UNUSUAL) * np.exp(-size / own.noise) / (2.0 * own.noise) + 0.5 * UNUSUAL * (1.0 - beyond)
    e = np.full((*z.shape, STATES), 1e-12)
    e[..., _N] = np.maximum(usual, 1e-12)
    for states, side in (((_U1, _U2), at > 0), ((_D1, _D2), at < 0)):
        for s in states:
            e[..., s] = np.where(side, np.maximum(beyond / REACH, 1e-12), 1e-12)
    for states, side in (((_HU1, _HU2, _HU3), at > 0), ((_HD1, _HD2, _HD3), at < 0)):
        for s in states:
            e[..., s] = np.where(side, np.maximum(half / REACH, 1e-12), 1e-12)
    # a stuck reading says nothing of the source, so its departure counts neither way
    stuck = np.maximum(e[..., : _K1].max(axis=-1), 1e-12)
    e[..., :_K1] *= np.where(equal, own.coincidence, 1.0 - own.coincidence)[..., None]
    for s in (_K1, _K2, _K3):
        e[..., s] = np.where(equal, stuck, 0.0)
    e[..., _O] = 0.0
    e[out] = 0.0
    e[out, _O] = 1.0
    # three periods of a movement, or three equal steps, are three readings in a row
    e[~known] = 1.0
    e[~known, _HU1 : _K3 + 1] = 0.0
    return e / e.max(axis=-1, keepdims=True)


def _posterior(e: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Forward-backward state probabilities of many sources at once (sources, periods, states)."""
    n, steps, k = e.shape
    forward, backward = np.empty_like(e), np.ones_like(e)
    at = entry * e[:, 0]
    forward[:, 0] = at / at.sum(axis=1, keepdims=True)
    for t in range(1, steps):
        before = forward[:, t - 1]
        at = (before @ _SHARED + (before @ _FREE)[:, None] * entry) * e[:, t]
        forward[:, t] = at / at.sum(axis=1, keepdims=True)
    backward[:, -1, _UNFINISHED] = 0.0
    for t in range(steps - 2, -1, -1):
        after = backward[:, t + 1] * e[:, t + 1]
        at = after @ _SHARED.T + _FREE * (after * entry).sum(axis=1, keepdims=True)
        backward[:, t] = at / at.sum(axis=1, keepdims=True)
    joint = forward * backward
    return joint / joint.sum(axis=2, keepdims=True)


def _reestimate(p: np.ndarray, z: np.ndarray, equal: np.ndarray, known: np.ndarray) -> _Source:
    """Step of Baum-Welch: noise, coincidences and entries from the state probabilities, next to what is expected of any source."""
    usual = np.where(known & ~np.isnan(z), p[..., _N], 0.0)
    weight = usual.sum(axis=1, keepdims=True)
    noise = ((usual * np.abs(np.nan_to_num(z))).sum(axis=1, keepdims=True) + 0.05 * 5) / (weight + 5)
    coincidence = ((usual * equal).sum(axis=1, keepdims=True) + COINCIDENCE * PRIOR_PERIODS) / (weight + PRIOR_PERIODS)
    entry = np.zeros((len(p), STATES))
    periods = known.sum(axis=1)
    seen = np.where(known[..., None], p, 0.0).sum(axis=1)
    for state, share in _ENTRIES.items():
        entry[:, state] = (seen[:, state] + share * PRIOR_PERIODS) / (periods + PRIOR_PERIODS)
    entry[:, _N] = 1.0 - entry.sum(axis=1)
    return _Source(np.clip(noise, LEAST_NOISE, 0.25), np.minimum(coincidence, 0.1), entry)


def _flag_matrix(v: np.ndarray, known: np.ndarray, network: np.ndarray, phase: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Flag (as int) and its probability of each cell; rows are sources, columns consecutive periods."""
    out = known & ((v < rule.lower) | (v > rule.upper))
    equal = np.zeros(v.shape, dtype=bool)
    equal[:, 1:] = known[:, 1:] & known[:, :-1] & (v[:, 1:] == v[:, :-1])
    back = np.ones_like(network) if rule.ratio else np.exp(network)
    usual = np.median(network, axis=1, keepdims=True)
    apart = np.abs(network - usual) > np.log(3.0)

    def departures(usable: np.ndarray, spikes: np.ndarray) -> np.ndarray:
        """What departs from the surroundings, in limits, after the network's movement and the returning season."""
        x = np.where(usable, np.log(np.maximum(np.where(usable, v, 1.0), 0.5)) - network if rule.ratio else v / back, np.nan)
        calm = x - _season(_departure(x, x), phase, rule.season)
        z = _departure(calm, np.where(spikes, np.nan, calm)) * back
        # where the network makes a jump of its own, a source that does not follow it is no spike
        own = network - usual if rule.ratio else (1.0 - np.exp(usual) / back) * np.where(np.isnan(x), 0.0, x) * back
        return np.where(apart & (np.abs(z + own) < np.abs(z)), z + own, z) / rule.jump

    usable, spikes = known & ~out, np.zeros(v.shape, dtype=bool)
    z = departures(usable, spikes)
    source = _first_guess(z)
    for step in range(EM_STEPS + 1):
        p = _posterior(_emissions(z, source, equal, out, known), source.entry)
        if step < EM_STEPS:
            # what stands out does not count for what is expected
            spikes = known & (p[..., _N] < 0.5)
            stuck = p[..., _FLAG == STUCK].sum(axis=-1) > 0.5
            z = departures(usable & ~stuck, spikes)
            source = _reestimate(p, z, equal, known)
    by_flag = np.stack([p[..., _FLAG == f].sum(axis=-1) for f in (NORMAL, SPIKE, STUCK, OUT)], axis=-1)
    flag = np.where(known, by_flag.argmax(axis=-1), NORMAL)
    return flag, np.take_along_axis(by_flag, flag[..., None], axis=-1)[..., 0]


def _chunks(first: np.ndarray, last: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of sources whose matrix holds at most ``CELLS`` cells (or one source)."""
    a, lo, hi = 0, 0, 0
    for k in range(len(first)):
        lo, hi = (first[k], last[k]) if k == a else (min(lo, first[k]), max(hi, last[k]))
        if k > a and (k + 1 - a) * (hi - lo + 1) > CELLS:
            yield a, k
            a, lo, hi = k, first[k], last[k]
    if len(first):
        yield a, len(first)


_FLAGGED = ["measure", "source", "period", "value", "flag", "probability"]


def _flag_rows(rows: pd.DataFrame, rules: dict[str, Rule]) -> pd.DataFrame:
    """Flags of whole sources; rows are in the order of measure, source, block and period."""
    names = np.array(["normal", "spike", "stuck", "out_of_range"])
    parts = []
    for measure, own in rows.groupby("measure", sort=False):
        source, block = own["source"].to_numpy(), own["__b"].to_numpy()
        p, v, g = own["period"].to_numpy(), own["value"].to_numpy(float), np.nan_to_num(own["network"].to_numpy(float))
        starts = np.flatnonzero(np.r_[True, (source[1:] != source[:-1]) | (block[1:] != block[:-1])])
        ends = np.r_[starts[1:], len(p)]
        for a, b in _chunks(p[starts], p[ends - 1]):
            take = slice(starts[a], ends[b - 1])
            i = np.repeat(np.arange(b - a), (ends - starts)[a:b])
            t0 = int(p[take].min())
            t = p[take] - t0
            shape = (b - a, int(t.max()) + 1)
            m, path = np.full(shape, np.nan), np.zeros(shape[1])
            m[i, t] = v[take]
            path[t] = g[take]
            rule = rules[measure]
            flag, probability = _flag_matrix(m, ~np.isnan(m), np.broadcast_to(path, shape), (np.arange(shape[1]) + t0) % rule.season, rule)
            f = flag[i, t]
            # a block answers for its own periods only
            bad = (f != NORMAL) & (p[take] // BLOCK == block[take])
            parts.append(pd.DataFrame({"measure": measure, "source": source[take][bad], "period": p[take][bad], "value": v[take][bad], "flag": names[f[bad]], "probability": probability[i, t][bad]}))
    return pd.concat(parts) if parts else pd.DataFrame({c: [] for c in _FLAGGED})


def _flag_batches(rules: dict[str, Rule]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        with warnings.catch_warnings(), np.errstate(all="ignore"):
            warnings.simplefilter("ignore", RuntimeWarning)
            for pdf in batches:
                held.append(pdf)
                if sum(map(len, held)) < ROWS:
                    continue
                rows = pd.concat(held, ignore_index=True)
                final = (rows[["measure", "source", "__b"]] == rows[["measure", "source", "__b"]].iloc[-1]).all(axis=1).to_numpy()
                open_from = len(rows) - int(final[::-1].argmin()) if not final.all() else 0
                if open_from:
                    yield _flag_rows(rows.iloc[:open_from], rules).astype({"period": "int32"})
                held = [rows.iloc[open_from:]]
            if held and sum(map(len, held)):
                yield _flag_rows(pd.concat(held, ignore_index=True), rules).astype({"period": "int32"})

    return run


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Rows by source and block (``__b``), each block with ``HALO`` periods of its neighbours; one exchange for all who read them."""
    number = lambda shift: F.floor((F.col("period") + shift) / F.lit(BLOCK)).cast("int")
    return rows.withColumn("__b", F.explode(F.sequence(number(-HALO), number(HALO)))).repartition("measure", "source", "__b")


def network_path(rows: DataFrame, rules: dict[str, Rule], least: int = 8) -> DataFrame:
    """Common movement of all sources: (measure, period, network), a logarithm, one row per period.

    ``rows`` come from :func:`_in_blocks`.  The median over all sources of the change against the period before, from counts
    in bins of ``BIN`` (all rows, map-side combined), summed up along the calendar.
    Periods with fewer than ``least`` pairs of readings count as no movement.
    """
    bounds = F.lit(False)
    for m, r in rules.items():
        top = F.lit(True) if np.isinf(r.upper) else F.col("value") <= r.upper
        bounds = bounds | ((F.col("measure") == m) & (F.col("value") > max(r.lower, 0.0)) & top)
    by = Window.partitionBy("measure", "source", "__b").orderBy("period")
    log = F.when(bounds, F.log("value"))
    steps = rows.select("measure", "period", "__b", (log - F.lag(log).over(by)).alias("d"), (F.col("period") - F.lag("period").over(by)).alias("gap"))
    steps = steps.where(f"gap = 1 AND d IS NOT NULL AND floor(period / {BLOCK}) = __b")
    bins = steps.groupBy("measure", "period", F.round(F.col("d") / BIN).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    per = Window.partitionBy("measure", "period")
    ranked = bins.withColumn("upto", F.sum("n").over(per.orderBy("bin"))).withColumn("all", F.sum("n").over(per))
    medians = ranked.where("upto * 2 >= all AND all >= %d" % least).groupBy("measure", "period").agg((F.min("bin") * BIN).alias("d"))
    along = Window.partitionBy("measure").orderBy("period").rowsBetween(Window.unboundedPreceding, 0)  # one row per period
    return medians.select("measure", "period", F.sum("d").over(along).alias("network"))


def flag_implausible(readings: DataFrame, rules: dict[str, Rule]) -> DataFrame:
    """Implausible readings, judged against the same source.

    ``readings`` has one row per ``measure, source, period`` (see
    :func:`flightloom.sources.tables.rows_that_count`) with a ``value``.  Result:
    ``measure, source, period, value, flag (spike, stuck or out_of_range), probability``.

    A null value is no reading and ends a run of equal ones; rows without source,
    period or a measure with a rule are left out; an empty table gives no flags;
    of repeated rows of a period one counts; other columns are left out.  A source with
    too few readings to tell what is usual is only tested for bounds and equal runs.

    Every source is a hidden Markov chain with the states normal, spike, stuck and
    out-of-range, spelled out by duration.  Emissions compare a reading with the readings around it,
    after the network's movement and the source's returning season are taken out.  Noise, coincidences
    and entries are estimated per source by ``EM_STEPS`` of Baum-Welch; the flag is the state that is
    most probable by forward-backward, with the hard bounds as the only emission of the out-of-range state.

    A source is cut into blocks of ``BLOCK`` periods with ``HALO`` periods of their neighbours; sorted
    rows are read in batches, and matrices hold at most ``CELLS`` cells, so memory follows neither the rows nor the
    span of the calendar.
    """
    known = [m for m in rules]
    base = readings.select("measure", "source", F.col("period").cast("int").alias("period"), F.col("value").cast("double").alias("value"))
    base = base.where(F.col("measure").isin(known) & F.col("source").isNotNull() & F.col("period").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value"))
    rows = _in_blocks(base)
    # one row per measure and period of the calendar
    placed = rows.join(F.broadcast(network_path(rows, rules)), ["measure", "period"], "left").sortWithinPartitions("measure", "source", "__b", "period")
    schema = "measure string, source string, period int, value double, flag string, probability double"
    return placed.select("measure", "source", "__b", "period", "value", "network").mapInPandas(_flag_batches(rules), schema)
