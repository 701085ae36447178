"""Column-level data quality profile, and which loads depart from the rest."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from flightloom.session import cut_lineage

#: Significant digits to which medians are kept; bounds the state of a column.
DIGITS = 3
#: Discrimination (area under the curve) from which a load counts as different, and the part of it that a column must explain.
DIFFERENT, EXPLAINS = 0.60, 0.02


@dataclass(frozen=True)
class ColumnCheck:
    """Expectations on a numeric column: domain, and the unit of its last digit (``None``: no digit test)."""

    column: str
    lower: float | None = None
    upper: float | None = None
    last_digit_unit: float | None = None


@dataclass(frozen=True)
class Limits:
    """Shares and factors beyond which a load goes wrong."""

    nulls: float = 0.10
    domain: float = 0.02
    scale: float = 5.0
    precision: float = 0.80


def load_cells(df: DataFrame, table: str, load: str, checks: list[ColumnCheck]) -> DataFrame:
    """Counts of like cells per column and load: the sufficient statistics of every profile.

    One pass over the named columns and one aggregate with map-side combine.  Each cell is
    counted by its ``value``, that is its sign and its magnitude to ``DIGITS`` significant
    digits, and apart from that (``value`` null) by its last digit, with nulls, values outside
    the domain and the range.  By both at once nearly every cell of a task would be its own
    kind and go through the shuffle.
    """
    def cell(c: ColumnCheck):
        v = F.col(c.column).cast("double")
        bad = F.lit(False)
        if c.lower is not None:
            bad = bad | (v < c.lower)
        if c.upper is not None:
            bad = bad | (v > c.upper)
        decade = F.floor(F.log10(F.abs(v))) - (DIGITS - 1)
        rounded = F.when(v == 0, F.lit(0.0)).otherwise(F.round(v / F.pow(F.lit(10.0), decade)) * F.pow(F.lit(10.0), decade))
        digit = F.lit(None).cast("int") if c.last_digit_unit is None else (F.round(F.abs(v) / F.lit(c.last_digit_unit)).cast("long") % 10).cast("int")
        none, outside = F.lit(None), F.coalesce(bad, F.lit(False)).cast("int")
        fields = lambda sized, value, digit, outside, raw: F.struct(
            F.lit(c.column).alias("column_name"), F.lit(sized).alias("sized"), value.cast("double").alias("value"), digit.cast("int").alias("digit"), outside.alias("outside"), raw.cast("double").alias("raw")
        )
        return [fields(True, F.round(rounded, 9), none, F.lit(0), none), fields(False, none, digit, outside, v)]

    rows = df.select(F.col(load).cast("int").alias("load_no"), F.explode(F.array(*(x for c in checks for x in cell(c)))).alias("c")).where("load_no IS NOT NULL AND (NOT c.sized OR c.value IS NOT NULL)")
    return (
        rows.select(F.lit(table).alias("table_name"), "c.column_name", "load_no", "c.value", "c.digit", "c.outside", "c.raw")
        .groupBy("table_name", "column_name", "load_no", "value", "digit")
        .agg(F.count(F.lit(1)).alias("n"), F.count("raw").alias("filled"), F.sum("outside").alias("outside"), F.min("raw").alias("least"), F.max("raw").alias("most"))
    )


def _others(cells: DataFrame) -> DataFrame:
    """Median of each load and of all rows of other loads, per table and column: (..., median, median_of_others).

    Values are kept to ``DIGITS`` significant digits, so a column has a bounded number of them; every load
    is laid over all values of its column, and running counts give both ranks.
    """
    column, load = ["table_name", "column_name"], ["table_name", "column_name", "load_no"]
    own = cells.where("value IS NOT NULL").groupBy(*load, "value").agg(F.sum("n").alias("own"))
    values = own.groupBy(*column, "value").agg(F.sum("own").alias("every"))
    # loads of nulls have other loads too
    grid = cells.select(*load).distinct().join(values, column).join(own, [*load, "value"], "left").withColumn("own", F.coalesce("own", F.lit(0)))
    grid = grid.withColumn("other", F.col("every") - F.col("own"))
    upto, whole = Window.partitionBy(*load).orderBy("value").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*load)
    ranked = grid
    for c in ("own", "other"):
        ranked = ranked.withColumn(f"{c}_upto", F.sum(c).over(upto)).withColumn(f"{c}_all", F.sum(c).over(whole))

    def median(c: str):
        # the mean of the middle two if the number of rows is even
        at = lambda rank: F.min(F.when((F.col(f"{c}_all") > 0) & (F.col(f"{c}_upto") >= rank), F.col("value")))
        return (at(F.floor((F.col(f"{c}_all") + 1) / 2)) + at(F.floor(F.col(f"{c}_all") / 2) + 1)) / 2

    return ranked.groupBy(*load).agg(median("own").alias("median"), median("other").alias("median_of_others"))


def base_profile(cells: DataFrame) -> DataFrame:
    """Exact base aggregates per table, column and load, from :func:`load_cells` (a union over tables is fine).

    Counts of rows, nulls and values outside the domain, least and greatest value, the
    median of the load and of all other loads (to ``DIGITS`` significant digits), and the share
    of the commonest last digit.  Rows without a load are left out, repeated rows count as
    they come, a load of nulls has no median, an empty table gives no rows.

    Counts of like cells are few however many rows there are; they are written once and read for each figure.
    """
    cells = cut_lineage(cells)
    load = ["table_name", "column_name", "load_no"]
    figures = cells.where("value IS NULL").groupBy(*load).agg(
        F.sum("n").alias("n_rows"),
        (F.sum("n") - F.sum("filled")).alias("n_null"),
        F.sum("outside").alias("n_outside"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    )
    digits = cells.where("digit IS NOT NULL").groupBy(*load, "digit").agg(F.sum("n").alias("n")).groupBy(*load).agg((F.max("n") / F.sum("n")).alias("top_digit_share"))
    return figures.join(_others(cells), load, "left").join(digits, load, "left").select(*load, "n_rows", "n_null", "n_outside", "least", "most", "median", "median_of_others", "top_digit_share")


# --- classifier two-sample test ---------------------------------------------------------------

#: Features of a column, by the kind of change that they show: null, outside the domain, size and its square, ten last digits.
KINDS = {"nulls": slice(0, 1), "domain": slice(1, 2), "scale": slice(2, 4), "precision": slice(4, 14)}
PER_COLUMN = 14
#: Rows of a load and table on which the models are fitted, about, drawn by a hash of the row; all rows are scored.
FITTED_ROWS = 10_000
STEPS, RIDGE = 3, 1e-3
#: Rows of the sample in a partition.
ROWS_PER_TASK = 25_000
#: Scores are counted in bins of this width (in logits) up to this many on either side.
SCORE_BIN, SCORE_BINS = 0.15, 32
#: Models trained in one pass; more loads are worked off in several passes.
LOADS_PER_PASS = 128


def features(df: DataFrame, table: str, load: str, checks: list[ColumnCheck], identity: list[str]) -> DataFrame:
    """What the classifier reads of each row: (table_name, load_no, fold, u, f).

    ``f`` holds per column whether it is null, outside its domain, its signed logarithmic size, and its
    last digit (-1 for none).  ``fold`` and the uniform number ``u`` are hashes of the row's identity, so repeated rows stay together.
    """
    def cells(c: ColumnCheck):
        v = F.col(c.column).cast("double")
        bad = F.lit(False)
        if c.lower is not None:
            bad = bad | (v < c.lower)
        if c.upper is not None:
            bad = bad | (v > c.upper)
        digit = F.lit(-1) if c.last_digit_unit is None else F.coalesce((F.round(F.abs(v) / F.lit(c.last_digit_unit)).cast("long") % 10).cast("int"), F.lit(-1))
        return [v.isNull(), F.coalesce(bad, F.lit(False)), F.coalesce(F.signum(v) * F.log1p(F.abs(v)), F.lit(0.0)), digit]

    code = F.xxhash64(*identity)
    u = (F.shiftrightunsigned(code, 12).cast("double") + 0.5) / F.lit(float(2**52))
    f = F.array(*(x.cast("float") for c in checks for x in cells(c)))
    return df.select(F.lit(table).alias("table_name"), F.col(load).cast("int").alias("load_no"), F.pmod(code, F.lit(2)).cast("int").alias("fold"), u.alias("u"), f.alias("f")).where("load_no IS NOT NULL")


def _design(f: pd.Series) -> np.ndarray:
    """Design matrix: an intercept, then ``PER_COLUMN`` features for each column."""
    cells = np.stack(f.to_numpy()).astype(float).reshape(len(f), -1, 4)
    size = np.where(cells[:, :, 0] > 0, 0.0, (cells[:, :, 2] - 8.0) / 4.0)
    digits = cells[:, :, 3, None] == np.arange(10)
    parts = np.concatenate([cells[:, :, :2], size[:, :, None], (size**2)[:, :, None], digits], axis=2)
    return np.hstack([np.ones((len(f), 1)), parts.reshape(len(f), -1)])


@dataclass
class _Task:
    """What every task of a pass knows of one table: the loads whose models it works on, and of all loads their rows."""

    models: np.ndarray  # loads with a model in this pass
    rows: dict[int, int]  # rows of every load
    beta: np.ndarray  # (fold, model, feature)

    @property
    def total(self) -> int:
        return sum(self.rows.values())

    @property
    def shares(self) -> tuple[np.ndarray, np.ndarray]:
        """Weight of a row of each model's load, and of one of the others, under which both weigh about 1."""
        size = np.array([self.rows[x] for x in self.models.tolist()], dtype=float)
        return 2.0 / size, 2.0 / np.maximum(self.total - size, 1.0)

    def drawn(self, load_no: np.ndarray) -> np.ndarray:
        """Rows of the load that each fitted row stands for."""
        loads, at = np.unique(load_no, return_inverse=True)
        return np.array([max(1.0, self.rows[x] / FITTED_ROWS) for x in loads.tolist()])[at]

    def weights(self, load_no: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each fitted row for each model, and its weight."""
        own = load_no[:, None] == self.models
        return own, self.drawn(load_no)[:, None] * np.where(own, *self.shares)


def _per_model(tasks: dict[str, _Task], work):
    """Sums of vectors by (table, fold, model) over a partition, added up batch by batch."""

    def run(batches):
        sums: dict[tuple[str, int, int], np.ndarray] = {}
        for pdf in batches:
            for (table, fold), part in pdf.groupby(["table_name", "fold"], sort=False):
                if table not in tasks:
                    continue
                for k, v in work(tasks[table], fold, _design(part["f"]), part["load_no"].to_numpy()):
                    key = (table, fold, k)
                    sums[key] = sums[key] + v if key in sums else v
        yield pd.DataFrame([(*k, v) for k, v in sums.items()], columns=["table_name", "fold", "k", "v"])

    return run


def _moments(task: _Task, fold: int, x: np.ndarray, load_no: np.ndarray):
    """Upper halves of the second moments of the loads that have rows here, and at -1 of all rows; every model's are a sum of both."""
    upper, drawn = np.triu_indices(x.shape[1]), task.drawn(load_no)[:, None]
    yield -1, ((x * drawn).T @ x)[upper]
    for k in np.flatnonzero(np.isin(task.models, load_no)).tolist():
        own = load_no == task.models[k]
        yield k, ((x[own] * drawn[own]).T @ x[own])[upper]


def _gradients(task: _Task, fold: int, x: np.ndarray, load_no: np.ndarray):
    own, w = task.weights(load_no)
    p = 1.0 / (1.0 + np.exp(-np.clip(x @ task.beta[fold].T, -30, 30)))
    yield from enumerate((x.T @ (w * (own - p))).T)


def _counted(score: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Counts of scores per bin, of the load and then of the others."""
    width = 2 * SCORE_BINS + 1
    bins = np.rint(np.clip(score / SCORE_BIN, -SCORE_BINS, SCORE_BINS)).astype(int) + SCORE_BINS
    return np.bincount(bins + width * ~own, minlength=2 * width).astype(float)


def _whole_scores(task: _Task, fold: int, x: np.ndarray, load_no: np.ndarray):
    score = x @ task.beta[1 - fold].T
    for k, load in enumerate(task.models):
        yield k, _counted(score[:, k], load_no == load)


def _parts(columns: int) -> list[slice]:
    """The features of each column and kind, in this order."""
    return [slice(1 + c * PER_COLUMN + kind.start, 1 + c * PER_COLUMN + kind.stop) for c in range(columns) for kind in KINDS.values()]


def _part_scores(task: _Task, fold: int, x: np.ndarray, load_no: np.ndarray):
    """Scores without each part, and with that part alone, side by side."""
    for k, load in enumerate(task.models):
        beta, own = task.beta[1 - fold][k], load_no == load
        score = x @ beta
        counts = []
        for at in _parts((x.shape[1] - 1) // PER_COLUMN):
            part = x[:, at] @ beta[at]
            counts += [_counted(score - part, own), _counted(part, own)]
        yield k, np.concatenate(counts)


def _summed(rows: DataFrame, tasks: dict[str, _Task], work) -> list[tuple[str, int, int, np.ndarray]]:
    """Per-task sums added up by model in the cluster; one vector per model comes back."""
    key = ["table_name", "fold", "k"]
    add = lambda pdf: pd.DataFrame({**{c: pdf[c].iloc[:1] for c in key}, "v": [np.sum(np.stack(pdf["v"].to_list()), axis=0)]})
    schema = "table_name string, fold int, k int, v array<double>"
    summed = rows.select("table_name", "load_no", "fold", "f").mapInPandas(_per_model(tasks, work), schema).groupBy(*key).applyInPandas(add, schema).collect()
    return [(r.table_name, r.fold, r.k, np.array(r.v)) for r in summed]


def _area(pos: np.ndarray, neg: np.ndarray) -> float:
    """Area under the curve of counts in rising score bins, ties halved."""
    total = pos.sum() * neg.sum()
    return float((pos * (np.cumsum(neg) - neg / 2)).sum() / total) if total else 0.5


def _areas(rows: DataFrame, tasks: dict[str, _Task], work) -> dict[tuple[str, int], np.ndarray]:
    """Areas by table and model, one for each pair of counts, averaged over the folds that the models have not seen."""
    by: dict[tuple[str, int], list[np.ndarray]] = {}
    for table, _, k, v in _summed(rows, tasks, work):
        by.setdefault((table, k), []).append(np.array([_area(pos, neg) for pos, neg in v.reshape(-1, 2, 2 * SCORE_BINS + 1)]))
    return {key: np.mean(a, axis=0) for key, a in by.items()}


def _fit(sample: DataFrame, tasks: dict[str, _Task]) -> None:
    """Logistic regressions by bounded Newton steps: curvature at even odds bounds every later one, so it is summed once."""
    curved, moments = {}, {(table, fold, k): v for table, fold, k, v in _summed(sample, tasks, _moments)}
    for table, fold in [key[:2] for key in moments if key[2] < 0]:
        every, d = moments[table, fold, -1], tasks[table].beta.shape[2]
        for k, (share, other) in enumerate(zip(*tasks[table].shares)):
            own = moments.get((table, fold, k), np.zeros_like(every))
            whole = np.zeros((d, d))
            whole[np.triu_indices(d)] = share * own + other * (every - own)
            whole = whole + np.triu(whole, 1).T
            curved[table, fold, k] = np.linalg.inv(whole / 4.0 + RIDGE * np.eye(d))
    for _ in range(STEPS):
        for table, fold, k, g in _summed(sample, tasks, _gradients):
            beta = tasks[table].beta[fold, k]
            beta += curved[table, fold, k] @ (g - RIDGE * beta)


_TESTED = "table_name string, column_name string, load_no int, discrimination double, " + ", ".join(f"{k}_lost double" for k in KINDS)


def discrimination(rows: DataFrame, order: dict[str, list[str]]) -> DataFrame:
    """Two-sample test of each load against all others, by table, column and load: discrimination and what each column loses it.

    ``rows`` come from :func:`features`, ``order`` names the columns of each table as they were given to it.  A logistic regression per load
    and fold is fitted on about ``FITTED_ROWS`` rows of every load; every step sums over the cluster, and only the sums reach the driver.
    All rows are scored by the model of the other fold.  ``discrimination`` is the area under the curve; a single load gives 0.5.
    Loads from ``DIFFERENT`` on are then ablated: for each column and kind of feature, ``*_lost`` is the mean of the area lost
    without it and of the area above one half that it reaches alone, so that neither a twin column nor a second fault hides it.
    Other loads have no change to explain, and null there.  Loads are worked off ``LOADS_PER_PASS`` at a time.
    """
    spark = rows.sparkSession
    sizes = rows.groupBy("table_name", "load_no").agg(F.count(F.lit(1)).alias("n")).collect()
    counts: dict[str, dict[int, int]] = {}
    for r in sizes:
        counts.setdefault(r.table_name, {})[r.load_no] = r.n
    if not counts:
        return spark.createDataFrame([], _TESTED)
    rates = spark.createDataFrame([(t, load, FITTED_ROWS / n) for t, by in sorted(counts.items()) for load, n in sorted(by.items())], "table_name string, load_no int, rate double")
    drawn = sum(min(n, FITTED_ROWS) for by in counts.values() for n in by.values())
    # folds are told by the lowest bit of the hash, the draw by its highest; rates are one row a load, and no other row is moved for them
    sample = rows.join(F.broadcast(rates), ["table_name", "load_no"]).where("u < rate").drop("rate", "u")
    sample = cut_lineage(sample.repartition(drawn // ROWS_PER_TASK + 1, "table_name", "load_no", "fold"))
    width = {t: 1 + PER_COLUMN * len(order[t]) for t in counts}
    out = []
    for low in range(0, max(map(len, counts.values())), LOADS_PER_PASS):
        part = {t: np.array(sorted(by)[low : low + LOADS_PER_PASS]) for t, by in counts.items()}
        tasks = {t: _Task(m, counts[t], np.zeros((2, len(m), width[t]))) for t, m in part.items() if len(m)}
        _fit(sample, tasks)
        whole = {key: float(a[0]) for key, a in _areas(rows, tasks, _whole_scores).items()}
        differ = {t: [k for k in range(len(task.models)) if whole[t, k] >= DIFFERENT] for t, task in tasks.items()}
        ablated = {t: _Task(tasks[t].models[k], counts[t], tasks[t].beta[:, k]) for t, k in differ.items() if k}
        parts = _areas(rows, ablated, _part_scores) if ablated else {}
        for t, task in tasks.items():
            for k, load in enumerate(task.models.tolist()):
                lost = np.full((len(order[t]), len(KINDS)), np.nan)
                if k in differ[t]:
                    without, alone = parts[t, differ[t].index(k)].reshape(len(order[t]), len(KINDS), 2).transpose(2, 0, 1)
                    lost = (whole[t, k] - without + alone - 0.5) / 2
                for column, own in zip(order[t], lost.tolist()):
                    out.append((t, column, load, whole[t, k], *(None if np.isnan(x) else x for x in own)))
    return spark.createDataFrame(out, _TESTED)


def profile_loads(base: DataFrame, tested: DataFrame) -> DataFrame:
    """Base aggregates with the load's discrimination and what each kind of feature of the column adds to it."""
    return base.join(tested, ["table_name", "column_name", "load_no"])


def load_issues(profile: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(table_name, column_name, load_no, issue_kind) of the loads that go wrong.

    Nulls and domain are bounds on the load itself, read off the base aggregates.  Changes of scale and precision are
    found by the classifier: it must tell the load apart, and ablation must lay that at the column's
    size or digits.  The exact figures of what it names then confirm the size of the change.
    """
    filled = F.col("n_rows") - F.col("n_null")
    named = lambda kind: (F.col("discrimination") >= DIFFERENT) & (F.col(f"{kind}_lost") >= EXPLAINS)
    tests = {
        "nulls": F.col("n_null") > F.col("n_rows") * limits.nulls,
        "domain": F.col("n_outside") > filled * limits.domain,
        "scale": named("scale") & ((F.col("median") > F.col("median_of_others") * limits.scale) | (F.col("median") < F.col("median_of_others") / limits.scale)),
        "precision": named("precision") & (F.col("top_digit_share") > limits.precision),
    }
    found = F.array(*(F.when(t, F.lit(k)) for k, t in tests.items()))
    return profile.select("table_name", "column_name", "load_no", F.explode(F.filter(found, lambda k: k.isNotNull())).alias("issue_kind"))


def column_profile(df: DataFrame, load: str, patterns: dict[str, str]) -> DataFrame:
    """Every column of a table per load: rows, nulls, distinct values, range and pattern violations.

    ``patterns`` gives a regular expression per column that its values, written as text,
    must match; columns without one have no violations.  Values are compared as text,
    except that least and greatest of numbers go by number.  Result: ``load_no, column_name,
    n_rows, n_null, n_distinct, n_violations, least, most`` (numbers), ``first, last`` (texts).

    Equal values fold before the shuffle; distinct counts are exact.
    """
    columns = [c for c in df.columns if c != load]
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    cell = lambda c: F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), (F.col(c) if c in numeric else F.lit(None)).cast("double").alias("number"))
    cells = F.array(*map(cell, columns))
    counted = df.select(F.col(load).alias("load_no"), F.explode(cells).alias("c")).groupBy("load_no", "c.column_name", "c.value", "c.number").agg(F.count(F.lit(1)).alias("n"))
    bad = F.lit(False)
    for c, pattern in patterns.items():
        bad = bad | ((F.col("column_name") == c) & ~F.col("value").rlike(pattern))
    text = F.when(F.col("number").isNull(), F.col("value"))
    return counted.groupBy("load_no", "column_name").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.count("value").alias("n_distinct"),
        F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)).alias("n_violations"),
        F.min("number").alias("least"),
        F.max("number").alias("most"),
        F.min(text).alias("first"),
        F.max(text).alias("last"),
    )
