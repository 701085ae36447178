"""Schemas that drift between files: edit scripts and one consistent table."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field, replace
from statistics import median

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ADD, DELETE, RENAME, MOVE = 1.0, 1.0, 0.6, 0.1
RETYPE = 0.3
#: A pairing of unlike labels this dear is worth less than a deletion and an addition.
NEVER = 99.0
#: What known labels, word stems and values add to the cost of a renaming.
SAME_FIELD, OTHER_FIELD, NO_STEM, UNKNOWN = -0.4, 0.8, 0.4, 0.5
OTHER_UNIT, SHIFTED, SCATTERED, NO_VALUES, MOST = 0.25, 1.5, 2.0, 0.7, 1.6
#: Groups of rows (by a hash of their keys) whose mean sizes stand for the values of a column.
GROUPS = 8


@dataclass(frozen=True)
class Node:
    """A field of a nested schema: label, meaning (a known field or none), type, children."""

    label: str
    meaning: str | None = None
    kind: str = ""
    #: mean logarithm of the numbers in each group of rows, none where there are none
    values: tuple[float | None, ...] = ()
    children: tuple["Node", ...] = field(default=())


@dataclass(frozen=True)
class Edit:
    op: str
    path: str
    old: Node | None
    new: Node | None


def squash(label: str | None) -> str:
    """A label without regard to case, blanks and punctuation."""
    return re.sub(r"[^a-z0-9]", "", (label or "").lower())


def snake(label: str | None) -> str:
    """A label in lower case, each run of other characters than letters and digits one underscore."""
    return re.sub(r"[^a-z0-9]+", "_", (label or "").lower()).strip("_")


def assign(cost: list[list[float]]) -> list[int]:
    """Cheapest assignment of rows to distinct columns (rows <= columns), by shortest augmenting paths."""
    n, m = len(cost), len(cost[0]) if cost else 0
    u, v, owner = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1)
    for row in range(1, n + 1):
        owner[0], at = row, 0
        least, back, done = [float("inf")] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while True:
            done[at] = True
            i, step, to = owner[at], float("inf"), 0
            for j in range(1, m + 1):
                if not done[j]:
                    c = cost[i - 1][j - 1] - u[i] - v[j]
                    if c < least[j]:
                        least[j], back[j] = c, at
                    if least[j] < step:
                        step, to = least[j], j
            for j in range(m + 1):
                if done[j]:
                    u[owner[j]] += step
                    v[j] -= step
                else:
                    least[j] -= step
            at = to
            if owner[at] == 0:
                break
        while at:
            owner[at] = owner[back[at]]
            at = back[at]
    out = [-1] * n
    for j in range(1, m + 1):
        if owner[j]:
            out[owner[j] - 1] = j - 1
    return out


def weight(node: Node) -> int:
    return 1 + sum(weight(c) for c in node.children)


def value_cost(old: Node, new: Node) -> float:
    """How unlike the values of two columns are, group by group: another level, another unit, or no common course."""
    steps = [y - x for x, y in zip(old.values, new.values) if x is not None and y is not None]
    if not steps:
        return MOST if any(v is not None for v in (*old.values, *new.values)) else NO_VALUES
    shift = median(steps)
    level = min(SHIFTED * abs(shift - k * math.log(10)) + OTHER_UNIT * (k != 0) for k in range(-3, 4))
    scatter = sum(abs(x - shift) for x in steps) / len(steps) if len(steps) > 1 else 0.5
    return min(MOST, level + SCATTERED * scatter)


def _stems(node: Node) -> set[str]:
    return {w[:4] for x in (node.label, node.meaning or "") for w in snake(x).split("_") if len(w) > 1}


def relabel_cost(old: Node, new: Node) -> float:
    """Cost of turning one label into another.

    Like labels cost nothing.  Unlike ones cost a renaming, more the less their values have in common; that both are known for one
    field makes it cheaper, that they are known for two or share no word stem makes it dearer.
    """
    cost = RETYPE * (old.kind != new.kind)
    if squash(old.label) == squash(new.label):
        return cost
    if bool(old.children) != bool(new.children):
        return NEVER
    cost += RENAME + value_cost(old, new)
    if old.meaning and new.meaning:
        return cost + (SAME_FIELD if old.meaning == new.meaning else OTHER_FIELD)
    return cost + NO_STEM * (not _stems(old) & _stems(new)) + UNKNOWN * (not old.meaning and not new.meaning)


def edit_distance(old: Node, new: Node, path: str = "") -> tuple[float, list[Edit]]:
    """Cheapest script of add, delete, rename, retype and move between two nested schemas.

    Constrained tree edit distance: nodes are paired level by level, a paired node's children
    with its partner's.  The order of children does not count for the pairing;
    pairs out of order are reported as moves at a small cost.
    """
    a, b = list(old.children), list(new.children)
    best: dict[tuple[int, int], tuple[float, list[Edit]]] = {}
    pairs: dict[int, int] = {}
    taken: set[int] = set()
    # pairs that cost nothing are part of some cheapest script
    where: dict[tuple, list[int]] = {}
    for j, x in enumerate(b):
        where.setdefault((squash(x.label), x.kind, x.children), []).append(j)
    for i, x in enumerate(a):
        same = where.get((squash(x.label), x.kind, x.children))
        if same:
            pairs[i] = same.pop(0)
            taken.add(pairs[i])
    left, right = [i for i in range(len(a)) if i not in pairs], [j for j in range(len(b)) if j not in taken]
    if left or right:
        n, m = len(left), len(right)
        cost = [[0.0] * (n + m) for _ in range(n + m)]
        for r in range(n + m):
            for c in range(n + m):
                if r < n and c < m:
                    x, y = a[left[r]], b[right[c]]
                    here = relabel_cost(x, y)
                    below = edit_distance(x, y, f"{path}/{y.label}") if here < NEVER and (x.children or y.children) else (0.0, [])
                    best[r, c] = (here + below[0], below[1])
                    cost[r][c] = best[r, c][0]
                elif r < n:
                    cost[r][c] = DELETE * weight(a[left[r]]) if c - m == r else NEVER * 10
                elif c < m:
                    cost[r][c] = ADD * weight(b[right[c]]) if r - n == c else NEVER * 10
        for r, c in enumerate(assign(cost)):
            if r < n and c < m and best[r, c][0] < NEVER:
                pairs[left[r]] = right[c]
    total, script = 0.0, []
    for i, j in sorted(pairs.items(), key=lambda x: x[1]):
        x, y = a[i], b[j]
        at = f"{path}/{y.label}"
        if squash(x.label) != squash(y.label):
            total += RENAME
            script.append(Edit("rename", at, x, y))
        if x.kind != y.kind:
            total += RETYPE
            script.append(Edit("retype", at, x, y))
        if x.children or y.children:
            more, edits = edit_distance(x, y, at)
            total += more
            script += edits
    gone = set(range(len(a))) - set(pairs)
    fresh = set(range(len(b))) - set(pairs.values())
    # moves: pairs outside the longest run that kept its order
    order = [i for i, _ in sorted(pairs.items(), key=lambda x: x[1])]
    tails: list[tuple[int, int]] = []
    length: dict[int, int] = {}
    for i in order:
        length[i] = 1 + max((n for k, n in tails if k < i), default=0)
        tails.append((i, length[i]))
    keep, need, last = set(), max(length.values(), default=0), float("inf")
    for i in reversed(order):
        if length[i] == need and i < last:
            keep.add(i)
            need, last = need - 1, i
    for i in order:
        if i not in keep:
            total += MOVE
            script.append(Edit("move", f"{path}/{b[pairs[i]].label}", a[i], b[pairs[i]]))
    for i in sorted(gone):
        total += DELETE * weight(a[i])
        script.append(Edit("delete", f"{path}/{a[i].label}", a[i], None))
    for j in sorted(fresh):
        total += ADD * weight(b[j])
        script.append(Edit("add", f"{path}/{b[j].label}", None, b[j]))
    return total, script


@dataclass(frozen=True)
class Target:
    """The table into which all files are read: key headers, and the headers known for each field."""

    keys: tuple[str, ...]
    aliases: dict[str, tuple[str, ...]]
    #: factor from the unit named in a header to that of the table
    units: dict[str, float] = field(default_factory=dict)
    #: fields in which a lone comma is a decimal comma
    comma_decimals: tuple[str, ...] = ()

    def lookup(self) -> dict[str, str]:
        return {squash(h): f for f, hs in self.aliases.items() for h in (f, *hs)}


def file_columns(sheets: DataFrame, target: Target, file: str = "file", row: str = "row_idx", cells: str = "cells") -> DataFrame:
    """The columns of each file below its header row: (file, pos, header, kind, values).

    The header row is the first one whose leading cells are the key headers, whatever their
    case and blanks; files without one have no columns.  ``kind`` is ``whole`` if all
    cells with a value are digits only (also if there are none), ``decimal`` if all are digits with or without a
    point, else ``text``; ``-``, ``n/a``, blank and null cells have no value.  ``values``
    is the mean logarithm of the numbers in each of ``GROUPS`` groups of rows, told by the first two key columns.
    """
    # the header row itself, without its cells, stands for columns above no row or rows that are too short
    body = with_header(sheets, target, file, row, cells, keep_header=True)
    value = F.trim(F.col("cell"))
    has = value.isNotNull() & ~F.lower(value).isin("", "-", "n/a")
    number = F.regexp_replace(F.regexp_extract(value, r"^[\d.,]+", 0), ",", "").try_cast("double")
    key = [F.coalesce(F.lower(F.trim(F.get("cells", F.lit(k)))), F.lit("")) for k in range(min(2, len(target.keys)))]
    exploded = body.select("file", "header", F.pmod(F.xxhash64(*key), F.lit(GROUPS)).alias("group"), F.posexplode("cells").alias("pos", "cell"))
    named = exploded.where(F.col("pos") < F.size("header")).select("file", "pos", F.get("header", F.col("pos")).alias("header"), "group", "cell")
    return named.groupBy("file", "pos", "header").agg(
        F.when(F.coalesce(F.bool_and(F.when(has, value.rlike(r"^\d+$"))), F.lit(True)), "whole")
        .when(F.bool_and(F.when(has, value.rlike(r"^\d+(\.\d*)?$|^\.\d+$"))), "decimal")
        .otherwise("text")
        .alias("kind"),
        F.array(*(F.avg(F.when((F.col("group") == g) & has & (number > 0), F.log(number))) for g in range(GROUPS))).alias("values"),
    )


def with_header(sheets: DataFrame, target: Target, file: str = "file", row: str = "row_idx", cells: str = "cells", keep_header: bool = False) -> DataFrame:
    """Data rows with the header of their file: (file, row_idx, cells, header).

    Headers are one row per file; they meet the rows in a join, which Spark can
    broadcast or split at a hot file, and not in a window over whole files.
    """
    base = sheets.select(F.col(file).alias("file"), F.col(row).cast("int").alias("row_idx"), F.col(cells).alias("cells")).where("file IS NOT NULL AND row_idx IS NOT NULL AND cells IS NOT NULL").distinct()
    is_header = F.lit(True)
    for k, name in enumerate(target.keys):
        is_header = is_header & (F.lower(F.trim(F.get("cells", F.lit(k)))) == name)
    headers = base.where(is_header).groupBy("file").agg(F.min_by("cells", "row_idx").alias("header"), F.min("row_idx").alias("__h"))
    joined = base.join(headers, "file")
    if keep_header:
        blank = F.transform("header", lambda _: F.lit(None).cast("string"))
        joined = joined.withColumn("cells", F.when(F.col("row_idx") == F.col("__h"), blank).otherwise(F.col("cells")))
    return joined.where("row_idx >= __h" if keep_header else "row_idx > __h").drop("__h")


def _named(leaves: list[Node], fields: dict[str, str], target: Target) -> list[Node]:
    """Meanings of columns that no script has told: by the script from the table's own schema to what is left of the file.

    Only a header that is known for a field or holds all words of its name can stand for it.
    """
    taken = {x.meaning for x in leaves if x.meaning}
    absent = [f for f in target.aliases if f not in taken]
    out, used = list(leaves), set()
    for i, x in enumerate(leaves):
        if x.meaning:
            continue
        words = set(snake(x.label).split("_"))
        means = fields.get(squash(x.label)) or next((f for f in absent if set(f.split("_")) <= words), None)
        if means in absent and means not in used:
            used.add(means)
            out[i] = replace(x, meaning=means)
    return out


def _read_feed(target: Target, pdf: pd.DataFrame):
    """Each file of a feed in the order of time: its columns with their fields, the edit script from the file before it, and positions.

    Fields travel along the scripts: a column that a script pairs with one of the file before stands for the same field, and goes
    before a known header of that field next to it.
    """
    known = target.lookup()
    before: Node | None = None
    past: dict[str, str] = {}
    for row in pdf.sort_values("p", kind="stable").itertuples(index=False):
        leaves, places, seen = [], [], set()
        for c in sorted(row.columns, key=lambda c: c["pos"]):
            key = squash(c["header"])
            if not key or key in seen:
                continue
            seen.add(key)
            values = () if c["values"] is None else tuple(None if v is None or v != v else float(v) for v in c["values"])
            # known headers and those of the feed's past help the cost, they do not decide
            leaves.append(Node(c["header"], known.get(key) or past.get(key), c["kind"], values))
            places.append(c["pos"])
        now, script = Node(row.file, children=tuple(leaves)), []
        told: list[Node] = [replace(x, meaning=None) for x in leaves]
        if before is not None:
            _, script = edit_distance(before, now)
            kept = {squash(x.label): x for x in before.children}
            pairs = {squash(e.new.label): e.old for e in script if e.op == "rename"}
            for i, x in enumerate(leaves):
                of = pairs.get(squash(x.label)) or kept.get(squash(x.label))
                if of is not None and of.meaning not in {t.meaning for t in told}:
                    told[i] = replace(x, meaning=of.meaning)
        told = _named(told, {**past, **known}, target)
        past |= {squash(x.label): x.meaning for x in told if x.meaning}
        now = Node(row.file, children=tuple(told))
        yield now, script, places
        before = now


def _feed_changes(target: Target):
    def changes(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        before: dict[str, Node] = {}
        for now, script, _ in _read_feed(target, pdf):
            own = {squash(x.label): x for x in now.children}
            for e in script:
                end = own[squash(e.new.label)] if e.new else before[squash(e.old.label)]
                out.append((now.label, end.meaning or snake(end.label), _KINDS[e.op], e.old and e.old.label, e.new and e.new.label, e.old and e.old.kind, e.new and e.new.kind))
            before = own
        return pd.DataFrame(out, columns=["file", "field", "change_kind", "old_header", "new_header", "old_type", "new_type"])

    return changes


def _feed_projections(target: Target):
    def projections(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [(now.label, x.meaning, x.label, int(at)) for now, _, places in _read_feed(target, pdf) for x, at in zip(now.children, places) if x.meaning]
        return pd.DataFrame(out, columns=["file", "field", "header", "pos"])

    return projections


_KINDS = {"add": "added", "delete": "removed", "rename": "renamed", "retype": "retyped", "move": "moved"}
_CHANGES = "file string, field string, change_kind string, old_header string, new_header string, old_type string, new_type string"


def schema_changes(columns: DataFrame, target: Target, feed: Column, period: Column) -> DataFrame:
    """Every change of each file against the file before it in the same feed.

    ``columns`` comes from :func:`file_columns`; ``feed`` and ``period`` are taken from
    the file name.  Result: ``file, field, change_kind (added, removed, renamed,
    retyped or moved), old_header, new_header, old_type, new_type``.  Key columns are no
    fields; a header given twice in a file counts once; a feed's first file and
    an empty table have no changes.

    One small row per file reaches Python; a feed has at most one file per period.
    """
    return _by_feed(columns, target, feed, period).applyInPandas(_feed_changes(target), _CHANGES)


def projections(columns: DataFrame, target: Target, feed: Column, period: Column) -> DataFrame:
    """The projection of each file onto the fields of the table, compiled from the scripts of its feed: (file, field, header, pos).

    Arguments as for :func:`schema_changes`.  A file without feed or period stands alone.
    """
    alone = lambda c: c.withColumn("feed", F.coalesce("feed", F.concat(F.lit("\x00"), F.col("file")))).withColumn("p", F.coalesce("p", F.lit(0)))
    return _by_feed(columns, target, feed, period, alone).applyInPandas(_feed_projections(target), "file string, field string, header string, pos int")


def _by_feed(columns: DataFrame, target: Target, feed: Column, period: Column, mend=lambda c: c):
    fields = columns.where(~F.lower(F.trim("header")).isin(list(target.keys)))
    per_file = fields.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("pos", "header", "kind", "values"))).alias("columns"))
    return mend(per_file.withColumn("feed", feed).withColumn("p", period)).where("feed IS NOT NULL AND p IS NOT NULL").groupBy("feed")


def consistent_table(sheets: DataFrame, target: Target, compiled: DataFrame) -> DataFrame:
    """All files in one table: file, row_idx, the key columns as text, and one double per field.

    ``compiled`` (see :func:`projections`) says at which position of a file each field stands; a field without position is null.
    Units named in a header are converted, percent signs, unit words and
    thousands separators are read over, and cells without a value are null.
    """
    factor = F.lit(1.0)
    for h, unit in target.units.items():
        factor = F.when(F.regexp_replace(F.lower("header"), "[^a-z0-9]", "") == squash(h), F.lit(unit)).otherwise(factor)
    # one row per file: where each field stands, and its factor
    places = compiled.groupBy("file").agg(*(F.min_by(F.struct("pos", factor.alias("factor")), F.when(F.col("field") == name, F.col("pos"))).alias(f"__{name}") for name in target.aliases))
    body = with_header(sheets, target).join(places, "file", "left")
    out = []
    for name in target.aliases:
        cell = F.trim(F.get("cells", F.col(f"__{name}.pos")))
        number = F.regexp_extract(cell, r"^[\d.,]+", 0)
        plain = F.replace(number, F.lit(","), F.lit("." if name in target.comma_decimals else ""))
        out.append((plain.try_cast("double") * F.col(f"__{name}.factor")).alias(name))
    keys = [F.trim(F.get("cells", F.lit(k))).alias(n) for k, n in enumerate(target.keys)]
    return body.select("file", "row_idx", *keys, *out)
