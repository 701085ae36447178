"""Schema edit scripts, header changes of files, and the consistent table."""

import itertools
import math
import random
from dataclasses import replace

import pytest

from flightloom.functions import periods
from flightloom.operators.schema_drift import Node, Target, assign, consistent_table, edit_distance, file_columns, projections, relabel_cost, schema_changes, snake, squash
from pyspark.sql import functions as F

TARGET = Target(keys=("airline", "type", "year", "month"), aliases={"passengers": ("Pax",), "freight_tonnes": ("Freight", "Freight in Kg"), "load_factor": ("PLF",)}, units={"Freight in Kg": 0.001}, comma_decimals=("load_factor",))
HEAD = ["Airline", "Type", "Year", "Month"]
KEY = ["X Air", "scheduled", "2023", "1"]
SCHEMA = "file string, sheet_idx int, row_idx int, cells array<string>, header string"


def sheets(spark, files):
    rows = [(f"carrier_{feed}_{y}_{m:02d}.xlsx", 0, i, cells, "clash") for (feed, y, m), body in files.items() for i, cells in enumerate(body)]
    return spark.createDataFrame(rows, SCHEMA)


def by_feed(read, raw, target=TARGET):
    part = lambda k: F.regexp_extract("file", r"^carrier_(.+)_(\d{4})_(\d{1,2})\.xlsx$", k)
    return read(file_columns(raw, target), target, F.when(part(1) != "", part(1)), periods.month_ordinal(part(2).try_cast("int"), part(3).try_cast("int")))


def changes(spark, files, target=TARGET):
    return {(r.file[8:-5], r.field, r.change_kind) for r in by_feed(schema_changes, sheets(spark, files), target).collect() if r.change_kind != "moved"}


def table(raw, target=TARGET):
    return consistent_table(raw, target, by_feed(projections, raw, target))


def test_assignment_is_the_cheapest():
    rng = random.Random(3)
    for n in (1, 3, 5):
        cost = [[float(rng.randrange(20)) for _ in range(n + 1)] for _ in range(n)]
        best = min(sum(cost[i][p[i]] for i in range(n)) for p in itertools.permutations(range(n + 1), n))
        assert sum(cost[i][j] for i, j in enumerate(assign(cost))) == best


def test_nested_edit_script():
    leaf = lambda n, m=None, k="whole": Node(n, m, k)
    old = Node("root", children=(Node("flight", children=(leaf("pax", "passengers"), leaf("km"))), leaf("mail")))
    new = Node("root", children=(leaf("mail", k="text"), Node("flight", children=(leaf("Passengers", "passengers"), leaf("km"), leaf("crew")))))
    cost, script = edit_distance(old, new)
    assert {(e.op, e.path) for e in script} == {("rename", "/flight/Passengers"), ("add", "/flight/crew"), ("retype", "/mail"), ("move", "/flight")} or {(e.op, e.path) for e in script} == {("rename", "/flight/Passengers"), ("add", "/flight/crew"), ("retype", "/mail"), ("move", "/mail")}
    assert cost > 0 and edit_distance(old, old) == (0.0, [])


def test_header_changes(spark):
    files = {
        ("a", 2023, 1): [["title"], [*HEAD, "Pax", "PLF"], [*KEY, "10", "70.5"]],
        ("a", 2023, 3): [[*HEAD, "PLF", "P_a x"], [*KEY, "70.5", "n/a"], [*KEY, "71", "11"]],
        ("a", 2023, 4): [[*HEAD, "Passengers", "Freight", "Crew Hours"], [*KEY, "10 pax", "1.5", "-"]],
        ("b", 2023, 1): [[*HEAD, "Pax"], [*KEY, "10"]],
        ("b", 2023, 2): [[""], [*HEAD, " PAX "]],
        ("c", 2023, 2): [["no header here"]],
    }
    assert changes(spark, files) == {
        ("a_2023_04", "passengers", "renamed"), ("a_2023_04", "passengers", "retyped"), ("a_2023_04", "load_factor", "removed"),
        ("a_2023_04", "freight_tonnes", "added"), ("a_2023_04", "crew_hours", "added"),
    }


def test_unknown_header_is_learned_from_its_values(spark):
    files = {
        ("a", 2023, 1): [[*HEAD, "Freight"], [*KEY, "100.5"]],
        ("a", 2023, 2): [[*HEAD, "Freight lifted"], [*KEY, "101.5"]],
        ("a", 2023, 3): [[*HEAD, "Freight lifted"], [*KEY, "102.5"]],
        ("a", 2023, 4): [[*HEAD, "Oil"], [*KEY, "102.5"]],
    }
    assert changes(spark, files) == {("a_2023_02", "freight_tonnes", "renamed"), ("a_2023_04", "freight_tonnes", "removed"), ("a_2023_04", "oil", "added")}


def test_no_files(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert file_columns(empty, TARGET).collect() == [] and table(empty).collect() == [] and by_feed(schema_changes, empty).collect() == []


def test_consistent_table(spark):
    files = {
        ("a", 2023, 1): [[*HEAD, "Pax", "PLF"], [*KEY, "1,210", "70,5"], [*KEY, "-"]],
        ("a", 2023, 2): [[*HEAD, "Freight in Kg", "Passengers"], [*KEY, "1500 kg", None]],
    }
    got = sorted((r.file[8:-5], r.row_idx, r.airline, r.passengers, r.freight_tonnes, r.load_factor) for r in table(sheets(spark, files)).collect())
    assert got == [("a_2023_01", 1, "X Air", 1210.0, None, 70.5), ("a_2023_01", 2, "X Air", None, None, None), ("a_2023_02", 1, "X Air", None, 1.5, None)]


@pytest.mark.parametrize("text,want", [(" Block  Hours ", "block_hours"), ("Post (t)", "post_t"), (None, "")])
def test_snake(text, want):
    assert snake(text) == want and squash(text) == want.replace("_", "")


def test_learned_header_is_read_in_every_later_file(spark):
    files = {
        ("a", 2023, 1): [[*HEAD, "Freight", "Pax"], [*KEY, "100.5", "10"]],
        ("a", 2023, 2): [[*HEAD, "Freight lifted", "Pax"], [*KEY, "101.5", "11"]],
        ("a", 2023, 3): [[*HEAD, "Pax", "FREIGHT  Lifted"], [*KEY, "12", "102.5"]],
        ("a", 2023, 5): [[*HEAD, "Freight lifted", "Freight"], [*KEY, "1.5", "103.5"]],
        ("a", 2023, 6): [[*HEAD, "Freight lifted"], [*KEY, "104.5"]],
        ("b", 2023, 3): [[*HEAD, "Freight lifted"], [*KEY, "105.5"]],
    }
    got = {r.file[8:-5]: (r.freight_tonnes, r.passengers) for r in table(sheets(spark, files)).collect()}
    # a script goes on with the header of the file before; without one only the known headers count
    assert got == {"a_2023_01": (100.5, 10.0), "a_2023_02": (101.5, 11.0), "a_2023_03": (102.5, 12.0), "a_2023_05": (1.5, None), "a_2023_06": (104.5, None), "b_2023_03": (None, None)}


def carriers(month, **columns):
    """A file of twelve carriers; every column has a size of its own for each carrier, the same in all months but for a few percent."""
    rng, out = random.Random(month), []
    size = {"freight": 3.0, "mail": 1.0, "pax": 6.0, "crew": 4.0}
    for k in range(12):
        own = {c: math.exp(s + random.Random(f"{c}{k}").uniform(-1.5, 1.5) + rng.uniform(-0.03, 0.03)) for c, s in size.items()}
        out.append([f"Air {k}", "scheduled", "2023", str(month), *(f"{own[c.rstrip('_')] * (1000 if h.endswith('Kg') else 1):.3f}" for h, c in columns.items())])
    return [[*HEAD, *columns], *out]


def test_scripts_tell_renamings_by_values_without_known_headers(spark):
    blank = replace(TARGET, aliases={f: () for f in TARGET.aliases})
    files = {
        ("a", 2023, 1): carriers(1, **{"Freight Tonnes": "freight", "Passengers": "pax", "Mail": "mail"}),
        ("a", 2023, 2): carriers(2, **{"Revenue Load": "freight", "Mail": "mail", "Passengers": "pax"}),
        ("a", 2023, 3): carriers(3, **{"Revenue Load": "freight", "Travellers": "pax", "Crew": "crew"}),
        ("a", 2023, 4): carriers(4, **{"Hold in Kg": "freight", "Travellers": "pax"}),
    }
    assert changes(spark, files, blank) == {
        ("a_2023_02", "freight_tonnes", "renamed"), ("a_2023_03", "passengers", "renamed"), ("a_2023_03", "mail", "removed"), ("a_2023_03", "crew", "added"),
        ("a_2023_04", "freight_tonnes", "renamed"), ("a_2023_04", "crew", "removed"),
    }
    got = {(r.file[8:-5], r.airline): (r.freight_tonnes, r.passengers) for r in table(sheets(spark, files), blank).collect()}
    for m in (2, 3, 4):
        for k in range(12):
            a, b = got["a_2023_01", f"Air {k}"], got[f"a_2023_0{m}", f"Air {k}"]
            assert abs(b[1] / a[1] - 1) < 0.1 and abs(b[0] / a[0] / (1000 if m == 4 else 1) - 1) < 0.1


def test_known_headers_do_not_outweigh_values(spark):
    """Of a header known for the field with other values, and an unknown one with its values, the latter is the renaming."""
    files = {("a", 2023, 1): carriers(1, Freight="freight", Passengers="pax"), ("a", 2023, 2): carriers(2, **{"Freight in Kg": "crew", "Revenue Load": "freight", "Passengers": "pax"})}
    assert changes(spark, files) == {("a_2023_02", "freight_tonnes", "renamed"), ("a_2023_02", "freight_in_kg", "added")}
    near = [Node(h, None, "decimal", v) for h, v in (("A", (1.0, 5.0, 2.0)), ("B", (1.1, 5.1, 2.0)), ("C", (5.0, 1.0, 3.0)))]
    assert relabel_cost(near[0], near[1]) < 2.0 < relabel_cost(near[0], near[2])


def test_files_without_feed_stand_alone(spark):
    raw = sheets(spark, {("a", 2023, 1): [[*HEAD, "PLF"], [*KEY, "70"]]}).withColumn("file", F.lit("other.xlsx"))
    assert [(r.file, r.load_factor) for r in table(raw).collect()] == [("other.xlsx", 70.0)] and by_feed(schema_changes, raw).collect() == []
