"""Semantics of resolution, canonical tables, windows, analytics and checks on inline rows."""

import pytest
from pyspark.sql import functions as F

from flightloom.functions import periods, text
from flightloom.operators import canonical, dashboard, focus, resolve, windows
from flightloom.quality import checks, revisions
from flightloom.sources import links, manifest, sheets, sinks
from flightloom.sources.tables import SPECS, rows_that_count


def p(year, month):
    return year * 12 + month - 1


WINDOWS = "label string, canonical string, lo int, hi int, seq int"


def dim(spark, *rows):
    return spark.createDataFrame(list(rows), WINDOWS)


def one(spark, expr, schema="x string", value="a"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("y")).first().y


# --- resolution


def test_resolve_windows_with_a_hole(spark):
    d = dim(spark, ("SHARED", "AAA", None, p(2018, 12), 0), ("SHARED", "BBB", p(2023, 1), None, 1))
    f = spark.createDataFrame([(" shared ", p(2017, 1)), ("Shared", p(2024, 1)), ("SHARED", p(2020, 1)), (None, p(2020, 1))], "label string, p int")
    assert {(r.p, r.canonical) for r in resolve.resolve(f, d, "label", "p").collect()} == {(p(2017, 1), "AAA"), (p(2024, 1), "BBB"), (p(2020, 1), None)}


def test_first_window_counts_and_facts_are_not_multiplied(spark):
    d = dim(spark, ("X", "ONE", None, None, 0), ("X", "ONE", 5, 9, 1), ("X", "TWO", None, None, 2))
    f = spark.createDataFrame([("X", 7)], "label string, p int")
    assert [r.canonical for r in resolve.resolve(f, d, "label", "p").collect()] == ["ONE"]


def test_conflicts(spark):
    bad = dim(spark, ("S", "A", None, p(2024, 6), 0), ("S", "B", p(2024, 1), None, 1), ("T", "A", None, None, 2), ("T", "A", 3, 4, 3))
    assert [(r.label, r.canonical, r.other, r.lo, r.hi) for r in resolve.conflicts(bad).collect()] == [("S", "A", "B", p(2024, 1), p(2024, 6))]
    with pytest.raises(resolve.LabelConflict):
        resolve.assert_no_conflicts(bad)
    resolve.assert_no_conflicts(bad.where("label = 'T'"))


def test_label_index_variants_replace_city_and_name(spark):
    e = spark.createDataFrame([("AAA", "Alpha", "Alpha Field"), ("BBB", "Beta", None)], "canonical string, city string, name string")
    v = spark.createDataFrame([("AAA", "Old Alpha", 1, 2, 0)], "canonical string, label string, lo int, hi int, seq int")
    a = spark.createDataFrame([("Bee", "BBB")], "label string, canonical string")
    assert {(r.label, r.canonical, r.lo) for r in resolve.label_windows(e, v, a).collect()} == {("OLD ALPHA", "AAA", 1), ("BETA", "BBB", None), ("BEE", "BBB", None)}


def test_quarter_midpoint(spark):
    q = spark.createDataFrame([(2024, k) for k in (1, 2, 3, 4)], "y int, q int")
    assert [r.m % 12 + 1 for r in q.select(resolve.quarter_month("y", "q").alias("m"), "q").orderBy("q").collect()] == [resolve.QUARTER_MONTH[k] for k in (1, 2, 3, 4)]


def test_co_occurrence(spark):
    r = spark.createDataFrame([("D", 1, "a"), ("D", 1, "b"), ("D", 1, "c"), ("D", 2, "a"), ("D", 2, "b"), (None, 1, "z")], "canonical string, p int, label string")
    assert {tuple(x) for x in resolve.co_occurrence(r, "canonical", "p", "label").collect()} == {("D", "A", "B", 2), ("D", "A", "C", 1), ("D", "B", "C", 1)}


# --- canonical tables

PAIRS = "p int, city1 string, city2 string, to_pax double, from_pax double"


def test_end_to_end_split_rename_and_conserve(spark):
    d = dim(spark, ("SHARED", "AAA", None, p(2018, 12), 0), ("SHARED", "BBB", p(2023, 1), None, 1), ("OLDTOWN", "CCC", None, None, 2), ("NEWTOWN", "CCC", None, None, 3))
    pairs = spark.createDataFrame([(p(2017, 6), "SHARED", "HUB", 100.0, 80.0), (p(2024, 6), "SHARED", "HUB", 200.0, 150.0), (p(2020, 3), "OLDTOWN", "HUB", 10.0, 10.0), (p(2023, 3), "NEWTOWN", "HUB", 30.0, 20.0)], PAIRS)
    got = {(r.airport, r.p): r.passengers for r in canonical.monthly_throughput(resolve.resolve_pairs(pairs, d)).collect()}
    assert got == {("AAA", p(2017, 6)): 180, ("BBB", p(2024, 6)): 350, ("CCC", p(2020, 3)): 20, ("CCC", p(2023, 3)): 50}


def test_finalize_adds_and_rounds_half_to_even(spark):
    s = spark.createDataFrame([(1, "K", 6.0, 4.0), (1, "K", 7.0, 13.0), (2, "K", 2.5, 3.5), (3, None, 1.0, 1.0)], "p int, airport string, dep double, arr double")
    assert {tuple(r) for r in canonical.finalize(s, ["p", "airport"]).collect()} == {(1, "K", 30, 13, 17), (2, "K", 6, 2, 4)}


def test_routes_keep_zero_and_drop_self_and_half_known(spark):
    d = dim(spark, ("DELHI", "DEL", None, None, 0), ("BOMBAY", "BOM", None, None, 1), ("BENGALURU", "BLR", None, None, 2), ("HYDERABAD", "HYD", None, None, 3))
    pairs = spark.createDataFrame([(1, "DELHI", "BOMBAY", 100.0, 80.0), (1, "DELHI", "Bengaluru", 50.0, 0.0), (1, "HYDERABAD", "HYDERABAD", 0.0, 2.0), (1, "DELHI", "WAKANDA", 500.0, 400.0), (1, "DELHI", "BOMBAY", None, 5.0)], PAIRS)
    r = resolve.resolve_pairs(pairs, d)
    assert {(x.origin, x.destination, x.passengers) for x in canonical.directed_routes(r).collect()} == {("DEL", "BOM", 100), ("BOM", "DEL", 85), ("DEL", "BLR", 50), ("BLR", "DEL", 0)}
    m = {x.airport: (x.departures, x.arrivals, x.passengers) for x in canonical.monthly_throughput(r).collect()}
    assert m["DEL"] == (650, 485, 1135) and m["HYD"][2] == 4
    assert [tuple(x) for x in canonical.unresolved_volume(r).collect()] == [("WAKANDA", 900)]


def test_yearly_needs_complete_years(spark):
    m = spark.createDataFrame([(p(2024, k), "A", 100) for k in range(1, 13)] + [(p(2025, 1), "A", 7)], "p int, airport string, passengers long")
    q = spark.createDataFrame([(2024 * 4 + k, "A", 5) for k in range(3)], "q int, airport string, passengers long")
    assert [tuple(r) for r in canonical.yearly(m, q).collect()] == [(2024, "A", 1200, "domestic")]


def test_rows_that_count(spark):
    d = spark.createDataFrame([("a", 1, 10), ("a", 2, None), ("a", 2, 5), ("b", 1, 3), ("b", 1, 3), (None, 9, 9)], "k string, t int, v int")
    assert sorted(tuple(r) for r in rows_that_count(d, ["k"], ["v"], "t").collect()) == [("a", 5), ("b", 3)]


# --- windows


def panel(spark, data):
    return spark.createDataFrame(data, "airport string, p int, passengers long")


def test_zero_filled_against_gap_honest(spark):
    data = [("X", k, 10) for k in range(12) if k != 5] + [("Y", k, 1) for k in range(12)]
    a = {(r.airport, r.p): r.total for r in windows.matrix_trailing(panel(spark, data), "airport", "passengers", 12).collect()}
    assert a == {("X", 11): 110, ("Y", 11): 12}
    b = {(r.airport, r.p): r.total for r in windows.gap_honest_trailing(panel(spark, data), "airport", "passengers", 12).collect()}
    assert b["X", 11] is None and b["Y", 11] == 12


def test_matrix_window_emits_every_entity(spark):
    data = [("OLD", 0, 5), *(("NEW", k, 1) for k in range(1, 30))]
    t = {(r.airport, r.p): r.total for r in windows.matrix_trailing(panel(spark, data), "airport", "passengers", 12).collect()}
    assert t["OLD", 11] == 5 and t["OLD", 12] == 0 and t["NEW", 12] == 12 and len(t) == 2 * 19


def national(spark, gone, zero):
    s = spark.createDataFrame([(p(2020, 1) + k, 1000) for k in range(24) if p(2020, 1) + k not in gone], "p int, v long")
    return {r.p: r for r in windows.national_trailing(s, "v", 12, zero).collect()}


def test_known_zero_is_filled_and_other_gaps_void(spark):
    april = p(2020, 4)
    r = national(spark, {april}, [april])
    assert r[april].value == 0 and r[p(2020, 12)].total == 11000 and r[p(2021, 5)].yoy == 0 and r[p(2021, 4)].yoy is None
    r = national(spark, {p(2021, 3)}, [april])
    assert r[p(2021, 3)].value is None and r[p(2021, 12)].total is None


def test_positional_ignores_gaps(spark):
    s = spark.createDataFrame([(k, 1) for k in (1, 2, 3, 9)], "p int, v long")
    assert {r.p: r.total for r in windows.positional_trailing(s, "v", 4).collect()}[9] == 4


def test_step_index_fill_missing(spark):
    d = spark.createDataFrame([("a", 1, 5), ("a", 2, 8), ("a", 4, 9)], "e string, p int, v long")
    assert {r.p: r.step for r in windows.step_change(d, "e", "v").collect()} == {1: None, 2: 3, 4: None}
    assert [r.p for r in windows.missing_periods(d).collect()] == [3]
    assert {r.p: r.idx for r in windows.index_to_base(d.select("p", "v"), "v", 2).collect()} == {2: 100.0, 4: 112.5}
    f = spark.createDataFrame([("f", 1, None), ("f", 2, "H"), ("f", 3, None)], "g string, i int, h string")
    assert [r.o for r in windows.fill_down(f, "g", "i", "h", "o").orderBy("i").collect()] == [None, "H", "H"]


# --- analytics


def test_newcomers(spark):
    data = [("OLD", p(2020, k), 5) for k in (1, 2, 3)] + [("NEW", p(2021, k), 80_000) for k in (1, 2, 3)]
    assert {r.airport for r in dashboard.newcomer_ramps(panel(spark, data), cumulative=0, peak=0).collect()} == {"NEW"}


def test_seasonality_index_of_a_flat_year(spark):
    data = [("A", p(2023, k), 1000) for k in range(1, 13)] + [("A", p(2024, 1), 9)]
    got = dashboard.seasonality(panel(spark, data), least_years=1, least_t12=0).collect()
    assert len(got) == 12 and {r.idx for r in got} == {100.0}


def test_share_movers_sides(spark):
    data = [("A", k, 100) for k in range(12)] + [("A", k, 50) for k in range(12, 24)] + [("B", k, 50) for k in range(24)]
    got = {r.airport: (r.side, r.delta_pp > 0) for r in dashboard.share_movers(panel(spark, data), "airport", "p", 12, 0, 1).collect()}
    assert got == {"A": ("loser", False), "B": ("gainer", True)}


def test_breakout_guard(spark):
    hop = [("H", k, 1000) for k in range(0, 48, 2)]
    assert focus.breakouts(panel(spark, hop)).collect() == []
    jump = [("J", k, 100) for k in range(30)] + [("J", 30, 500), ("J", 31, 200)]
    assert [tuple(r) for r in focus.breakouts(panel(spark, jump)).collect()] == [("J", 100, 30, 2, 500, True)]


def test_relief_needs_all_months(spark):
    data = [("BIG", p(2025, 1) + k, 3_000_000) for k in range(17)] + [("NEW", p(2026, 1) + k, 200_000) for k in range(5)]
    r = focus.relief(panel(spark, data), "NEW", "BIG").first()
    assert (r.months, r.entrant, r.displaced) == (5, 1_000_000, 0.0)
    assert focus.relief(panel(spark, [x for x in data if x[1] != p(2025, 3)]), "NEW", "BIG").collect() == []


def test_white_space(spark):
    data = [("DEL", f"P{k:02d}", m, 20_000) for k in range(40) for m in range(12)] + [("DEL", "ZZZ", m, 0) for m in range(12)] + [("P00", "ZZZ", m, 20_000) for m in range(12)]
    r = spark.createDataFrame(data, "origin string, destination string, p int, passengers long")
    assert [x.airport for x in focus.white_space(r, "DEL").collect()] == ["ZZZ"]
    assert focus.hub_markets(r, "DEL", n=50).collect() == []  # 24 months are asked for
    older = r.select("origin", "destination", (F.col("p") - 12).alias("p"), (F.col("passengers") * 2).alias("passengers"))
    menu = {x.partner: (x.latest, x.previous, x.trend) for x in focus.hub_markets(r.union(older), "DEL", n=50).collect()}
    assert len(menu) == 41 and menu["P01"] == (240_000, 480_000, "down") and menu["ZZZ"] == (0, 0, "new")
    assert focus.white_space(r.where("p > 0"), "DEL").collect() == []


def test_catchment_compares_equal_sets_only(spark):
    data = [("A", k, 10) for k in range(60)] + [("B", k, 10) for k in range(40, 60)]
    r = focus.catchment(panel(spark, data), spark.createDataFrame([("A",), ("B",)], "airport string")).first()
    assert (r.n, r.total, r.growth) == (2, 240, None)


def test_ramp_has_nulls_in_gaps(spark):
    r = {x.month_index: x.passengers for x in focus.ramp_series(panel(spark, [("A", 3, 1), ("A", 5, 2)]), 4).collect()}
    assert r == {0: 1, 1: None, 2: 2, 3: None}


# --- checks and revisions


def test_revision_kinds_and_null(spark):
    s = "k string, v long"
    old = spark.createDataFrame([("DEL", 100), ("BOM", 200), ("OLD", 50), ("NUL", None)], s)
    new = spark.createDataFrame([("DEL", 100), ("BOM", 250), ("NEW", 70), ("NUL", None)], s)
    assert {(r.k, r.kind) for r in revisions.diff(old, new, ["k"], "v").collect()} == {("BOM", "restated"), ("NEW", "added"), ("OLD", "removed")}
    with pytest.raises(ValueError):
        revisions.diff(old.union(old), new, ["k"], "v")


def test_drift_is_counted_per_row(spark):
    a = spark.createDataFrame([("x", 86.66), ("y", 1.0)], "k string, v double")
    b = spark.createDataFrame([("x", 86.66023056391617), ("y", 1.0)], "k string, v double")
    assert revisions.drifted_rows(a, b, ["k"], ["v"]).first().drifted == 1


def test_precision_and_conservation(spark):
    c = spark.createDataFrame([("a", "s", 1, 5, 86.66), ("a", "s", 2, 5, 86.66023056391617)], "airline string, service_type string, p int, passengers long, passenger_load_factor double").withColumn("seat_km", F.lit(1.0))
    f = {r["check"]: r.status for r in checks.carrier_checks(c, ("seat_km", "passenger_load_factor"), ("passenger_load_factor",)).collect()}
    assert f["carrier.precision.passenger_load_factor"] == "fail" and f["carrier.precision.seat_km"] == "pass" and f["carrier.unique"] == "pass"
    m = spark.createDataFrame([(p(2026, 7), "DEL", 166, 80, 86)], "p int, airport string, passengers long, departures long, arrivals long")
    row = checks.conservation_finding(m).first()
    assert (row.status, row.severity) == ("fail", "TRIPWIRE") and str(p(2026, 7)) in row.message
    assert checks.summary(checks.conservation_finding(m)).first().exit_code == 1


def test_schema_and_coverage(spark):
    good = spark.createDataFrame([], SPECS["airport_yearly"].ddl)
    f = {r["check"]: r.status for r in checks.schema_findings(spark, {"airport_yearly": good}, {"airport_yearly": "2.0"}).collect()}
    assert f["schema.airport_yearly.columns"] == "pass" and f["schema.airport_yearly.version"] == "pass" and f["schema.carrier_monthly.present"] == "fail"
    m = spark.createDataFrame([(1,), (2,), (5,)], "p int")
    assert "2 periods missing, first 3, 4" in checks.coverage(m, "coverage.x").first().message


def test_disappeared_and_containment(spark):
    rows = [("A", "B", k, 50_000) for k in range(12)] + [("A", "C", k, 10) for k in range(13)] + [("C", "B", k, 10) for k in range(13)]
    r = spark.createDataFrame(rows, "origin string, destination string, p int, passengers long")
    active = panel(spark, [(a, 12, 1) for a in "ABC"])
    assert [tuple(x)[:2] for x in checks.disappeared_routes(r, active, usual=0.5).collect()] == [("A", "B")]
    assert checks.disappeared_routes(r, active.where("airport <> 'B'"), usual=0.5).collect() == []
    m = spark.createDataFrame([(0, "A", 60_000, 50_000, 0)], "p int, airport string, passengers long, departures long, arrivals long")
    assert (0, "A", 10, 0) in {tuple(x) for x in checks.endpoint_containment(r, m).collect()}


def test_undeclared(spark):
    r = spark.createDataFrame([("COK", 1, "KOCHI"), ("COK", 1, "COCHIN")], "canonical string, p int, label string")
    both = resolve.concurrent_labels(r, "canonical", "p", "label")
    none = spark.createDataFrame([], "canonical string, labels array<string>")
    assert both.count() == 1 and checks.undeclared_labels(both, none, "canonical", "p").count() == 1
    known = spark.createDataFrame([("COK", ["KOCHI", "COCHIN"])], "canonical string, labels array<string>")
    assert checks.undeclared_labels(both, known, "canonical", "p").count() == 0


# --- sources


def test_city_sheet(spark):
    cells = [["TITLE"], ["", "", "", "(NO.)"], ["S.No", "City 1", "City 2", "Passengers To City 2", "Passeneger From City 2", "Freight To City 2"], ["1", "Agartala", "Bengaluru", "3,661", "4247", "2.741"], ["2", "Total", "x", "1", "1", "0"], ["3", "A", "B", None, "5", "0"], ["4", "A", "B", "-", "5", "x"]]
    df = spark.createDataFrame([("f", s, i, c) for s in (1, 2) for i, c in enumerate(cells)], "file string, sheet_idx int, row_idx int, cells array<string>")
    assert sorted((tuple(r)[2:] for r in sheets.city_pairs(df).collect()), key=repr) == [("A", "B", 0.0, 5.0, None, 0.0, 0.0, 0.0), ("AGARTALA", "BENGALURU", 3661.0, 4247.0, 2.741, 0.0, 0.0, 0.0)]


def test_carrier_sections(spark):
    v = [str(k) for k in range(1, 17)]
    cells = [["JAN", *v], ["SCHEDULED DOMESTIC SERVICES"], ["1", "JAN", *v], ["NON-SCHEDULED INTERNATIONAL SERVICES"], ["FEB", *v], ["MAR", *v[:3], "x"]]
    df = spark.createDataFrame([("f", 0, i, c) for i, c in enumerate(cells)], "file string, sheet_idx int, row_idx int, cells array<string>")
    got = [(r.service_type, r.month, r.passengers, r.freight_tonne_km, r.mail_tonne_km) for r in sheets.carrier_rows(df).orderBy("row_idx").collect()]
    assert got == [("scheduled_domestic", 1, 4.0, 12.0, 13.0), ("nonscheduled_international", 2, 4.0, 12.0, 13.0)]


def test_numbered_and_either_side(spark):
    df = spark.createDataFrame([("f", 0, 0, ["1", "A", "B", "3", "4", "5", "6"]), ("f", 0, 1, ["x", "A", "B", "3", "4", "5", "6"]), ("f", 0, 2, ["2", "TOTAL", "", "", "", "", ""]), ("f", 0, 3, ["3", "A"])], "file string, sheet_idx int, row_idx int, cells array<string>")
    assert [r.serial for r in sheets.numbered_rows(df, 4).collect()] == [1]
    c = spark.createDataFrame([(["24", "6", "KOCHI", "HUB", "100", "90"],), (["2024", "7", "A", "B", "", "5"],), (["1"],)], "cells array<string>")
    assert sorted(tuple(r) for r in sheets.either_side_pairs(c).collect()) == [(2024, 6, 190.0, "HUB"), (2024, 6, 190.0, "KOCHI"), (2024, 7, 0.0, "A"), (2024, 7, 0.0, "B")]


def test_token_rows_follow_the_first_of_a_row(spark):
    t = spark.createDataFrame([(1, 100.0, 5.0, "b"), (1, 99.0, 1.0, "a"), (1, 98.5, 1.0, "c"), (1, 97.9, 9.0, "d"), (None, 1.0, 1.0, "z")], "page int, y0 double, x0 double, text string")
    assert [r.text for r in sheets.cluster_tokens(t).orderBy("row_no").collect()] == ["a b", "c d"]


def test_links(spark):
    html = "<a data-url='/x?a=1&amp;b=2'></a><a data-url=\"/x?a=1&amp;b=2\"></a><i data-url='http://h/1234/f.xlsx'> jsp/a/b.xls;"
    assert one(spark, links.data_urls(F.col("x")), value=html) == ["/x?a=1&b=2", "http://h/1234/f.xlsx", "jsp/a/b.xls"]
    canon = links.canonical_url(F.col("x"), "https://h", ("jsp/site",), ("Lists/",))
    assert [one(spark, canon, value=v) for v in ("http://a/b", "jsp/site/f.xls", "Lists/f.xls", "other")] == ["http://a/b", "https://h/f.xls", "https://h/Lists/f.xls", None]
    assert one(spark, links.is_workbook(F.col("x")), value="http://h/F.XLS") is True
    assert [one(spark, links.content_id(F.col("x")), value=v) for v in ("h/123/4567/html/x", "h/123/4567/f.xlsx", "h/12/a.html")] == ["4567", None, None]
    m = spark.createDataFrame([('{"a": ["x", "{\\"b\\": \\"y\\"}"], "c": 3}',), (None,)], "j string")
    assert sorted(r.value for r in links.nested_strings(m, "j").collect()) == ["x", "y"]
    f = spark.createDataFrame([(2024, 1, 1), (2024, 1, 4), (2024, 2, 3), (2024, 3, 4)], "year int, quarter int, table_no int")
    assert [tuple(r) for r in links.fallback_periods(f).collect()] == [(2024, 2)]
    assert one(spark, links.name_variants(F.col("x")), value="City, May 2024.xlsx") == ["City, MAY 2024.xlsx", "City,  MAY 2024.xlsx"]
    assert one(spark, links.name_variants(F.col("x")), value="none.xlsx") == []


def test_manifest(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(b"one")
    (tmp_path / "b.tmp").write_bytes(b"two")
    m = manifest.fingerprint_files(spark, str(tmp_path)).collect()
    assert [(r.source, r.source_type, r.content_length) for r in m] == [("a.xlsx", "excel", 3)]
    s = "source string, sha256 string"
    old = spark.createDataFrame([("same", "1"), ("chg", "1"), ("gone", "1")], s)
    new = spark.createDataFrame([("same", "1"), ("chg", "2"), ("new", "1")], s)
    assert {tuple(r) for r in manifest.diff_manifests(old, new).collect()} == {("chg", "changed"), ("gone", "removed"), ("new", "added")}
    assert manifest.is_unchanged(old, old) and not manifest.is_unchanged(old, new)
    assert manifest.combined_fingerprint({"a": b"1", "b": b"2"}) == manifest.combined_fingerprint({"b": b"2", "a": b"1"})


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2024, "A", "domestic", 5)], "year int, airport string, category string, passengers long")
    sinks.write_table(df, str(tmp_path / "t"), "airport_yearly")
    assert spark.read.parquet(str(tmp_path / "t")).columns == [c for c, _ in SPECS["airport_yearly"].columns]
    sinks.write_csv(df.withColumn("x", F.lit(1.5)), str(tmp_path / "c"))
    assert any("1.500" in f.read_text() for f in (tmp_path / "c").glob("part*"))
    sinks.write_json(sinks.table_metadata({"airport_yearly": df}), str(tmp_path / "m.json"))
    assert '"rows": 1' in (tmp_path / "m.json").read_text() and sinks.summary_row(df)["airport"] == "A"


# --- text and numbers


@pytest.mark.parametrize(
    "fn,value,want",
    [
        (text.clean_text, "  a \n b ", "a b"), (text.clean_text, None, ""), (text.clean_key, "Pax  (To)-City2", "PAX TO CITY2"), (text.tolerant_number, "3,661", 3661.0), (text.tolerant_number, "-", 0.0),
        (text.tolerant_number, "x", None), (text.tolerant_number, None, None), (text.source_number, None, 0.0), (text.month_number, "Feburuary", 2), (text.month_number, "zzz", None), (text.title_label, "air%20one_2", "Air One"),
        (text.stem_year, "city 04 25.xlsx", 2025), (text.stem_year, "none.xlsx", None), (text.clean_key, "Passeneger No.", "PASSENGER NO"), (text.service_of_text, "Non-Scheduled International Services", "nonscheduled_international"),
        (text.service_of_text, "Notes", None), (text.label_form, " new  delhi ", "NEW DELHI"),
    ],
)
def test_text_functions(spark, fn, value, want):
    assert one(spark, fn("x"), value=value) == want


def test_more_functions(spark):
    labels = F.array(F.lit("CHENNAI"), F.lit("NAI"), F.lit("AI"), F.lit("BANDAR SERI BEGAWAN"))
    got = one(spark, text.split_combined("x", labels), value="BANDAR SERI BEGAWANCHENNAI")
    assert (got.head, got.tail) == ("BANDAR SERI BEGAWAN", "CHENNAI")
    n = one(spark, text.name_period("x"), value="CITY PAIR APR IL, 2025.xlsx")
    assert (n.year, n.month) == (2025, 4) and one(spark, text.name_period("x"), value="APRIL") is None
    q = one(spark, text.quarter_file("x"), value="24Q3_4.xlsx")
    assert (q.year, q.quarter, q.table_no) == (2024, 3, 4)
    d = spark.createDataFrame([(1234567.0, 0.0125, [1.0, 1.1, 5.0])], "v double, s double, a array<double>")
    r = d.select(text.compact_number("v").alias("n"), text.growth_phrase("s").alias("g"), text.spread(F.col("a"), 1.0).alias("sp"), text.upper_bound("v").alias("u"), text.nullable_share("s").alias("pc")).first()
    assert (r.n, r.g, r.sp, r.u, r.pc) == ("1.2M", "up 1.2%", [1.0, 2.0, 5.0], 1250000.0, 1.2)
    e = spark.createDataFrame([("DEL", "Delhi"), ("X", None)], "c string, n string")
    assert [x.l for x in e.select(text.display_label("c", "n").alias("l")).collect()] == ["DEL (Delhi)", "X"]
    m = spark.createDataFrame([("2018-12",), (None,), ("x",)], "t string")
    assert [x.p for x in m.select(periods.parse_year_month("t").alias("p")).collect()] == [p(2018, 12), None, None]
    h = spark.createDataFrame([("a", "b", 1, 1), ("a", "a", None, 1), ("a", "b", 1, 2), ("a", None, None, None), (None, '"t"', 5, 5)], "e1 string, e2 string, l1 int, l2 int")
    # an equal length is unchanged even if the tags differ
    assert [x.v for x in h.select(manifest.head_change(F.col("e1"), F.col("e2"), F.col("l1"), F.col("l2")).alias("v")).collect()] == ["unchanged", "unchanged", "changed", "unknown", "unchanged"]


def test_deliveries_as_a_stream(spark, tmp_path):
    from flightloom.streaming.restatement import run_deliveries

    src = tmp_path / "in"
    schema = "k string, v long, loaded_at timestamp"
    for i, rows in enumerate(([("a", 1), ("b", 2)], [("a", 5), ("c", 3)])):
        spark.createDataFrame(rows, "k string, v long").withColumn("loaded_at", F.timestamp_seconds(F.lit(1000 + i))).coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    run_deliveries(spark, stream, str(tmp_path / "out"), str(tmp_path / "cp"), ["k"], ["v"]).awaitTermination()
    last = sorted((tmp_path / "out").glob("version=*"))[-1]
    assert {(r.k, r.v) for r in spark.read.parquet(str(last)).collect()} == {("a", 5), ("b", 2), ("c", 3)}
    assert {(r.k, r.kind, r.measure) for r in spark.read.parquet(str(tmp_path / "out" / "changes")).collect()} >= {("c", "added", "v")}
    with pytest.raises(ValueError):
        run_deliveries(spark, stream, str(tmp_path / "out"), str(tmp_path / "another"), ["k"], ["v"])


# --- assumptions


def test_verdicts(spark):
    from flightloom.quality import ledger as L

    monthly = panel(spark, [("BIG", 1, 10), ("SMALL", 1, 3)])
    labels = spark.createDataFrame([("old", 1), ("New", 2), ("x", 3), ("Y", 3)], "label string, p int")
    carriers = spark.createDataFrame([("One Air",)], "airline string")
    ctx = L.Context(monthly, labels, carriers, {"DUO": frozenset({"X", "Y"})})
    asked = [
        L.Assumption("a", "size-ordering-holds", {"bigger": "BIG", "smaller": "SMALL"}),
        L.Assumption("b", "size-ordering-holds", {"bigger": "SMALL", "smaller": "BIG"}),
        L.Assumption("c", "size-ordering-holds", {"bigger": "BIG", "smaller": "GONE"}),
        L.Assumption("d", "distinct-airports-not-merged", {"airports": ["BIG", "GONE"]}),
        L.Assumption("e", "month-disjoint-rename", {"labels": ["OLD", "NEW"]}),
        L.Assumption("f", "month-disjoint-rename", {"labels": ["X", "Y"]}),
        L.Assumption("g", "month-disjoint-rename", {"labels": ["none"]}),
        L.Assumption("h", "concurrent-merge-declared", {"airport": "DUO", "labels": ["x", "y"]}, ("DUO",)),
        L.Assumption("i", "concurrent-merge-declared", {"airport": "ELSE", "labels": ["x", "y"]}),
        L.Assumption("j", "concurrent-merge-declared", {"airport": "DUO", "labels": ["old", "new"]}),
        L.Assumption("k", "airlines-linked-not-collapsed", {"airlines": ["One Air"]}, (), "2024-01"),
        L.Assumption("l", "no-such-test"),
        L.Assumption("m", "size-ordering-holds", {}),
    ]
    got = {r.id: r.verdict for r in L.evaluate(asked, ctx, "2025-01").collect()}
    want = "HOLDS TRIGGERED TRIGGERED TRIGGERED HOLDS TRIGGERED ORPHANED HOLDS TRIGGERED ORPHANED STALE TRIGGERED TRIGGERED".split()
    assert got == dict(zip("abcdefghijklm", want))
    assert L.evaluate([L.Assumption("n", "airlines-linked-not-collapsed", {"airlines": ["One Air"]})], L.Context(monthly, labels, carriers.limit(0)), "2025-01").first().verdict == "ORPHANED"
    both = spark.createDataFrame([("DUO", 3, ["X", "Y"]), ("TRE", 3, ["P", "Q"])], "canonical string, p int, labels array<string>")
    assert [(r.canonical, r.labels) for r in L.uncovered_merges(both, asked).collect()] == [("TRE", ["P", "Q"])]
    unmapped = spark.createDataFrame([("WAKANDA", 1)], "label string, years int")
    assert [(r.kind, r.key, r.months) for r in L.worklist(both, unmapped, asked).collect()] == [("undeclared_concurrent", "TRE", [3]), ("unmapped_high_volume", "WAKANDA", [])]
