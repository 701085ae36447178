"""The profiles cover every column of every table with loads."""

import random
from collections import defaultdict

import pytest

from flightloom.plans import data_queries as Q
from flightloom.sources.tables import SPECS

TABLES = ("airport_monthly", "domestic_route_monthly", "carrier_monthly", "airport_international_quarterly")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root, rng, rows = str(tmp_path_factory.mktemp("tables")), random.Random(4), {}
    text = {"airport": ("ABCDE", "abcde ", "FGHIJ"), "origin": ("ABCDE", "abcde"), "destination": ("FGHIJ", None), "airline": ("X Air", " X Air"), "service_type": ("scheduled_domestic", "Scheduled Domestic")}
    whole = {"year": (2023, 23), "month": (1, 12, 13), "quarter": (1, 4, 5), "passengers": (*range(0, 5000, 7), -3, None), "departures": (*range(900), None), "arrivals": (*range(900), None)}
    for t in TABLES:
        pick = lambda c: rng.choice(text.get(c) or whole.get(c) or (0.5, 12.125, 71.0, 250.75, None))
        rows[t] = [(*(pick(c) for c, _ in SPECS[t].columns), load, f"2023-0{load}-01 00:00:00") for load in (1, 2, 3) for _ in range(60)]
        df = spark.createDataFrame(rows[t], f"{SPECS[t].ddl}, load_no int, loaded_at string")
        df.withColumn("loaded_at", df.loaded_at.cast("timestamp")).coalesce(1).write.parquet(f"{root}/{t}.parquet")
    return root, rows


def test_columns_of_all_tables(spark, folder):
    root, rows = folder
    want = defaultdict(list)
    for t in TABLES:
        names = [c for c, _ in SPECS[t].columns]
        for *values, load, at in rows[t]:
            for c, v in zip([*names, "loaded_at"], [*values, at]):
                want[t, load, c].append(v)
    got = {(r.table_name, r.load_no, r.column_name): r for r in Q.p7_tables(spark, root).collect()}
    assert set(got) == set(want)
    bad = {"airport": {"abcde "}, "origin": {"abcde"}, "airline": {" X Air"}, "service_type": {"Scheduled Domestic"}, "year": {23}, "month": {13}, "quarter": {5}, "passengers": {-3}, "passenger_load_factor": {250.75}, "weight_load_factor": {250.75}}
    for k, v in want.items():
        r, has = got[k], [x for x in v if x is not None]
        assert (r.n_rows, r.n_null, r.n_distinct, r.n_violations) == (60, 60 - len(has), len(set(has)), sum(x in bad.get(k[2], ()) for x in has)), k


def test_measures_of_all_tables_are_compared_between_loads(spark, folder):
    root, rows = folder
    measures = {(t, c) for t in TABLES for c, kind in SPECS[t].columns if kind != "string" and c not in ("year", "month", "quarter")} | {("airport_international_quarterly", "quarter")}
    got = {(r.table_name, r.column_name, r.load_no): r for r in Q.p7_profile(spark, root).collect()}
    assert set(got) == {(t, c, load) for t, c in measures for load in (1, 2, 3)}
    at = [c for c, _ in SPECS["carrier_monthly"].columns].index("mail_tonnes")
    has = [r[at] for r in rows["carrier_monthly"] if r[-2] == 2 and r[at] is not None]
    mail = got["carrier_monthly", "mail_tonnes", 2]
    assert (mail.n_null, mail.least, mail.most, mail.n_outside) == (60 - len(has), min(has), max(has), 0)
