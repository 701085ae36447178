"""SQL (DuckDB dialect) for the data queries that SQL can say."""

from __future__ import annotations

import re

from flightloom.plans.carrier_files import CARRIER_FILES, CARRIER_HEADERS

Y = "(CASE WHEN year BETWEEN 0 AND 99 THEN year + 2000 ELSE year END)"
P = f"({Y} * 12 + month - 1)"
CODE = "upper(trim({}))"
SERVICE = "regexp_replace(lower(trim(service_type)), '[ _]+', '_', 'g')"
LOOSE = "replace(lower(trim({})), '_', ' ')"
METRICS = "aircraft_km passenger_km seat_km freight_tonnes mail_tonnes total_tonne_km available_tonne_km passenger_load_factor weight_load_factor".split()

#: Rows that count, as common table expressions.
AIRPORT = f"""airport_m AS (SELECT airport, p, passengers, departures, arrivals FROM (
  SELECT upper(trim(airport)) AS airport, {P} AS p, passengers, departures, arrivals,
         row_number() OVER (PARTITION BY upper(trim(airport)), {P} ORDER BY loaded_at DESC, passengers DESC NULLS LAST, departures DESC NULLS LAST, arrivals DESC NULLS LAST) AS k
  FROM airport_monthly WHERE airport IS NOT NULL AND year IS NOT NULL AND month IS NOT NULL) WHERE k = 1)"""
CARRIER = f"""carrier_m AS (SELECT airline, service_type, p, passengers, {", ".join(METRICS)} FROM (
  SELECT trim(airline) AS airline, {SERVICE} AS service_type, {P} AS p, passengers, {", ".join(METRICS)},
         row_number() OVER (PARTITION BY trim(airline), {SERVICE}, {P} ORDER BY loaded_at DESC, passengers DESC NULLS LAST, {", ".join(m + " DESC NULLS LAST" for m in METRICS)}) AS k
  FROM carrier_monthly WHERE airline IS NOT NULL AND service_type IS NOT NULL AND year IS NOT NULL AND month IS NOT NULL) WHERE k = 1)"""
ROUTE = f"""route_m AS (SELECT origin, destination, p, passengers FROM (
  SELECT upper(trim(origin)) AS origin, upper(trim(destination)) AS destination, {P} AS p, passengers,
         row_number() OVER (PARTITION BY upper(trim(origin)), upper(trim(destination)), {P} ORDER BY loaded_at DESC, passengers DESC NULLS LAST) AS k
  FROM domestic_route_monthly WHERE origin IS NOT NULL AND destination IS NOT NULL AND year IS NOT NULL AND month IS NOT NULL) WHERE k = 1)"""
QUARTER = f"""quarter_m AS (SELECT airport, q, passengers, departures, arrivals FROM (
  SELECT upper(trim(airport)) AS airport, {Y} * 4 + quarter - 1 AS q, passengers, departures, arrivals,
         row_number() OVER (PARTITION BY upper(trim(airport)), {Y} * 4 + quarter - 1 ORDER BY loaded_at DESC, passengers DESC NULLS LAST, departures DESC NULLS LAST, arrivals DESC NULLS LAST) AS k
  FROM airport_international_quarterly WHERE airport IS NOT NULL AND year IS NOT NULL AND quarter BETWEEN 1 AND 4) WHERE k = 1)"""

_GRID = f"""r AS (SELECT upper(trim(airport)) AS airport, {P} AS p, passengers, loaded_at FROM airport_monthly WHERE passengers IS NOT NULL AND airport IS NOT NULL),
b AS (SELECT airport, p, passengers AS reading FROM (SELECT *, row_number() OVER (PARTITION BY airport, p ORDER BY loaded_at DESC, passengers DESC) AS k FROM r) WHERE k = 1),
g AS (SELECT airport, unnest(generate_series(min(p), max(p))) AS p FROM b GROUP BY airport),
j AS (SELECT g.airport, g.p, b.reading, last_value(CASE WHEN b.reading IS NOT NULL THEN g.p END IGNORE NULLS) OVER w AS seen,
             last_value(b.reading IGNORE NULLS) OVER w AS held
      FROM g LEFT JOIN b USING (airport, p) WINDOW w AS (PARTITION BY g.airport ORDER BY g.p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _snapshot(table: str, entity: str, keys: list[str], measures: list[str]) -> str:
    value = "concat_ws('|', " + ", ".join(f"coalesce(CAST({m} AS VARCHAR), '?')" for m in measures) + ")"
    key = ", ".join(f"{k} AS k{i}" for i, k in enumerate(keys))
    names = ", ".join(f"k{i}" for i in range(len(keys)))
    on = " AND ".join(f"a.k{i} IS NOT DISTINCT FROM b.k{i}" for i in range(len(keys)))
    return f"""SELECT '{table}' AS table_name, CAST(s AS INTEGER) AS snapshot_no, entity, CAST(yy AS INTEGER) AS year, CAST(mm AS INTEGER) AS month, change_kind, before, after FROM (
  WITH d AS (SELECT DISTINCT snapshot_no AS s, {key}, {entity} AS entity, {Y} AS yy, month AS mm, {value} AS v FROM {table}_snapshots WHERE snapshot_no IS NOT NULL),
  f AS (SELECT s, {names}, min(entity) AS entity, min(yy) AS yy, min(mm) AS mm, list_sort(list(DISTINCT v)) AS v FROM d GROUP BY s, {names}),
  n AS (SELECT s, lead(s) OVER (ORDER BY s) AS nxt FROM (SELECT DISTINCT s FROM f)),
  a AS (SELECT f.*, n.nxt FROM f JOIN n USING (s) WHERE n.nxt IS NOT NULL),
  b AS (SELECT f.* FROM f WHERE s IN (SELECT nxt FROM n))
  SELECT coalesce(b.s, a.nxt) AS s, coalesce(b.entity, a.entity) AS entity, coalesce(b.yy, a.yy) AS yy, coalesce(b.mm, a.mm) AS mm,
         CASE WHEN a.s IS NULL THEN 'added' WHEN b.s IS NULL THEN 'removed' ELSE 'changed' END AS change_kind, a.v[1] AS before, b.v[1] AS after
  FROM a FULL JOIN b ON a.nxt = b.s AND {on} WHERE a.v IS DISTINCT FROM b.v)"""


_SNAPSHOTS = " UNION ALL ".join(
    (
        _snapshot("airport_monthly", CODE.format("airport"), [LOOSE.format("airport"), Y, "month"], ["passengers", "departures", "arrivals"]),
        _snapshot("carrier_monthly", f"concat_ws('|', trim(airline), {SERVICE})", [LOOSE.format("airline"), LOOSE.format("service_type"), Y, "month"], ["passengers", *(f"CAST(round({m} * 1000) AS BIGINT)" for m in METRICS)]),
        _snapshot("domestic_route_monthly", "concat_ws('|', upper(trim(origin)), upper(trim(destination)))", [LOOSE.format("origin"), LOOSE.format("destination"), Y, "month"], ["passengers"]),
    )
)


def _trailing(table: str, source: str, entity: str) -> str:
    frames = ", ".join(f"{f} AS {n}_{w}" for w in (3, 12) for n, f in (("total", f"sum(coalesce(v, 0)) OVER w{w}"), ("active", f"count(v) OVER w{w}")))
    return f"""SELECT '{table}' AS table_name, entity, p, v, {frames} FROM (
  WITH s AS (SELECT {entity} AS entity, p, sum(passengers) AS v FROM {source} WHERE passengers IS NOT NULL GROUP BY 1, 2),
  g AS (SELECT entity, unnest(generate_series(min(p), max(p))) AS p FROM s GROUP BY entity)
  SELECT g.entity, g.p, s.v FROM g LEFT JOIN s USING (entity, p))
  WINDOW w3 AS (PARTITION BY entity ORDER BY p RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), w12 AS (PARTITION BY entity ORDER BY p RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)"""


def _issues(table: str, column: str, outside: str, digit: str | None) -> str:
    top = (
        f"(SELECT max(n) * 1.0 / sum(n) FROM (SELECT {digit} AS d, count(*) AS n FROM {table} x WHERE x.load_no = l.load_no AND {column} IS NOT NULL GROUP BY 1)) > 0.8" if digit else "false"
    )
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, CAST(load_no AS INTEGER) AS load_no, issue_kind FROM (SELECT load_no, unnest([
    CASE WHEN nulls > 0.1 * n THEN 'nulls' END, CASE WHEN bad > 0.02 * (n - nulls) THEN 'domain' END,
    CASE WHEN med > 5 * rest OR med < rest / 5 THEN 'scale' END, CASE WHEN top THEN 'precision' END]) AS issue_kind
  FROM (SELECT load_no, count(*) AS n, count(*) FILTER (WHERE {column} IS NULL) AS nulls, count(*) FILTER (WHERE {outside}) AS bad, median({column}) AS med,
               (SELECT median(o.{column}) FROM {table} o WHERE o.load_no <> l.load_no) AS rest, {top} AS top
        FROM {table} l WHERE load_no IS NOT NULL GROUP BY load_no)) WHERE issue_kind IS NOT NULL"""


def _sheet_changes(headers: dict[str, tuple[str, ...]]) -> str:
    """Header and type changes between consecutive files of a feed, by joins of exploded headers."""
    known = ", ".join(f"('{re.sub('[^a-z0-9]', '', h.lower())}', '{f}')" for f, hs in headers.items() for h in {f, *hs})
    return f"""WITH base AS (SELECT DISTINCT file, row_idx, cells FROM sheet_rows WHERE file IS NOT NULL AND row_idx IS NOT NULL AND cells IS NOT NULL),
known(key, field) AS (SELECT DISTINCT * FROM (VALUES {known})),
head AS (SELECT file, arg_min(cells, row_idx) AS header, min(row_idx) AS h FROM base
  WHERE lower(trim(cells[1])) = 'airline' AND lower(trim(cells[2])) = 'type' AND lower(trim(cells[3])) = 'year' AND lower(trim(cells[4])) = 'month' GROUP BY file),
cols AS (SELECT file, pos, header[pos] AS name FROM (SELECT file, header, unnest(generate_series(5, len(header))) AS pos FROM head)),
cell AS (SELECT b.file, pos, trim(b.cells[pos]) AS c FROM (SELECT base.*, head.h, unnest(generate_series(5, len(head.header))) AS pos FROM base JOIN head USING (file)) b WHERE b.row_idx > b.h),
kinds AS (SELECT file, pos, CASE WHEN bool_and(regexp_matches(c, '^[0-9]+$')) THEN 'whole' WHEN bool_and(regexp_matches(c, '^[0-9]+([.][0-9]*)?$|^[.][0-9]+$')) THEN 'decimal' ELSE 'text' END AS kind
  FROM cell WHERE c IS NOT NULL AND lower(c) NOT IN ('', '-', 'n/a') GROUP BY file, pos),
f AS (SELECT cols.file, coalesce(known.field, trim(regexp_replace(lower(name), '[^a-z0-9]+', '_', 'g'), '_')) AS field, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS key, coalesce(kind, 'whole') AS kind
  FROM cols LEFT JOIN kinds USING (file, pos) LEFT JOIN known ON known.key = regexp_replace(lower(name), '[^a-z0-9]', '', 'g') WHERE regexp_replace(lower(name), '[^a-z0-9]', '', 'g') <> ''),
s AS (SELECT file, lag(file) OVER (PARTITION BY regexp_extract(file, '^carrier_(.+)_([0-9]{{4}})_([0-9]{{1,2}})[.]xlsx$', 1) ORDER BY regexp_extract(file, '_([0-9]{{4}})_([0-9]{{1,2}})[.]xlsx$', 1), CAST(regexp_extract(file, '_([0-9]{{1,2}})[.]xlsx$', 1) AS INTEGER)) AS prev FROM head),
a AS (SELECT s.file, f.field, f.key, f.kind FROM s JOIN f USING (file) WHERE prev IS NOT NULL),
b AS (SELECT s.file, f.field, f.key, f.kind FROM s JOIN f ON f.file = s.prev)
SELECT DISTINCT coalesce(a.file, b.file) AS file, coalesce(a.field, b.field) AS field, k.change_kind FROM a FULL JOIN b ON a.file = b.file AND a.field = b.field
CROSS JOIN (VALUES ('added'), ('removed'), ('renamed'), ('retyped')) k(change_kind)
WHERE CASE k.change_kind WHEN 'added' THEN b.file IS NULL WHEN 'removed' THEN a.file IS NULL WHEN 'renamed' THEN a.key <> b.key ELSE a.kind <> b.kind END"""


_COLUMNS = {"year": "^[0-9]{4}$", "month": "^([1-9]|1[0-2])$", "airport": "^[A-Z]{5}$", "passengers": "^[0-9]+$", "departures": "^[0-9]+$", "arrivals": "^[0-9]+$"}

def _sheet_table(target) -> str:
    """The table of all files by the list of known headers alone."""
    squash = lambda h: re.sub("[^a-z0-9]", "", h.lower())
    out = []
    for field, headers in target.aliases.items():
        names = ", ".join(f"'{squash(h)}'" for h in (field, *headers))
        at = f"list_position(list_transform(h, lambda x: list_contains([{names}], x)), true)"
        number = f"replace(regexp_extract(trim(cells[{at}]), '^[0-9.,]+'), ',', '{'.' if field in target.comma_decimals else ''}')"
        unit = " ".join(f"WHEN '{squash(h)}' THEN {u}" for h, u in target.units.items())
        value = f"TRY_CAST({number} AS DOUBLE) * (CASE h[{at}] {unit} ELSE 1.0 END)::DOUBLE"
        out.append(f"CAST(round({value}) AS BIGINT) AS {field}" if field == "passengers" else f"{value} AS {field}")
    heading = " AND ".join(f"lower(trim(cells[{k}])) = '{name}'" for k, name in enumerate(target.keys, 1))
    return f"""WITH b AS (SELECT DISTINCT file, CAST(row_idx AS INTEGER) AS row_idx, cells FROM sheet_rows WHERE file IS NOT NULL AND row_idx IS NOT NULL AND cells IS NOT NULL),
t AS (SELECT file, arg_min(cells, row_idx) AS header, min(row_idx) AS top FROM b WHERE {heading} GROUP BY file),
d AS (SELECT b.*, list_transform(header, lambda x: regexp_replace(lower(x), '[^a-z0-9]', '', 'g')) AS h FROM b JOIN t USING (file) WHERE row_idx > top)
SELECT file, row_idx, trim(cells[1]) AS airline, regexp_replace(lower(trim(cells[2])), '[ _]+', '_', 'g') AS service_type, TRY_CAST(trim(cells[3]) AS INTEGER) AS year, TRY_CAST(trim(cells[4]) AS INTEGER) AS month,
  {", ".join(out)} FROM d"""


SQL = {
    "p1_found": f"WITH {_GRID} SELECT airport, CAST(p // 12 AS INTEGER) AS year, CAST(p % 12 + 1 AS INTEGER) AS month FROM j WHERE reading IS NULL",
    "p1_grid": f"""WITH {_GRID} SELECT airport, CAST(p // 12 AS INTEGER) AS year, CAST(p % 12 + 1 AS INTEGER) AS month, reading,
  CASE WHEN p - seen <= 2 THEN held END AS value, CASE WHEN reading IS NOT NULL THEN 'observed' WHEN p - seen <= 2 THEN 'carried' ELSE 'missing' END AS status FROM j""",
    "p2_found": _sheet_changes(CARRIER_HEADERS),
    "p2_table": _sheet_table(CARRIER_FILES),
    "p3_trailing": f"""WITH {AIRPORT}, {CARRIER}, t AS ({_trailing("airport_monthly", "airport_m", "airport")} UNION ALL {_trailing("carrier_monthly", "carrier_m", "concat_ws('|', airline, service_type)")})
SELECT table_name, entity, CAST(p // 12 AS INTEGER) AS year, CAST(p % 12 + 1 AS INTEGER) AS month, CAST(coalesce(v, 0) AS BIGINT) AS passengers,
  CAST(total_3 AS BIGINT) AS total_3, CAST(total_3 AS DOUBLE) / 3.0 AS avg_3, CAST(active_3 AS INTEGER) AS active_3,
  CAST(total_12 AS BIGINT) AS total_12, CAST(total_12 AS DOUBLE) / 12.0 AS avg_12, CAST(active_12 AS INTEGER) AS active_12 FROM t""",
    "p4_found": f"SELECT DISTINCT table_name, snapshot_no, entity, year, month, change_kind FROM ({_SNAPSHOTS})",
    "p4_changes": f"SELECT table_name, snapshot_no, change_kind, entity, year, month, before, after FROM ({_SNAPSHOTS})",
    "p5_found": """WITH w AS (SELECT upper(trim(canonical)) AS canonical, CAST(coalesce(lo, 0) AS BIGINT) AS lo, CAST(coalesce(hi, 99999) AS BIGINT) AS hi FROM entity_windows WHERE canonical IS NOT NULL),
k AS (SELECT * FROM w WHERE lo <= hi),
m AS (SELECT *, max(hi) OVER (PARTITION BY canonical ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM k),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY canonical ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS n FROM m),
s AS (SELECT canonical, n, min(lo) AS lo, max(hi) AS hi FROM g GROUP BY canonical, n),
x AS (SELECT *, lead(lo) OVER (PARTITION BY canonical ORDER BY lo) AS nxt FROM s)
SELECT canonical, 'period' AS span_kind, CAST(lo AS INTEGER) AS lo, CAST(hi AS INTEGER) AS hi FROM x
UNION ALL SELECT canonical, 'gap', CAST(hi + 1 AS INTEGER), CAST(nxt - 1 AS INTEGER) FROM x WHERE nxt IS NOT NULL""",
    "p7_found": " UNION ALL ".join(
        (
            _issues("airport_monthly", "passengers", "passengers < 0", "abs(passengers) % 10"),
            _issues("airport_international_quarterly", "quarter", "quarter < 1 OR quarter > 4", None),
            _issues("carrier_monthly", "passenger_load_factor", "passenger_load_factor < 0 OR passenger_load_factor > 100", "CAST(round(abs(passenger_load_factor) * 1000) AS BIGINT) % 10"),
        )
    ),
    "p7_columns": " UNION ALL ".join(
        f"SELECT load_no, '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct, count(*) FILTER (WHERE NOT regexp_matches(CAST({c} AS VARCHAR), '{x}')) AS n_violations, "
        + (f"NULL::DOUBLE AS least, NULL::DOUBLE AS most, min({c}) AS first, max({c}) AS last " if c == "airport" else f"CAST(min({c}) AS DOUBLE) AS least, CAST(max({c}) AS DOUBLE) AS most, NULL::VARCHAR AS first, NULL::VARCHAR AS last ")
        + "FROM airport_monthly GROUP BY load_no"
        for c, x in _COLUMNS.items()
    ),
}
