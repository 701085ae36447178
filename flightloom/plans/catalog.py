"""All queries of the core, and the SQL that says the same."""

from __future__ import annotations

from flightloom.plans import data_queries, data_sql, reference_queries


def queries() -> dict:
    return {**data_queries.QUERIES, **reference_queries.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**data_sql.SQL, **reference_queries.SQL}
