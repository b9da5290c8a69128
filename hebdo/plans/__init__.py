"""Named queries over the base tables (Spark) and their DuckDB oracles."""

from hebdo.plans import q_aggregates, q_checks, q_clean, q_forecast, q_ingest, q_series, q_star  # noqa: F401
from hebdo.plans.registry import QUERIES  # noqa: F401


def queries():
    return {n: q.build for n, q in QUERIES.items()}


def oracle_sql():
    return {n: q.sql for n, q in QUERIES.items() if q.sql}
