"""Queries over the given tables, one per operator, and the SQL that must give the same rows."""

from __future__ import annotations

from vocalake.adapters import oracle, view

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None, *views: str):
    """Registers f(*views) -> DataFrame under name; sql is DuckDB's over the same views."""
    def keep(f):
        QUERIES[name] = lambda spark, sf_dir: f(*[view(spark, sf_dir, v) for v in views])
        if sql:
            ORACLE_SQL[name] = oracle(sql)
        return f

    return keep
