"""Collects queries with their oracle SQL and resolves the views the SQL names."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.views import VIEWS, view_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
# Named subqueries of the oracle, in order of definition; later ones may use earlier ones.
CTES: dict[str, str] = {name: view_sql(name) for name in VIEWS}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = with_views(sql)
        return function
    return register


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


def with_views(sql: str) -> str:
    """Put the named subqueries that ``sql`` needs in front of it."""
    needed: set[str] = set()
    pending = [sql]
    while pending:
        text = pending.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", text):
                needed.add(name)
                pending.append(CTES[name])
    parts = [f"{name} as (\n{body}\n)" for name, body in CTES.items() if name in needed]
    sql = sql.strip()
    if sql.startswith("with "):
        parts.append(sql.removeprefix("with "))
        return "with " + ",\n".join(parts)
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + sql
