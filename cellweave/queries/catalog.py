"""The query table and the shared SQL of the derived inputs."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its twin."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return add


def with_views(sql: str) -> str:
    """Prepend the derived inputs a statement mentions, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(body)

    visit(sql)
    if not needed:
        return sql
    views = ",\n".join(f"{n} AS ({b})" for n, b in VIEWS.items() if n in needed)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {views},\n{body[14:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"


def even(expr: str, n: int) -> str:
    """SQL of rounding to n decimals, ties to even."""
    return f"(round_even(({expr}) * 1e{n}, 0)::DOUBLE / 1e{n})"
