"""Queries and the SQL that checks them, registered side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workloads.retail import RETAIL_SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
STEPS: dict[str, str] = dict(RETAIL_SQL)


def step(name: str, sql: str) -> None:
    """A named intermediate result for the checking SQL; steps refer to earlier ones."""
    STEPS[name] = sql


def with_steps(sql: str) -> str:
    """Put the steps a statement refers to, directly or not, in front of it."""
    seen: set[str] = set()
    needed: list[str] = []

    def visit(text: str) -> None:
        words = {w.strip("(),") for w in text.split()}
        for name, body in STEPS.items():
            if name in words and name not in seen:
                seen.add(name)
                visit(body)
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({STEPS[n]})" for n in needed) + "\n" + sql


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def oracles() -> dict[str, str]:
    """The checking SQL of each query, complete with its steps."""
    return {name: with_steps(sql) for name, sql in ORACLES.items()}
