"""Collects (key, query, oracle) triples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``key`` with its DuckDB equivalent, or without one."""

    def add(fn: Query) -> Query:
        assert key not in QUERIES, key
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = " ".join(sql.split())
        return fn

    return add


def R(expression: str, digits: int) -> str:
    """SQL: round half up on the decimal reading of a number, as the library's ``settled_round`` does."""
    return f"CAST(ROUND(CAST(({expression}) AS DECIMAL(30, 10)), {digits}) AS DOUBLE)"


def PCT(condition: str, digits: int = 1) -> str:
    """SQL: rounded percentage of rows that satisfy a condition."""
    return R(f"100.0 * CAST(COUNT(*) FILTER (WHERE {condition}) AS DOUBLE) / COUNT(*)", digits)


def CORR(x: str, y: str) -> str:
    """SQL: correlation over complete pairs, NULL without variance."""
    both = f"({x}) IS NOT NULL AND ({y}) IS NOT NULL"
    sx, sy = (f"stddev_pop({v}) FILTER (WHERE {both})" for v in (x, y))
    return f"(covar_pop({x}, {y}) / NULLIF({sx} * {sy}, 0))"
