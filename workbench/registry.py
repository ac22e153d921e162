"""Named queries over the test tables and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def big(name: str | Column, alias: str | None = None) -> Column:
    col = F.col(name) if isinstance(name, str) else name
    return col.cast("bigint").alias(alias or name)


def real(name: str | Column, alias: str | None = None, digits: int = 6) -> Column:
    """Rounded double, so that the order of float sums does not show. ``+ 0`` drops -0.0."""
    col = F.col(name) if isinstance(name, str) else name
    return (F.round(col.cast("double"), digits) + F.lit(0.0)).alias(alias or name)


def r(expr: str, name: str, digits: int = 6) -> str:
    return f"round(({expr})::DOUBLE, {digits}) + 0.0::DOUBLE AS {name}"


def b(expr: str, name: str) -> str:
    return f"({expr})::BIGINT AS {name}"
