"""Queries by name: a function of Tables, and the SQL with the same rows, where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.model import EPISODES_SQL, STEPS_SQL, Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name. {STEPS} and {EPISODES} in the SQL stand for the carriers' definitions."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql.replace("{STEPS}", STEPS_SQL).replace("{EPISODES}", EPISODES_SQL)
        return f

    return add


def bind(f: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, path: f(Tables(spark, path))


def r(x: Column, digits: int = 6) -> Column:
    """Rounded, and never a negative zero."""
    return F.round(x, digits) + F.lit(0.0)
