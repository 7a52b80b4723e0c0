"""Runnable queries over the driver tables, with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.plans import align, episodic, files, metrics, mixtures, samples, text, validation  # noqa: F401  they register their queries
from millrace.plans.registry import QUERIES, SQL, bind


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: bind(f) for name, f in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
