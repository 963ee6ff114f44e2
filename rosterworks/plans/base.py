"""How the plan modules register their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.views import AS_OF, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The fixed clock in DuckDB's SQL.
NOW = f"TIMESTAMP '{AS_OF}'"


def now():
    """The fixed clock as a column."""
    return F.expr(f"TIMESTAMP_NTZ '{AS_OF}'")


def query(views: str = "", sql: str | None = None):
    """Register the function under its name, with the SQL that must give the same rows."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = oracle(views, sql)
        return function

    return register
