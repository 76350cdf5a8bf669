"""Registered queries of the panel engine and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.plans.ctes import CTES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, r: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query, and the DuckDB SQL that follows the shared common table expressions.

    ``r`` names ratio columns, which both sides give with six decimals.
    """

    def keep(f: Query) -> Query:
        @wraps(f)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            df = f(spark, sf)
            return df.withColumns({c: F.round(c, 6) for c in r}) if r else df

        QUERIES[name] = run
        if sql:
            replaced = "SELECT * REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in r) + f") FROM (\n{sql}\n)" if r else sql
            ORACLE[name] = CTES + replaced
        return f

    return keep
