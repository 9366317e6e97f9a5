"""The list of registered queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthkit.functions.columns import tidy

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; `sql` gives the same result in ANSI SQL over the same tables."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int = 4, **by_column: int) -> DataFrame:
    """Doubles rounded for comparison, `digits` by default."""
    return df.select(
        *[
            tidy(F.col(name), by_column.get(name, digits)).alias(name) if kind == "double" else F.col(name)
            for name, kind in df.dtypes
        ]
    )
