"""Name -> Spark query, and name -> equivalent SQL where the result can be stated in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.numeric import rounded

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def round_columns(df: DataFrame, **digits: int) -> DataFrame:
    """Rounds the named columns for output, the same way in both engines."""
    return df.withColumns({c: rounded(F.col(c), d) for c, d in digits.items()})
