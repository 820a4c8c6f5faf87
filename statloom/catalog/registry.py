"""Registry of queries and helpers shared by them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column: the order of a sum changes its last digits."""
    floats = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`").cast("double"), digits).alias(f.name) if isinstance(f.dataType, floats) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
