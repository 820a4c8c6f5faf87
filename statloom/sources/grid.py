"""Evaluation grids as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.gram import value_ranges


def _spaced(position, lo: float, hi: float, n: int):
    step = (hi - lo) / (n - 1) if n > 1 else 0.0
    return F.when(position == n - 1, F.lit(float(hi))).otherwise(F.lit(float(lo)) + position * F.lit(step)) if n > 1 else F.lit(float(lo))


def linspace(spark: SparkSession, lo: float, hi: float, n: int, name: str = "x") -> DataFrame:
    """n evenly spaced points, both ends included."""
    return spark.range(n).select("id", _spaced(F.col("id"), lo, hi, n).alias(name))


def mesh(spark: SparkSession, axes: dict[str, tuple[float, float, int]]) -> DataFrame:
    """All combinations of several axes, the first axis running fastest; computed from the id."""
    size = 1
    for _, _, n in axes.values():
        size *= n
    columns, stride = [], 1
    for name, (lo, hi, n) in axes.items():
        position = F.floor(F.col("id") / F.lit(stride)) % F.lit(n)
        columns.append(_spaced(position, lo, hi, n).alias(name))
        stride *= n
    return spark.range(size).select("id", *columns)


def data_mesh(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    """Mesh over the value ranges found in a table."""
    ranges = value_ranges(df, columns)
    return mesh(df.sparkSession, {c: (*ranges[c][:2], n) for c in columns})


def data_line(df: DataFrame, column: str, n: int, name: str = "x") -> DataFrame:
    lo, hi, _ = value_ranges(df, [column])[column]
    return linspace(df.sparkSession, lo, hi, n, name)
