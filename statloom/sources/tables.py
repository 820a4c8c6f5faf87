"""Reading and writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def load_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """CSV with a declared schema: no inference pass, and a malformed row fails the read."""
    return spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").csv(path)


def save(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def table_from_columns(spark: SparkSession, columns: dict[str, list], schema: str) -> DataFrame:
    """Small table from named lists; `schema` is a DDL string in the same order."""
    return spark.createDataFrame(list(zip(*columns.values())), schema)
