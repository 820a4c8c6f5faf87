"""Selecting, stacking, flattening and ordering rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns by name; names may hold spaces or parentheses."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def first_rows(df: DataFrame, id_col: str, n: int = 5) -> DataFrame:
    """The n rows of smallest id: a top-n per task, then a merge of n rows each."""
    return df.orderBy(id_col).limit(n)


def map_codes(df: DataFrame, column: str, mapping: dict, name: str) -> DataFrame:
    """Replace codes by labels; a code without a label becomes NULL."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return df.withColumn(name, F.element_at(F.create_map(*pairs), F.col(column)))


def stack_rows(blocks: list[DataFrame]) -> DataFrame:
    """Blocks one below the other, duplicates kept."""
    result = blocks[0]
    for block in blocks[1:]:
        result = result.unionByName(block)
    return result


def join_columns(left: DataFrame, right: DataFrame, id_col: str) -> DataFrame:
    """Columns of two tables side by side, matched by id."""
    return left.join(right, id_col)


def explode_array(df: DataFrame, id_col: str, column: str) -> DataFrame:
    """One row per array element with its position."""
    return df.select(id_col, F.posexplode(column).alias("pos", "value"))


def flatten_nested(df: DataFrame, column: str) -> DataFrame:
    """Array of arrays to one array."""
    return df.withColumn(column, F.flatten(column))


def sort_values(df: DataFrame, value: str, id_col: str) -> DataFrame:
    """Sort by a value; the id splits the range partitions of a value that many rows share."""
    return df.orderBy(value, id_col)


def best_row(df: DataFrame, key: str, metric: str) -> DataFrame:
    """Key of the smallest metric; ties go to the smallest key. Rows without a metric (NULL or NaN) can't win."""
    known = df.where(F.col(metric).isNotNull() & ~F.isnan(F.col(metric).cast("double")))
    return known.agg(
        F.min_by(F.col(key), F.struct(metric, key)).alias(key), F.min(metric).alias(metric)
    )
