"""Regression tree whose splits are exact: every gap between two values is a candidate.

The search is `split_search`: bins of sums, a bound on what a cut inside a bin could gain, and a closer look only where the bound
reaches the best known gain. Each level is a few passes over the rows with a small aggregate; nothing is sorted or shuffled by value.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import split_search
from .split_search import TIE_DIGITS  # noqa: F401  (the rounding that decides ties)

NODE_SCHEMA = "node bigint, depth int, feature string, threshold double, prediction double, n bigint"


@dataclass
class Node:
    n: int
    mean: float
    feature: str | None = None
    threshold: float | None = None


@dataclass
class RegressionTree:
    """Nodes by number: the root is 1, the children of i are 2i (at most the threshold) and 2i+1."""

    nodes: dict[int, Node]

    def leaf(self) -> Column:
        return self._walk(1, lambda i: F.lit(i).cast("bigint"))

    def column(self) -> Column:
        return self._walk(1, lambda i: F.lit(float(self.nodes[i].mean)))

    def _walk(self, i: int, end) -> Column:
        node = self.nodes[i]
        if node.feature is None:
            return end(i)
        goes_left = F.col(f"`{node.feature}`").cast("double") <= F.lit(node.threshold)
        return F.when(goes_left, self._walk(2 * i, end)).otherwise(self._walk(2 * i + 1, end))

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        return df.withColumn(name, self.column())

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (i, i.bit_length() - 1, node.feature, node.threshold, node.mean, node.n)
            for i, node in sorted(self.nodes.items())
        ]
        return spark.createDataFrame(rows, NODE_SCHEMA)


def training_rows(df: DataFrame, features: list[str], y: Column, weights: Column | None = None) -> DataFrame:
    """`x, y, w` of the rows without a missing value, as the split search takes them."""
    x = [F.col(f"`{f}`").cast("double") for f in features]
    rows = df.select(F.array(*x).alias("x"), y.cast("double").alias("y"), (F.array(F.lit(1)) if weights is None else weights).alias("w"))
    return rows.where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)) & F.col("y").isNotNull() & ~F.isnan("y"))


def feature_ranges(rows: DataFrame, width: int, *extra: Column) -> tuple[dict, np.ndarray, np.ndarray]:
    """Other aggregates and the range of every feature, in one pass."""
    ends = [f(F.col("x")[i]).alias(f"{n}{i}") for i in range(width) for n, f in (("lo", F.min), ("hi", F.max))]
    found = rows.agg(F.count(F.lit(1)).alias("rows"), *extra, *ends).first().asDict()
    if not found["rows"]:
        raise ValueError("no rows to grow a tree from")
    return found, np.array([found[f"lo{i}"] for i in range(width)]), np.array([found[f"hi{i}"] for i in range(width)])


def sums_root(found: dict, low: np.ndarray, high: np.ndarray) -> split_search.Node:
    """Root over all rows with weight one, from the aggregates `mean, spread, least, most` of the target."""
    totals = np.array([found["rows"], found["rows"], 0.0, found["spread"], 0.0], dtype=np.float64)
    return split_search.Node(totals, low, high, found["least"], found["most"], found["mean"])


def target_moments(y: str = "y") -> list[Column]:
    spread = F.var_pop(y) * F.count(F.lit(1))
    return [F.avg(y).alias("mean"), spread.alias("spread"), F.min(y).alias("least"), F.max(y).alias("most")]


def fit_regression_tree(df: DataFrame, features: list[str], y: str, max_depth: int = 5) -> RegressionTree:
    rows = training_rows(df, features, F.col(f"`{y}`")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found, low, high = feature_ranges(rows, len(features), *target_moments())
        (tree,) = split_search.grow(rows, len(features), split_search.Sums(), max_depth, [sums_root(found, low, high)])
    finally:
        rows.unpersist()
    named = {}
    for i, node in tree.nodes.items():
        inner = node.feature >= 0
        named[i] = Node(int(node.totals[split_search.COUNT]), float(node.centre), features[node.feature] if inner else None, node.threshold if inner else None)
    return RegressionTree(named)
