"""Classification trees, random forests and boosted trees over the exact split search.

All trees of a forest grow in the same passes: a row's weight in each tree is a whole number drawn from a hash of its id, as many times as a
sample with replacement would take it. Boosting adds one tree per round, fitted to what the trees so far leave: residuals for a number,
gradient and curvature of the log loss for a class of two. Nothing but the trees, a few hundred numbers each, is kept between passes.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import uniform
from ..plans.vectors import list_column, matrix
from . import split_search
from .exact_tree import feature_ranges, target_moments, training_rows
from .split_search import Counts, Node, Sums, Tree, descend, grow, recentred

MOST_CLASSES = 100
MOST_COPIES = 12  # a sample with replacement takes a row more often with a chance under 1e-10


@dataclass
class TreeModel:
    """Trees as (feature, threshold, value) arrays by node number; a node's values add up over the trees, from `base`."""

    features: list[str]
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    base: np.ndarray
    labels: list | None = None  # classes of a classifier
    binary: bool = False  # one value: the log odds of the second class

    def values(self, x: np.ndarray) -> np.ndarray:
        total = np.tile(self.base, (len(x), 1))
        for feature, threshold, value in self.trees:
            total += value[descend((feature, threshold), x)]
        return total

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Add the predicted number or class, and for a classifier `<name>_shares`, one number for each class in label order. A row with a
        missing feature gets NULL."""
        shared = df.sparkSession.sparkContext.broadcast(self)  # a few thousand nodes

        @F.arrow_udf("array<double>")
        def values(x: pa.Array) -> pa.Array:
            if not len(x):
                return pa.array([], pa.list_(pa.float64()))
            return list_column(shared.value.values(matrix(x)))

        x = F.array(*[F.col(f"`{f}`").cast("double") for f in self.features])
        whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v))
        filled = F.transform(x, lambda v: F.coalesce(v, F.lit(0.0)))
        scored = df.withColumn("__v", F.when(whole, values(filled)))
        if self.labels is None:
            return scored.withColumn(name, F.col("__v")[0]).drop("__v")
        if self.binary:
            p = 1 / (1 + F.exp(-F.col("__v")[0]))
            scored = scored.withColumn("__v", F.when(F.col("__v").isNotNull(), F.array(1 - p, p)))
        top = F.array_position("__v", F.array_max("__v")).cast("int")
        label = F.element_at(F.array(*[F.lit(v) for v in self.labels]), top)
        return scored.withColumn(name, F.when(F.col("__v").isNotNull(), label)).withColumnRenamed("__v", f"{name}_shares")


def copies(id_col: str, seed) -> Column:
    """How often a sample with replacement takes a row: a Poisson number with mean one, drawn from a hash of the id."""
    u = uniform(id_col, seed)
    below = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(MOST_COPIES)]
    return sum((F.when(u >= F.lit(b), 1).otherwise(0) for b in below), F.lit(0)).cast("int")


def drawn_features(seed, tree: int, node: int, width: int, number: int) -> list[int]:
    """The features that a node of a forest looks at: those of smallest hash."""
    order = sorted(range(width), key=lambda f: hashlib.md5(f"{seed}/{tree}/{node}/{f}".encode()).hexdigest())
    return sorted(order[:number])


def _labels(df: DataFrame, label: str) -> list:
    found = df.where(F.col(f"`{label}`").isNotNull()).select(F.col(f"`{label}`").alias("l")).distinct().limit(MOST_CLASSES + 1).collect()
    if len(found) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes in {label}")
    return sorted(r["l"] for r in found)


def fit_trees(
    df: DataFrame,
    features: list[str],
    label: str,
    kind: str = "tree",
    task: str = "regression",
    id_col: str = "id",
    depth: int = 5,
    trees: int = 10,
    rounds: int = 10,
    rate: float = 0.1,
    ridge: float = 1.0,
    considered: int | None = None,
    seed=42,
) -> TreeModel:
    """Fit a `tree`, a `forest` of `trees`, or `boosting` of `rounds` trees, each of at most `depth` levels, for `regression` or `classification`.

    Rows with a missing feature or label take no part. `considered` is the number of features a node of a forest looks at, by
    default the square root of all, rounded up. A forest averages its trees' means or class shares; boosting adds `rate` times each tree, for two
    classes only. A predicted class is the one of largest share, the smallest label of a tie.
    """
    classify = task == "classification"
    labels = _labels(df, label) if classify else None
    y = F.col(f"`{label}`").cast("double")
    if classify:
        y = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(f"`{label}`")) - 1
        y = F.when(F.col(f"`{label}`").isNotNull(), y)
    weights = F.array(*[copies(id_col, f"{seed}/{t}") for t in range(trees)]) if kind == "forest" else None
    rows = training_rows(df, features, y, weights).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if kind == "boosting":
            return _boosted(rows, features, labels, depth, rounds, rate, ridge)
        return _averaged(rows, features, labels, trees if kind == "forest" else 1, depth, considered if kind == "forest" else len(features), seed)
    finally:
        rows.unpersist()


def _arrays(tree: Tree, values: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    feature, threshold = tree.arrays()
    width = len(next(iter(values.values())))
    value = np.zeros((len(feature), width))
    for i, v in values.items():
        value[i] = v
    return feature, threshold, value


def _averaged(rows, features, labels, number, depth, considered, seed) -> TreeModel:
    width = len(features)
    considered = considered or math.ceil(math.sqrt(width))
    extra = []
    for t in range(number):
        w = F.col("w")[t]
        if labels:
            extra += [F.sum(F.when(F.col("y") == c, w).otherwise(0)).alias(f"c{t}_{c}") for c in range(len(labels))]
        else:
            extra += [F.sum(w).alias(f"n{t}"), F.sum(w * F.col("y")).alias(f"s{t}")]
    found, low, high = feature_ranges(rows, width, F.min("y").alias("least"), F.max("y").alias("most"), F.avg("y").alias("mean"), *extra)
    statistic, roots = (Counts(len(labels)), []) if labels else (Sums(), [])
    for t in range(number):
        if labels:
            roots.append(Node(np.array([found[f"c{t}_{c}"] for c in range(len(labels))], dtype=np.float64), low, high, 0.0, 1.0))
        else:
            n = float(found[f"n{t}"])
            mean = found[f"s{t}"] / n if n else 0.0
            roots.append(Node(np.array([n, n, 0.0, 0.0, 0.0]), low, high, found["least"], found["most"], mean))
    if not labels:
        spread = rows.agg(*[F.sum(F.col("w")[t] * (F.col("y") - F.lit(r.centre)) ** 2).alias(f"q{t}") for t, r in enumerate(roots)]).first()
        for t, r in enumerate(roots):
            r.totals[split_search.SQUARE] = spread[t]
    allowed = None if considered >= width else lambda t, i: drawn_features(seed, t, i, width, considered)
    grown = grow(rows, width, statistic, depth, roots, None, allowed)
    arrays = []
    for tree in grown:
        if labels:
            values = {i: node.totals / max(node.totals.sum(), 1.0) / number for i, node in tree.nodes.items()}
        else:
            values = {i: np.array([node.centre / number]) for i, node in tree.nodes.items()}
        arrays.append(_arrays(tree, values))
    return TreeModel(features, arrays, np.zeros(len(labels) if labels else 1), labels)


def _boosted(rows, features, labels, depth, rounds, rate, ridge) -> TreeModel:
    if labels and len(labels) != 2:
        raise ValueError("boosting takes two classes")
    width = len(features)
    found, low, high = feature_ranges(rows, width, *target_moments())
    mean = found["mean"]
    base = math.log(mean / (1 - mean)) if labels else mean
    model = TreeModel(features, [], np.array([base]), labels, bool(labels))
    statistic = Sums(ridge, centred=False) if labels else Sums()
    for _ in range(rounds):
        targets = _logistic_targets(model) if labels else _residual_targets(model)
        root = _boosting_root(rows, low, high, targets, statistic)
        (tree,) = grow(rows, width, statistic, depth, [root], targets)
        if labels:
            values = {i: np.array([rate * n.totals[split_search.SUM] / (n.totals[split_search.WEIGHT] + ridge)]) for i, n in tree.nodes.items()}
        else:
            values = {i: np.array([rate * n.centre]) for i, n in tree.nodes.items()}
        model = TreeModel(features, [*model.trees, _arrays(tree, values)], model.base, labels, bool(labels))
    return model


def _residual_targets(model: TreeModel):
    return lambda x, y: (y - model.values(x)[:, 0], np.ones(len(y)))


def _logistic_targets(model: TreeModel):
    def targets(x, y):
        p = 1.0 / (1.0 + np.exp(-model.values(x)[:, 0]))
        return y - p, np.maximum(p * (1.0 - p), 1e-16)

    return targets


def _boosting_root(rows: DataFrame, low, high, targets, statistic: Sums) -> Node:
    """Totals of this round's targets in one pass: a row of sums from each task."""
    columns = ["n", "w", "s", "q", "p", "least", "most"]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                y = batch.column("y").to_numpy(zero_copy_only=False)
                target, curvature = targets(matrix(batch.column("x")), y)
                sums = statistic.of_rows(np.ones(len(y)), target, curvature).sum(axis=0)
                ratio = target / curvature
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*sums, ratio.min(), ratio.max())], columns)

    parts = rows.mapInArrow(run, ", ".join(f"{c} double" for c in columns))
    found = parts.agg(*[F.sum(c).alias(c) for c in columns[:5]], F.min("least").alias("least"), F.max("most").alias("most")).first()
    root = Node(np.array([found[c] for c in columns[:5]]), low, high, found["least"], found["most"])
    return recentred(root) if statistic.centred else root

