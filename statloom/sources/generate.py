"""Seeded sample data drawn over the ids of any table.

Each function adds columns to a table that has a unique id column, so the volume follows that
table and the values depend on (id, seed) alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import normal, uniform

# Parameters of the sample data sets.
# name: feature ranges, noise standard deviation
RANGES = {
    "education_1d": {"x": (9.0, 20.0)},
    "education_2d": {"x1": (9.0, 20.0), "x2": (1.0, 20.0)},
    "tv_sales": {"tv": (10.0, 300.0)},
    "tv_radio_sales": {"tv": (10.0, 300.0), "radio": (0.0, 50.0)},
    "cosine": {"x": (0.0, 1.0)},
    "cars_linear": {"horsepower": (50.0, 200.0)},
    "cars_quadratic": {"horsepower": (50.0, 200.0)},
    "line": {"x": (0.0, 10.0)},
}
NOISE = {
    "education_1d": 600.0,
    "education_2d": 800.0,
    "tv_sales": 2.5,
    "tv_radio_sales": 2.5,
    "cosine": 0.3,
    "cars_linear": 4.0,
    "cars_quadratic": 4.0,
    "line": 2.0,
}
# class: share of rows, (mean, sd) of income and balance
CREDIT = {
    0: {"share": 0.75, "income": (5000.0, 1500.0), "balance": (800.0, 300.0)},
    1: {"share": 0.25, "income": (4500.0, 1500.0), "balance": (1800.0, 400.0)},
}
CREDIT_LABELS = {0: "0: No Default", 1: "1: Default"}


def _mean(name: str) -> Column:
    x = F.col
    return {
        "education_1d": lambda: 2000.0 + 50.0 * x("x") + 15.0 * x("x") * x("x"),
        "education_2d": lambda: 1000.0
        + 150.0 * x("x1")
        + 200.0 * x("x2")
        + 8.0 * x("x1") * x("x1")
        - 4.0 * x("x2") * x("x2")
        + 10.0 * x("x1") * x("x2"),
        "tv_sales": lambda: 5.0 + 0.05 * x("tv"),
        "tv_radio_sales": lambda: 5.0 + 0.05 * x("tv") + 0.15 * x("radio"),
        "cosine": lambda: F.cos(3.0 * math.pi * x("x")),
        "cars_linear": lambda: 50.0 - 0.2 * x("horsepower"),
        "cars_quadratic": lambda: 50.0
        - 0.2 * x("horsepower")
        + 0.001 * x("horsepower") * x("horsepower"),
        "line": lambda: 2.0 * x("x") + 1.0,
    }[name]()


def sample_data(df: DataFrame, id_col: str, name: str, seed=42) -> DataFrame:
    """Features drawn uniformly, and the target `y` of a known formula plus normal noise."""
    features = {
        f: uniform(id_col, f"{seed}/{f}", lo, hi) for f, (lo, hi) in RANGES[name].items()
    }
    return df.withColumns(features).withColumn(
        "y", _mean(name) + normal(id_col, f"{seed}/noise", 0.0, NOISE[name])
    )


def credit_data(df: DataFrame, id_col: str, seed=42) -> DataFrame:
    """Two overlapping classes: income, balance, and the 0/1 default flag with its label."""
    flag = (uniform(id_col, f"{seed}/class") >= CREDIT[0]["share"]).cast("int")
    result = df.withColumn("defaulted", flag)
    for f in ("income", "balance"):
        z = normal(id_col, f"{seed}/{f}")
        (m0, s0), (m1, s1) = CREDIT[0][f], CREDIT[1][f]
        value = F.when(F.col("defaulted") == 1, m1 + s1 * z).otherwise(m0 + s0 * z)
        result = result.withColumn(f, value)
    status = F.when(F.col("defaulted") == 1, CREDIT_LABELS[1]).otherwise(CREDIT_LABELS[0])
    return result.withColumn("status", status)


def blobs(df: DataFrame, id_col: str, centers: list[tuple[float, ...]], sd: float = 1.0, seed=42) -> DataFrame:
    """Round normal clouds of equal size around centres, with the true cluster of every row."""
    cluster = F.pmod(F.col(id_col), F.lit(len(centers))).cast("int")
    result = df.withColumn("true_cluster", cluster)
    for d in range(len(centers[0])):
        at = F.element_at(F.array(*[F.lit(float(c[d])) for c in centers]), F.col("true_cluster") + 1)
        result = result.withColumn(f"x{d + 1}", at + normal(id_col, f"{seed}/x{d + 1}", 0.0, sd))
    return result
