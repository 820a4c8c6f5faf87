"""The tables behind exploratory charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash52
from ..plans.group_order import beside_groups, group_order_statistics, group_quantiles
from ..plans.order_stats import quantiles
from ..session import materialise

PROFILE_SCHEMA = (
    "column string, n bigint, missing bigint, mean double, sd double, low double, high double, "
    "q1 double, median double, q3 double"
)


def quartiles(df: DataFrame, category: str, value: str) -> DataFrame:
    """Exact quartiles per category, however many there are and however large one of them is."""
    return _sized_quartiles(df, category, value).drop("size")


def _sized_quartiles(df: DataFrame, category: str, value: str) -> DataFrame:
    found = group_quantiles(df, F.col(value), F.col(category).cast("string"), [0.25, 0.5, 0.75])
    names = enumerate(["q1", "median", "q3"])
    return found.select(F.col("g").alias("category"), *[F.col("q")[i].alias(n) for i, n in names], F.col("n").alias("size"))


def box_plot(df: DataFrame, category: str, value: str) -> DataFrame:
    """Quartiles, whiskers at the farthest points within 1.5 IQR, and row count per category; NULL is a category too."""
    q = materialise(_sized_quartiles(df, category, value).withColumnRenamed("category", "__category"), "quartiles")
    points = df.select(F.col(category).cast("string").alias("category"), F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("v") >= F.col("q1") - reach) & (F.col("v") <= F.col("q3") + reach)
    return (
        beside_groups(points, "category", q, "__category", "size")
        .groupBy("category", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("v"))).alias("low_whisker"),
            F.max(F.when(inside, F.col("v"))).alias("high_whisker"),
            F.count("v").alias("n"),
        )
    )


def scatter_points(df: DataFrame, id_col: str, category: str, n: int, seed=42) -> DataFrame:
    """The n rows of smallest hash per category.

    The n-th hash of each category is found first; picking the rows is then a join with one row per category and a filter, so a
    category that holds most rows is not gathered or sorted.
    """
    hashed = df.withColumn("__hash", hash52(id_col, seed))
    last = group_order_statistics(hashed, F.col("__hash"), F.col(f"`{category}`"), lambda size: F.array(F.least(F.lit(n), size)))
    cuts = last.select(F.col("g").alias("__category"), F.col("v").alias("__cut"))
    joined = hashed.join(cuts, F.col(f"`{category}`").eqNullSafe(F.col("__category")) & (F.col("__hash") <= F.col("__cut")))
    return joined.drop("__hash", "__category", "__cut")


def axis_range(df: DataFrame, value: str, below: float, above: float) -> DataFrame:
    """Value range with a margin on both sides."""
    return df.agg((F.min(value) - below).alias("low"), (F.max(value) + above).alias("high"))


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, missing count, mean, standard deviation, range and quartiles per column."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(f"`{c}`").cast("double")
        named = {"n": F.count(x), "missing": F.count(F.lit(1)) - F.count(x), "mean": F.avg(x),
                 "sd": F.stddev_samp(x), "low": F.min(x), "high": F.max(x)}
        aggs += [a.alias(f"{name}_{i}") for name, a in named.items()]
    sums = df.agg(*aggs).first()
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns]
    _, found = quantiles(df.select(F.inline(F.array(*pairs))), F.col("value"), [0.25, 0.5, 0.75], F.col("column"))
    rows = [
        (c, *[sums[f"{a}_{i}"] for a in ("n", "missing", "mean", "sd", "low", "high")], *(found.get(c) or [None] * 3))
        for i, c in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(rows, PROFILE_SCHEMA)
