"""Small networks unrolled into column expressions, with their gradient as an aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import affine, relu, total


def dense_layers(
    df: DataFrame, inputs: list[str], w1: list[list[float]], b1: list[float], w2: list[list[float]], b2: list[float]
) -> DataFrame:
    """Two dense layers with ReLU between; adds z (before), h (after ReLU) and out columns.

    Each layer is a projection of its own, so a hidden unit is computed once and not once per
    output that uses it.
    """
    x = [F.col(f"`{c}`").cast("double") for c in inputs]
    hidden = range(len(b1))
    rows = df.withColumns({f"z{j + 1}": affine(x, [row[j] for row in w1], b1[j]) for j in hidden})
    rows = rows.withColumns({f"h{j + 1}": relu(F.col(f"z{j + 1}")) for j in hidden})
    h = [F.col(f"h{j + 1}") for j in hidden]
    return rows.withColumns({f"out{k + 1}": affine(h, [row[k] for row in w2], b2[k]) for k in range(len(b2))})


def squared_loss_gradient(
    df: DataFrame, x: str, y: str, w1: list[float], b1: float, w2: list[float], b2: float
) -> DataFrame:
    """Mean squared loss of a 1-h-1 network with one shared hidden bias, and its gradient.

    The chain rule written as averages: one row with loss, w1_j, b1, w2_j and b2 derivatives.
    """
    hidden = range(len(w1))
    rows = dense_layers(df.select(x, y), [x], [w1], [b1] * len(w1), [[w] for w in w2], [b2])
    gap = 2.0 * (F.col("out1") - F.col(y))

    def through(j: int) -> Column:
        return F.when(F.col(f"z{j + 1}") > 0, gap * w2[j]).otherwise(F.lit(0.0))

    return rows.agg(
        F.avg((F.col("out1") - F.col(y)) * (F.col("out1") - F.col(y))).alias("loss"),
        *[F.avg(through(j) * F.col(x)).alias(f"w1_{j + 1}") for j in hidden],
        F.avg(total([through(j) for j in hidden])).alias("b1"),
        *[F.avg(gap * F.col(f"h{j + 1}")).alias(f"w2_{j + 1}") for j in hidden],
        F.avg(gap).alias("b2"),
    )
