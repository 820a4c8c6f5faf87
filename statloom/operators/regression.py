"""Least squares lines, planes and polynomial curves; regression trees."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import affine, sigmoid, total
from ..functions.polynomial import chebyshev_anywhere
from ..plans.gram import Basis, column_gram, polynomial_gram, value_ranges

INTERCEPT = "(intercept)"
MODEL_SCHEMA = "term string, coefficient double"


@dataclass(frozen=True)
class LinearModel:
    """Intercept and one coefficient per feature; `link` is identity or logit. `converged` is False for a fit that did not settle."""

    features: tuple[str, ...]
    intercept: float
    coefficients: tuple[float, ...]
    link: str = "identity"
    converged: bool = True

    def linear(self) -> Column:
        inputs = [F.col(f"`{f}`").cast("double") for f in self.features]
        return affine(inputs, list(self.coefficients), self.intercept)

    def column(self) -> Column:
        return sigmoid(self.linear()) if self.link == "logit" else self.linear()

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        return df.withColumn(name, self.column())

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(INTERCEPT, float(self.intercept))]
        rows += [(f, float(c)) for f, c in zip(self.features, self.coefficients)]
        return spark.createDataFrame(rows, MODEL_SCHEMA)


@dataclass(frozen=True)
class PolynomialModel:
    """Polynomial in Chebyshev terms of scaled features."""

    basis: Basis
    coefficients: tuple[float, ...]

    def column(self) -> Column:
        features = [F.col(f"`{f}`").cast("double") for f in self.basis.features]
        parts = []
        for beta, powers in zip(self.coefficients, self.basis.terms):
            term = F.lit(float(beta))
            for x, lo, hi, k in zip(features, self.basis.lo, self.basis.hi, powers):
                if k:
                    term = term * chebyshev_anywhere(x, lo, hi, k)
            parts.append(term)
        return total(parts)

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        return df.withColumn(name, self.column())


def simple_regression(df: DataFrame, x: str, y: str, group: list[str] = ()) -> DataFrame:
    """Slope and intercept by one aggregate, for the whole table or per group."""
    a, b = F.col(f"`{y}`").cast("double"), F.col(f"`{x}`").cast("double")
    return df.groupBy(*group).agg(
        F.regr_slope(a, b).alias("slope"),
        F.regr_intercept(a, b).alias("intercept"),
        F.regr_count(a, b).alias("n"),
    )


def fit_linear(df: DataFrame, features: list[str], y: str) -> LinearModel:
    """Multiple least squares from centred cross products."""
    ranges = value_ranges(df, [*features, y])
    basis = [F.lit(1.0)] + [F.col(f"`{f}`").cast("double") - F.lit(ranges[f][2]) for f in features]
    gram = column_gram(df, basis, centred(y, ranges[y][2]))[()]
    beta = gram.solve()
    shift = sum(b * ranges[f][2] for b, f in zip(beta[1:], features))
    return LinearModel(tuple(features), float(beta[0] + ranges[y][2] - shift), tuple(map(float, beta[1:])))


def chebyshev_basis(df: DataFrame, features: list[str], y: str, degree: int) -> tuple[Basis, float]:
    """Basis scaled to the data, and the mean of the target.

    The scaling spans all rows: it changes the numbers the basis is made of, not the set of
    curves it can express, so folds and splits may share it.
    """
    ranges = value_ranges(df, [*features, y])
    basis = Basis(
        tuple(features),
        tuple(ranges[f][0] for f in features),
        tuple(ranges[f][1] for f in features),
        degree,
    )
    return basis, ranges[y][2]


def centred(y: str, mean: float) -> Column:
    return F.col(f"`{y}`").cast("double") - F.lit(mean)


def fit_polynomial(df: DataFrame, features: list[str], y: str, degree: int) -> PolynomialModel:
    """Least squares polynomial with all terms up to a total degree."""
    basis, mean = chebyshev_basis(df, features, y, degree)
    beta = polynomial_gram(df, basis, centred(y, mean))[()].solve()
    beta = np.concatenate([[beta[0] + mean], beta[1:]])
    return PolynomialModel(basis, tuple(map(float, beta)))


def fixed_line(slope: float, intercept: float, feature: str) -> LinearModel:
    """A hypothesis that is stated, not fitted."""
    return LinearModel((feature,), float(intercept), (float(slope),))


def compare_curves(grid: DataFrame, models: dict, keep: list[str]) -> DataFrame:
    """One row per (model, grid point). `models` maps a name to a model or a transformer."""
    parts = []
    for name, model in models.items():
        scored = model.predict(grid) if hasattr(model, "predict") else model.transform(grid)
        parts.append(scored.select(F.lit(name).alias("model"), *keep, F.col("prediction").cast("double")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


__all__ = [
    "LinearModel", "PolynomialModel", "simple_regression", "fit_linear", "fit_polynomial",
    "chebyshev_basis", "centred", "fixed_line", "compare_curves",
]
