"""Feature preparation: standardising, polynomial columns, missing values and outliers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import normalize_pixels, number
from ..functions.polynomial import exponents, monomial
from ..plans.order_stats import quantiles


@dataclass(frozen=True)
class Scaler:
    """Means and population standard deviations of columns."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    sds: tuple[float, ...]

    def column(self, name: str) -> Column:
        i = self.columns.index(name)
        return (F.col(f"`{name}`").cast("double") - F.lit(self.means[i])) / F.lit(self.sds[i] or 1.0)

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        return df.withColumns({c + suffix: self.column(c) for c in self.columns})


def fit_scaler(df: DataFrame, columns: list[str], only: Column | None = None) -> Scaler:
    """Fit on all rows, or on the rows of a condition such as the training side.

    Missing values take no part.
    """
    rows = df if only is None else df.where(only)
    aggs = [f(number(c)) for c in columns for f in (F.avg, F.stddev_pop)]
    r = rows.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggs)]).first()
    return Scaler(tuple(columns), tuple(r[0::2]), tuple(r[1::2]))


def standardize(df: DataFrame, columns: list[str], suffix: str = "") -> DataFrame:
    """Subtract the mean, divide by the population standard deviation; constants become 0."""
    return fit_scaler(df, columns).transform(df, suffix)


def polynomial_features(
    df: DataFrame, columns: list[str], degree: int, include_bias: bool = True, prefix: str = "poly"
) -> DataFrame:
    """All products of powers up to a total degree, named by their exponents (poly_2_1)."""
    sources = [F.col(f"`{c}`").cast("double") for c in columns]
    terms = [e for e in exponents(len(columns), degree) if include_bias or any(e)]
    return df.withColumns(
        {f"{prefix}_{'_'.join(map(str, e))}": monomial(sources, e) for e in terms}
    )


def scale_pixels(
    df: DataFrame, column: str, mean: float, sd: float, full_scale: float = 1.0
) -> DataFrame:
    return df.withColumn(column, normalize_pixels(F.col(column), mean, sd, full_scale))


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=columns)


def fill_missing(df: DataFrame, columns: list[str], strategy: str = "mean") -> DataFrame:
    """Replace NULL by the mean or the exact median of each column."""
    if strategy == "mean":
        r = df.agg(*[F.avg(f"`{c}`").alias(f"a{i}") for i, c in enumerate(columns)]).first()
        values = dict(zip(columns, r))
    elif strategy == "median":
        names = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns])
        long = df.select(F.inline(names))
        _, found = quantiles(long, F.col("value"), [0.5], F.col("name"))
        values = {c: found[c][0] for c in found}
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return df.withColumns(
        {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(v)) for c, v in values.items() if v is not None}
    )


def iqr_filter(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Keep rows within factor * IQR of the quartiles."""
    _, found = quantiles(df, F.col(f"`{column}`"), [0.25, 0.75])
    if not found:
        return df
    q1, q3 = found[0]
    reach = factor * (q3 - q1)
    return df.where(F.col(f"`{column}`").between(q1 - reach, q3 + reach))
