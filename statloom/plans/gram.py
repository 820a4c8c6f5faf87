"""Least squares from sums: one scan yields every fit that shares a basis.

A least squares fit needs only n, the products of basis columns (G), their products with the
target (c) and the sum of squared targets. These add up, so the sums of the training rows of a
fold are the total minus the fold, and a lower polynomial degree is a leading block of G.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations_with_replacement, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import number
from ..functions.polynomial import exponents, scaled_angle
from .vectors import collect_vectors, list_column, matrix

SQL_COLUMNS = 12  # up to here the products are sums inside generated code


@dataclass
class Gram:
    """Sums of products of a basis with itself and with the (centred) target."""

    n: float
    g: np.ndarray
    c: np.ndarray
    yy: float

    def __add__(self, other: Gram) -> Gram:
        return Gram(self.n + other.n, self.g + other.g, self.c + other.c, self.yy + other.yy)

    def __sub__(self, other: Gram) -> Gram:
        return Gram(self.n - other.n, self.g - other.g, self.c - other.c, self.yy - other.yy)

    def leading(self, size: int) -> Gram:
        return Gram(self.n, self.g[:size, :size], self.c[:size], self.yy)

    def solve(self) -> np.ndarray:
        """Least squares coefficients; the minimum norm ones where columns are dependent."""
        scale = np.sqrt(np.diag(self.g))
        scale[scale == 0] = 1.0
        scaled = self.g / np.outer(scale, scale)
        return np.linalg.lstsq(scaled, self.c / scale, rcond=1e-13)[0] / scale

    def inverse(self) -> np.ndarray:
        return np.linalg.pinv(self.g, rcond=1e-13, hermitian=True)

    def mse(self, beta: np.ndarray) -> float | None:
        """Mean squared error of a coefficient vector on the rows behind these sums."""
        if self.n == 0:
            return None
        return max(0.0, float(self.yy - 2 * beta @ self.c + beta @ self.g @ beta)) / self.n


def column_gram(df: DataFrame, basis: list[Column], target: Column, keys: list[str] = ()) -> dict:
    """Gram sums per key for a list of basis columns: {key tuple: Gram}.

    Rows with a missing value take no part.
    """
    keys = list(keys)
    width = len(basis)
    if width <= SQL_COLUMNS:
        return _sql_gram(df, basis, target, keys)
    if len(keys) > 1:
        raise ValueError("a wide basis takes one key column; combine the keys into one")
    key = F.col(keys[0]) if keys else F.lit(0)
    # a leading constant makes the first entry of the product the row count
    values = F.array(F.lit(1.0), *[b.cast("double") for b in basis], target.cast("double"))
    complete = F.forall("row", lambda v: v.isNotNull() & ~F.isnan(v))
    rows = df.select(key.alias("key"), values.alias("row")).where(complete)
    key_type = rows.schema["key"].dataType.simpleString()
    partial = rows.mapInArrow(_partial_gram(), f"key {key_type}, sums array<double>")
    result = {}
    for k, sums in collect_vectors(partial, ["key"], "sums", (width + 2) ** 2).items():
        full = sums.reshape(width + 2, width + 2)
        inner = slice(1, width + 1)
        result[k if keys else ()] = Gram(full[0, 0], full[inner, inner], full[inner, -1], full[-1, -1])
    return result


def _sql_gram(df: DataFrame, basis: list[Column], target: Column, keys: list[str]) -> dict:
    width = len(basis)
    named = df.select(*keys, *[b.alias(f"b{i}") for i, b in enumerate(basis)], target.alias("y"))
    named = named.na.drop(subset=[c for c in named.columns if c not in keys])
    pairs = list(combinations_with_replacement(range(width), 2))
    sums = [F.expr(f"sum(b{i} * b{j}) as g_{i}_{j}") for i, j in pairs]
    sums += [F.expr(f"sum(b{i} * y) as c_{i}") for i in range(width)]
    rows = named.groupBy(*keys).agg(F.expr("count(*) as n"), F.expr("sum(y * y) as yy"), *sums)
    result = {}
    for r in rows.collect():
        g = np.zeros((width, width))
        for i, j in pairs:
            g[i, j] = g[j, i] = r[f"g_{i}_{j}"] or 0.0
        c = np.array([r[f"c_{i}"] or 0.0 for i in range(width)])
        result[tuple(r[k] for k in keys)] = Gram(r["n"], g, c, r["yy"] or 0.0)
    return result


def _partial_gram():
    """Task that adds up row products per key over its Arrow batches."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        key_type = None
        for batch in batches:
            rows = matrix(batch.column("row"))
            coded = batch.column("key").dictionary_encode()
            key_type = coded.dictionary.type
            code = coded.indices.to_numpy(zero_copy_only=False)
            for i, label in enumerate(coded.dictionary.to_pylist()):
                part = rows[code == i]
                sums[label] = sums.get(label, 0.0) + part.T @ part
        if sums:
            values = list_column(np.array([s.reshape(-1) for s in sums.values()]))
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), key_type), values], names=["key", "sums"])

    return task


@dataclass(frozen=True)
class Basis:
    """Chebyshev terms of features scaled from [lo, hi] to [-1, 1], up to a total degree."""

    features: tuple[str, ...]
    lo: tuple[float, ...]
    hi: tuple[float, ...]
    degree: int

    @property
    def terms(self) -> list[tuple[int, ...]]:
        return exponents(len(self.features), self.degree)

    def size(self, degree: int) -> int:
        return len(exponents(len(self.features), degree))

    def angles(self) -> list[Column]:
        return [
            F.when(number(f).isNotNull(), scaled_angle(number(f), a, b))
            for f, a, b in zip(self.features, self.lo, self.hi)
        ]


def value_ranges(df: DataFrame, columns: list[str]) -> dict:
    """Minimum, maximum and mean of columns, in one scan."""
    aggs = [f(number(c)) for c in columns for f in (F.min, F.max, F.avg)]
    flat = df.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggs)]).first()
    return {c: tuple(flat[3 * i : 3 * i + 3]) for i, c in enumerate(columns)}


def polynomial_gram(
    df: DataFrame, basis: Basis, target: Column, keys: list[str] = ()
) -> dict:
    """Gram sums of a Chebyshev basis per key, from a number of sums linear in its size.

    cos(a)cos(b) = (cos(a+b) + cos(a-b)) / 2, so every product of two basis terms is a mean of
    terms up to twice the degree. One sum per such term replaces one sum per pair of terms.
    Rows with a missing value take no part.
    """
    keys = list(keys)
    p = len(basis.features)
    terms, moments = basis.terms, exponents(p, 2 * basis.degree)
    angle_names = [f"angle{i}" for i in range(p)]
    prepared = df.select(
        *keys, *[a.alias(n) for a, n in zip(basis.angles(), angle_names)], target.cast("double").alias("y")
    )

    def term(powers: tuple[int, ...]) -> str:
        return " * ".join(f"cos({k}D * {a})" for k, a in zip(powers, angle_names) if k) or "1.0D"

    aggs = [F.expr("count(*) as n"), F.expr("sum(y * y) as yy")]
    aggs += [F.expr(f"sum({term(m)}) as m{i}") for i, m in enumerate(moments) if any(m)]
    aggs += [F.expr(f"sum(y * {term(t)}) as c{i}") for i, t in enumerate(terms)]
    index = {m: i for i, m in enumerate(moments)}
    signs = list(product((1, -1), repeat=p))
    mean_of = [
        [[index[tuple(abs(a + s * b) for a, b, s in zip(u, v, sign))] for sign in signs] for v in terms]
        for u in terms
    ]
    pick = np.array(mean_of)
    result = {}
    for r in prepared.na.drop(subset=[*angle_names, "y"]).groupBy(*keys).agg(*aggs).collect():
        m = np.array([r["n"] if not any(t) else r[f"m{i}"] for i, t in enumerate(moments)], dtype=float)
        c = np.array([r[f"c{i}"] for i in range(len(terms))], dtype=float)
        result[tuple(r[k] for k in keys)] = Gram(r["n"], m[pick].mean(axis=2), c, r["yy"])
    return result
