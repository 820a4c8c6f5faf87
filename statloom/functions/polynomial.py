"""Polynomial terms of columns: plain monomials, and Chebyshev terms for stable fitting."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column
from pyspark.sql import functions as F


def exponents(n_features: int, degree: int) -> list[tuple[int, ...]]:
    """Exponent tuples up to a total degree: constant, then by degree, leading feature first."""
    result = []
    for d in range(degree + 1):
        for chosen in combinations_with_replacement(range(n_features), d):
            result.append(tuple(chosen.count(i) for i in range(n_features)))
    return result


def _product(factors: list[Column]) -> Column:
    result = None
    for factor in factors:
        result = factor if result is None else result * factor
    return F.lit(1.0) if result is None else result


def monomial(columns: list[Column], powers: tuple[int, ...]) -> Column:
    """Product of integer powers, by multiplication rather than pow()."""
    return _product([c for c, p in zip(columns, powers) for _ in range(p)])


def scaled_angle(value: Column, lo: float, hi: float) -> Column:
    """Angle whose cosine is the value mapped from [lo, hi] onto [-1, 1]."""
    half = (hi - lo) / 2.0 or 1.0
    z = (value - F.lit((lo + hi) / 2.0)) / F.lit(half)
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), z)))


def chebyshev(angles: list[Column], powers: tuple[int, ...]) -> Column:
    """Product of Chebyshev polynomials T_k(z) = cos(k * angle)."""
    return _product([F.cos(F.lit(float(p)) * a) for a, p in zip(angles, powers) if p])


def chebyshev_anywhere(value: Column, lo: float, hi: float, degree: int) -> Column:
    """T_degree at any point; outside [lo, hi] the cosine becomes a hyperbolic cosine."""
    half = (hi - lo) / 2.0 or 1.0
    z = (value - F.lit((lo + hi) / 2.0)) / F.lit(half)
    k = F.lit(float(degree))
    sign = F.signum(z) if degree % 2 else F.lit(1.0)
    return F.when(F.abs(z) <= 1.0, F.cos(k * scaled_angle(value, lo, hi))).otherwise(
        sign * F.cosh(k * F.acosh(F.abs(z)))
    )
