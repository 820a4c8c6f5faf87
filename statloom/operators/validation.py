"""Hold-out, k-fold, leave-one-out and degree sweeps from one aggregation each.

Refitting is never needed: the sums of a training side are the total minus its test side, and
each lower degree is a leading block (see `plans.gram`).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import total
from ..functions.polynomial import chebyshev
from ..plans.gram import Basis, Gram, polynomial_gram
from .regression import centred, chebyshev_basis
from .split import k_fold, split_columns, train_test_split

CURVE_SCHEMA = "degree int, train_mse double, test_mse double"
SPLIT_SCHEMA = "seed int, degree int, n bigint, mse double"
FOLD_SCHEMA = "degree int, fold int, n bigint, mse double"


def _train_test_gram(df, id_col, features, y, fraction, seed, degree) -> tuple[Basis, Gram | None, Gram | None]:
    split = train_test_split(df, id_col, fraction, seed)
    basis, mean = chebyshev_basis(df, features, y, degree)
    grams = polynomial_gram(split, basis, centred(y, mean), ["is_test"])
    return basis, grams.get((False,)), grams.get((True,))


def learning_curve(
    df: DataFrame, id_col: str, features: list[str], y: str, degrees: Iterable[int], fraction=0.5, seed=42
) -> DataFrame:
    """Training and test error per polynomial degree on one split."""
    degrees = list(degrees)
    basis, train, test = _train_test_gram(df, id_col, features, y, fraction, seed, max(degrees))
    rows = []
    if train is None or test is None:
        return df.sparkSession.createDataFrame([(d, None, None) for d in degrees], CURVE_SCHEMA)
    for d in degrees:
        size = basis.size(d)
        beta = train.leading(size).solve()
        rows.append((d, train.leading(size).mse(beta), test.leading(size).mse(beta)))
    return df.sparkSession.createDataFrame(rows, CURVE_SCHEMA)


def holdout(df: DataFrame, id_col: str, features: list[str], y: str, degree=1, fraction=0.5, seed=42) -> DataFrame:
    """Test error of a fit on the other part of the rows; NULL if either part is empty."""
    basis, train, test = _train_test_gram(df, id_col, features, y, fraction, seed, degree)
    if train is None or test is None:
        return df.sparkSession.createDataFrame([(int(test.n) if test else 0, None)], "n bigint, mse double")
    mse = test.mse(train.solve())
    return df.sparkSession.createDataFrame([(int(test.n), mse)], "n bigint, mse double")


def repeated_holdout(
    df: DataFrame, id_col: str, features: list[str], y: str, seeds: list[int], degrees: Iterable[int], fraction=0.5
) -> DataFrame:
    """Test error per (seed, degree).

    Rows are summed per pattern of test sides (one bit per seed), so every seed's sums are sums
    over patterns: one pass over the data, without a copy of it per seed.
    """
    degrees = list(degrees)
    basis, mean = chebyshev_basis(df, features, y, max(degrees))
    rows = []
    for start in range(0, len(seeds), 10):  # at most 1024 patterns per pass
        some = seeds[start : start + 10]
        split = split_columns(df, id_col, fraction, some)
        pattern = total([F.col(f"test_{s}").cast("int") * F.lit(1 << i) for i, s in enumerate(some)])
        grams = polynomial_gram(split.withColumn("pattern", pattern), basis, centred(y, mean), ["pattern"])
        for i, s in enumerate(some):
            test = _add([g for (p,), g in grams.items() if p >> i & 1])
            train = _add([g for (p,), g in grams.items() if not p >> i & 1])
            for d in degrees:
                if train is None or test is None:
                    rows.append((s, d, int(test.n) if test else 0, None))
                    continue
                size = basis.size(d)
                beta = train.leading(size).solve()
                rows.append((s, d, int(test.n), test.leading(size).mse(beta)))
    return df.sparkSession.createDataFrame(rows, SPLIT_SCHEMA)


def _add(grams: list[Gram]) -> Gram | None:
    if not grams:
        return None
    result = grams[0]
    for g in grams[1:]:
        result = result + g
    return result


def fold_errors(
    df: DataFrame, id_col: str, features: list[str], y: str, degrees: Iterable[int], k=10, seed=42
) -> DataFrame:
    """Test error per (degree, fold)."""
    degrees = list(degrees)
    basis, mean = chebyshev_basis(df, features, y, max(degrees))
    folds = polynomial_gram(k_fold(df, id_col, k, seed), basis, centred(y, mean), ["fold"])
    whole = _add(list(folds.values()))
    rows = []
    for (fold,), test in sorted(folds.items()):
        train = whole - test
        for d in degrees:
            size = basis.size(d)
            beta = train.leading(size).solve()
            rows.append((d, fold, int(test.n), test.leading(size).mse(beta)))
    return df.sparkSession.createDataFrame(rows, FOLD_SCHEMA)


def k_fold_cv(df: DataFrame, id_col: str, features: list[str], y: str, degrees=(1,), k=10, seed=42) -> DataFrame:
    """Unweighted mean of the fold errors per degree."""
    errors = fold_errors(df, id_col, features, y, degrees, k, seed)
    return errors.groupBy("degree").agg(F.count(F.lit(1)).alias("folds"), F.avg("mse").alias("mse"))


def loo_cv(df: DataFrame, features: list[str], y: str, degree: int = 1) -> DataFrame:
    """Leave-one-out error from one fit and the leverage of every row.

    The error of a row left out is its residual divided by one minus its leverage.
    """
    basis, mean = chebyshev_basis(df, features, y, degree)
    gram = polynomial_gram(df, basis, centred(y, mean))[()]
    beta, inverse = gram.solve(), gram.inverse()
    terms = [f"t{i}" for i in range(len(basis.terms))]
    angles = [f"angle{i}" for i in range(len(features))]
    prepared = df.select(*[a.alias(n) for a, n in zip(basis.angles(), angles)], centred(y, mean).alias("y"))
    prepared = prepared.select(
        "y", *[chebyshev([F.col(a) for a in angles], p).alias(t) for t, p in zip(terms, basis.terms)]
    )
    fitted = total([F.lit(float(b)) * F.col(t) for b, t in zip(beta, terms)])
    leverage = total(
        [
            F.lit(float(inverse[i, j] * (1 if i == j else 2))) * F.col(terms[i]) * F.col(terms[j])
            for i in range(len(terms))
            for j in range(i, len(terms))
        ]
    )
    rest: Column = 1 - F.col("h")
    left_out = F.when(rest > 1e-12, F.pow((F.col("y") - F.col("f")) / rest, 2.0))
    scored = prepared.na.drop().select("y", fitted.alias("f"), leverage.alias("h"))
    return scored.agg(F.count(F.lit(1)).alias("fits"), F.avg(left_out).alias("mse"))


def tune_degree(df: DataFrame, id_col: str, features: list[str], y: str, degrees, k=10, seed=42) -> DataFrame:
    """Degree with the smallest cross-validated error; ties go to the lower degree."""
    scores = k_fold_cv(df, id_col, features, y, degrees, k, seed).where("mse IS NOT NULL AND NOT isnan(mse)")
    return scores.agg(
        F.min_by("degree", F.struct("mse", "degree")).alias("degree"), F.min("mse").alias("mse")
    )
