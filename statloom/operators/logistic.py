"""Penalised logistic regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.gram import SQL_COLUMNS
from ..plans.vectors import collect_vectors, list_column, matrix
from .prepare import fit_scaler
from .regression import LinearModel

MAX_STEPS = 50


@dataclass
class _Fit:
    """State of one Newton iteration: a penalty strength and the fold kept out of the fit."""

    c: float
    left_out: int | None
    beta: np.ndarray
    step: np.ndarray | None = None
    loss: float = np.inf
    done: bool = False


def fit_logistic(df: DataFrame, features: list[str], label: str, c: float = 1.0, tol: float = 1e-7) -> LinearModel:
    """Maximise likelihood minus |w|^2 / (2 C); the intercept is not penalised, and an infinite C penalises nothing.

    Newton steps from zero over all rows, each one aggregate of p*p sums, until they vanish. A step that raises the penalised loss is
    halved. A fit that still moves after MAX_STEPS, as one of separable classes without a penalty does, has `converged` False.
    """
    return fit_logistic_many(df, features, label, [(c, None)], tol=tol)[0]


def fit_logistic_many(
    df: DataFrame, features: list[str], label: str, settings: list[tuple], fold: str | None = None, tol: float = 1e-7
) -> list[LinearModel]:
    """One model per (C, left-out fold); every scan advances all of them."""
    scaler = fit_scaler(df, features)
    sd = np.array([s or 1.0 for s in scaler.sds])
    scaled = df.select(
        F.lit(1.0).alias("z0"),
        *[scaler.column(f).alias(f"z{i + 1}") for i, f in enumerate(features)],
        F.col(label).cast("double").alias("y"),
        (F.col(fold) if fold else F.lit(None).cast("int")).alias("fold"),
    )
    scaled = scaled.na.drop(subset=[c for c in scaled.columns if c != "fold"])
    fits = [_Fit(c, left_out, np.zeros(len(features) + 1)) for c, left_out in settings]
    # the penalty is stated on raw coefficients: w_raw = w_scaled / sd
    penalties = [np.concatenate([[0.0], 1.0 / (f.c * sd**2)]) for f in fits]
    scaled = scaled.persist(StorageLevel.MEMORY_AND_DISK)  # a few doubles per row, read in every step
    try:
        for _ in range(MAX_STEPS):
            active = [(f, p) for f, p in zip(fits, penalties) if not f.done]
            if not active:
                break
            for (f, penalty), sums in zip(active, _newton_sums(scaled, [f for f, _ in active])):
                _advance(f, *sums, penalty, tol)
    finally:
        scaled.unpersist()
    models = []
    for f in fits:
        raw = f.beta[1:] / sd
        intercept = float(f.beta[0] - raw @ np.array(scaler.means))
        models.append(LinearModel(tuple(features), intercept, tuple(map(float, raw)), "logit", f.done))
    return models


def _advance(fit: _Fit, loss: float, gradient: np.ndarray, hessian: np.ndarray, penalty: np.ndarray, tol: float):
    loss += 0.5 * float(penalty @ fit.beta**2)
    if fit.step is not None and loss > fit.loss + 1e-9 * abs(fit.loss):
        fit.step = fit.step / 2  # overshoot: go half the way back
        fit.beta = fit.beta - fit.step
        return
    fit.loss = loss
    fit.step = np.linalg.lstsq(hessian + np.diag(penalty), gradient - penalty * fit.beta, rcond=1e-14)[0]
    fit.beta = fit.beta + fit.step
    fit.done = bool(np.max(np.abs(fit.step)) < tol)  # the error left is of the order of its square


def _newton_sums(scaled: DataFrame, fits: list[_Fit]) -> list[tuple]:
    """Loss, gradient and curvature of every fit from one aggregate: sums in generated code, or of blocks of rows for a wide model."""
    width = len(fits[0].beta)
    if width > SQL_COLUMNS:
        return _block_sums(scaled, fits)
    states = [
        F.struct(
            F.lit(i).alias("fit"),
            F.lit(f.left_out).cast("int").alias("left_out"),
            *[F.lit(float(v)).alias(f"b{j}") for j, v in enumerate(f.beta)],
        )
        for i, f in enumerate(fits)
    ]
    rows = scaled.select("*", F.inline(F.array(*states)))
    if any(f.left_out is not None for f in fits):
        rows = rows.where("left_out is null or fold <> left_out")
    rows = rows.selectExpr("*", " + ".join(f"b{i} * z{i}" for i in range(width)) + " as m")
    rows = rows.selectExpr("*", "1 / (1 + exp(-m)) as p")
    pairs = list(combinations_with_replacement(range(width), 2))
    sums = rows.groupBy("fit").agg(
        # log(1 + exp(m)) without overflow for large m
        F.expr("sum(greatest(m, 0.0D) + log1p(exp(-abs(m))) - y * m) as loss"),
        *[F.expr(f"sum((y - p) * z{i}) as g{i}") for i in range(width)],
        *[F.expr(f"sum(p * (1 - p) * z{i} * z{j}) as h{i}_{j}") for i, j in pairs],
    )
    by_fit = {r["fit"]: r for r in sums.collect()}
    result = []
    for i in range(len(fits)):
        r = by_fit[i]
        hessian = np.zeros((width, width))
        for j, k in pairs:
            hessian[j, k] = hessian[k, j] = r[f"h{j}_{k}"]
        result.append((r["loss"], np.array([r[f"g{j}"] for j in range(width)]), hessian))
    return result


def _block_sums(scaled: DataFrame, fits: list[_Fit]) -> list[tuple]:
    """The same sums by products of blocks of rows; a task returns one array of p*p numbers for each fit."""
    width = len(fits[0].beta)
    settings = [(f.left_out, f.beta) for f in fits]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(settings), 1 + width + width * width))
        for batch in batches:
            z, y = matrix(batch.column("z")), batch.column("y").to_numpy(zero_copy_only=False)
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            for total, (left_out, beta) in zip(totals, settings):
                kept = slice(None) if left_out is None else fold != left_out
                x, target = z[kept], y[kept]
                m = x @ beta
                p = 1.0 / (1.0 + np.exp(-np.clip(m, -700, 700)))
                total[0] += float((np.maximum(m, 0.0) + np.log1p(np.exp(-np.abs(m))) - target * m).sum())
                total[1 : width + 1] += x.T @ (target - p)
                total[width + 1 :] += (x.T @ (x * (p * (1 - p))[:, None])).reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(settings)), pa.int32()), list_column(totals)], names=["fit", "sums"])

    rows = scaled.select(F.array(*[f"z{i}" for i in range(width)]).alias("z"), "y", "fold")
    found = collect_vectors(rows.mapInArrow(task, "fit int, sums array<double>"), ["fit"], "sums", 1 + width + width * width)
    return [(s[0], s[1 : width + 1], s[width + 1 :].reshape(width, width)) for s in (found[(i,)] for i in range(len(fits)))]


def odds_ratios(spark: SparkSession, model: LinearModel) -> DataFrame:
    """Factor by which the odds change when a feature grows by one."""
    return model.table(spark).where("term <> '(intercept)'").select(
        "term", "coefficient", F.exp("coefficient").alias("odds_ratio")
    )
