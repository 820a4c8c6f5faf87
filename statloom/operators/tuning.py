"""Choosing a hyper-parameter by cross-validated score."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .logistic import fit_logistic_many
from .split import k_fold


def tune_logistic(
    df: DataFrame, id_col: str, features: list[str], label: str, cs: list[float], k: int = 5, seed=42
) -> DataFrame:
    """Mean accuracy over k folds per penalty strength.

    All (strength, fold) fits share their scans, and one more scan scores them.
    """
    rows = k_fold(df.select(id_col, *features, label), id_col, k, seed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        settings = [(float(c), fold) for c in cs for fold in range(k)]
        models = fit_logistic_many(rows, features, label, settings, "fold")
        hits = []
        for i in range(len(cs)):
            hit = F.lit(None).cast("int")
            for fold in range(k):
                said = (models[i * k + fold].linear() >= 0).cast("int")
                hit = F.when(F.col("fold") == fold, (said == F.col(label)).cast("int")).otherwise(hit)
            hits.append(F.avg(hit).alias(f"a{i}"))
        per_fold = rows.groupBy("fold").agg(*hits)
        means = per_fold.agg(*[F.avg(f"a{i}").alias(f"a{i}") for i in range(len(cs))]).first()
        table = [(float(c), k, means[f"a{i}"]) for i, c in enumerate(cs)]
        return df.sparkSession.createDataFrame(table, "c double, folds int, accuracy double")
    finally:
        rows.unpersist()
