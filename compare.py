"""Times this package against the plain way of doing the same with stock estimators.

usage: python compare.py [directory]   (one warm-up and one timed run each, local[8])
"""

from __future__ import annotations

import sys
import time

import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from statloom.catalog.clusters import scaled_blobs
from statloom.catalog.data import sample_table
from statloom.catalog.models import _credit
from statloom.catalog.networks import MARKETING
from statloom.operators import kmeans, logistic, network, regression, validation
from statloom.operators.split import k_fold
from statloom.session import local_session
from statloom.sources.tables import load


def timed(run) -> float:
    run()
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def vectors(df, features, label=None):
    keep = [F.col(label).cast("double").alias("label")] if label else []
    rows = VectorAssembler(inputCols=features, outputCol="features").transform(df)
    return rows.select("features", *keep, *[c for c in ("fold",) if c in df.columns])


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    cars = sample_table(spark, d, "cars_quadratic")
    blobs, credit, lineitem = scaled_blobs(spark, d), _credit(spark, d), load(spark, d, "lineitem")

    def refit_folds():
        rows = vectors(k_fold(cars, "id", 10, 42), ["horsepower"], "y").cache()
        for degree in (1, 2, 3):
            wide = PolynomialExpansion(degree=degree, inputCol="features", outputCol="poly").transform(rows)
            for fold in range(10):
                fit = LinearRegression(featuresCol="poly", solver="normal").fit(wide.where(F.col("fold") != fold))
                RegressionEvaluator(metricName="mse").evaluate(fit.transform(wide.where(F.col("fold") == fold)))
        rows.unpersist()

    def kmeans_per_k():
        rows = vectors(blobs, ["x1", "x2"]).cache()
        for k in range(2, 11):
            KMeans(k=k, seed=1).fit(rows).summary.trainingCost  # noqa: B018
        rows.unpersist()

    def marketing(df):
        return df.select((F.col("l_quantity") * 6.0).alias("tv"), (F.col("l_discount") * 500.0).alias("radio"))

    @F.udf("double")
    def per_row(tv, radio):
        z = [tv * a + radio * b + c for a, b, c in zip(*MARKETING["w1"], MARKETING["b1"])]
        return sum(max(0.0, v) * w[0] for v, w in zip(z, MARKETING["w2"])) + MARKETING["b2"][0]

    @F.pandas_udf("double")
    def per_batch(tv: pd.Series, radio: pd.Series) -> pd.Series:
        z = [tv * a + radio * b + c for a, b, c in zip(*MARKETING["w1"], MARKETING["b1"])]
        return sum(v.clip(lower=0.0) * w[0] for v, w in zip(z, MARKETING["w2"])) + MARKETING["b2"][0]

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    pairs = {
        "10-fold error, degrees 1-3 (30 fits)": (
            lambda: validation.k_fold_cv(cars, "id", ["horsepower"], "y", (1, 2, 3)).collect(),
            refit_folds,
        ),
        "10-fold error, degrees 1-10 (100 fits)": (
            lambda: validation.k_fold_cv(cars, "id", ["horsepower"], "y", range(1, 11)).collect(),
            None,
        ),
        "elbow k 2-10, one start": (
            lambda: kmeans.elbow(blobs, "id", ["x1", "x2"], list(range(2, 11)), n_init=1).collect(),
            kmeans_per_k,
        ),
        "elbow k 1-10, ten starts (100 fits)": (
            lambda: kmeans.elbow(blobs, "id", ["x1", "x2"], list(range(1, 11)), n_init=10).collect(),
            None,
        ),
        "plane over lineitem": (
            lambda: regression.fit_linear(lineitem, ["l_quantity", "l_discount"], "l_extendedprice"),
            lambda: LinearRegression(solver="normal").fit(vectors(lineitem, ["l_quantity", "l_discount"], "l_extendedprice")),
        ),
        "logistic regression, two features": (
            lambda: logistic.fit_logistic(credit, ["income", "balance"], "defaulted"),
            lambda: LogisticRegression(regParam=1e-4, standardization=False, maxIter=500, tol=1e-10).fit(
                vectors(credit, ["income", "balance"], "defaulted")
            ),
        ),
        "2-3-1 network over lineitem (row UDF)": (
            lambda: noop(network.dense_layers(marketing(lineitem), ["tv", "radio"], **MARKETING).select("out1")),
            lambda: noop(marketing(lineitem).select(per_row("tv", "radio"))),
        ),
        "2-3-1 network over lineitem (pandas UDF)": (
            lambda: noop(network.dense_layers(marketing(lineitem), ["tv", "radio"], **MARKETING).select("out1")),
            lambda: noop(marketing(lineitem).select(per_batch("tv", "radio"))),
        ),
    }
    for name, (ours, plain) in pairs.items():
        other = f"{timed(plain):7.2f}" if plain else "      -"
        print(f"{name:44} {timed(ours):7.2f} {other}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
