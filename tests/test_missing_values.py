"""Missing values in metrics, scoring and model selection."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from statloom.functions.numeric import argmax, relu, threshold
from statloom.operators import explore, layers, metrics, reshape, training, validation


def test_metrics_count_whole_pairs_only(spark):
    rows = [(1.0, 1.0), (2.0, 1.0), (None, 1.0), (4.0, None), (float("nan"), 2.0)]
    row = metrics.regression_metrics(spark.createDataFrame(rows, "y double, f double"), "y", "f", 0).first()
    assert (row["n"], row["mse"], row["rss"], row["r2"]) == (2, 0.5, 1.0, -1.0)
    assert math.isclose(row["rse"], 1.0)


def test_metrics_without_a_whole_pair(spark):
    row = metrics.regression_metrics(spark.createDataFrame([(None, 1.0)], "y double, f double"), "y", "f", 1).first()
    assert (row["n"], row["mse"], row["r2"], row["rse"]) == (0, None, None, None)


def test_relu_and_threshold_keep_missing(spark):
    df = spark.createDataFrame([(-1.0,), (2.0,), (None,), (float("nan"),)], "v double")
    rows = df.select(relu(F.col("v")).alias("r"), threshold(F.col("v")).alias("t")).collect()
    assert [r["t"] for r in rows] == [0, 1, None, None]
    assert [r["r"] for r in rows[:3]] == [0.0, 2.0, None]


def test_best_row_needs_a_metric(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (3, float("nan")), (4, 3.0)], "degree int, mse double")
    assert tuple(reshape.best_row(df, "degree", "mse").first()) == (2, 3.0)


def test_box_plot_keeps_the_missing_category(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, 7.0)], "c string, v double")
    rows = {r["category"]: (r["median"], r["n"]) for r in explore.box_plot(df, "c", "v").collect()}
    assert rows == {"a": (2.0, 2), None: (6.0, 2)}


def test_holdout_with_one_row(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id long, x double, y double")
    assert validation.holdout(df, "id", ["x"], "y").first()["mse"] is None


def test_a_missing_vector_keeps_its_row():
    import numpy as np
    import pyarrow as pa
    import pytest

    from statloom.plans.vectors import matrix

    rows = matrix(pa.array([[1.0, 2.0], None, [3.0, 4.0]]))
    assert np.isnan(rows[1]).all() and rows[[0, 2]].tolist() == [[1.0, 2.0], [3.0, 4.0]]
    with pytest.raises(ValueError):
        matrix(pa.array([[1.0, 2.0], [3.0]]))


def test_no_class_and_no_scores_for_missing_input(spark):
    rows = [(0, [0.5, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    assert [r["c"] for r in df.orderBy("id").select(argmax(F.col("v")).alias("c")).collect()] == [1, None, None, None, None]
    net = training.Network((("dense", 2, 3),), [np.ones((2, 3)), np.array([0.0, 2.0, 1.0])])
    scored = training.predict_class(net, df.where("id < 4"), "v").orderBy("id").collect()
    assert [r["prediction"] for r in scored] == [1, None, None, None]
    assert scored[0]["scores"] == [2.5, 4.5, 3.5] and all(r["scores"] is None for r in scored[1:])


def test_missing_targets_take_no_part_in_training(spark):
    clean = spark.range(40).select("id", (F.col("id") / 40.0).alias("x"), (F.col("id") / 20.0).alias("y"))
    gaps = spark.createDataFrame([(100, 0.5, None), (101, None, 0.5), (102, 0.5, float("nan"))], "id long, x double, y double")
    fits = [training.train(df, "id", ["x"], "y", layers.curve_fitter(3), loss="squared", optimizer="sgd", rate=0.01, epochs=2, batch_size=8) for df in (clean, clean.unionByName(gaps))]
    assert all(np.allclose(a, b) and np.isfinite(a).all() for a, b in zip(fits[0].params, fits[1].params))
