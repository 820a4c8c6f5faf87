from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.operators import kmeans, prepare, regression, reshape
from statloom.session import materialise, new_shared_path
from statloom.sources import generate, grid, tables
from statloom.streaming.score import read_stream, score_stream


def test_stream_scores_equal_batch_scores(spark):
    data = generate.sample_data(spark.range(500), "id", "tv_radio_sales")
    model = regression.fit_linear(data, ["tv", "radio"], "y")
    scaler = prepare.fit_scaler(data, ["tv", "radio"])
    centers = np.array([[-1.0, 0.0], [1.0, 0.0]])

    def score(df):
        scored = scaler.transform(model.predict(df), "_z")
        return kmeans.assign(scored, ["tv_z", "radio_z"], centers)

    source, target, state = (new_shared_path(spark, n) for n in ("in", "out", "state"))
    data.repartition(4).write.parquet(source)
    for _ in range(2):  # a second run finds nothing new
        score_stream(read_stream(spark, source, data.schema), score, target, state).awaitTermination()
    got = spark.read.parquet(target).orderBy("id").collect()
    assert got == score(data).orderBy("id").collect()


def test_csv_round_trip_with_declared_schema(spark):
    path = new_shared_path(spark, "csv")
    rows = generate.sample_data(spark.range(30), "id", "cars_linear")
    rows.write.option("header", True).csv(path)
    back = tables.load_csv(spark, path, "id bigint, horsepower double, y double")
    assert back.orderBy("id").collect() == rows.orderBy("id").collect()
    with pytest.raises(Exception):
        tables.load_csv(spark, path, "id bigint, horsepower int, y double").collect()


def test_grids(spark):
    line = [r["x"] for r in grid.linspace(spark, 8.0, 21.0, 100).orderBy("id").collect()]
    assert np.allclose(line, np.linspace(8, 21, 100)) and line[-1] == 21.0
    assert [r["x"] for r in grid.linspace(spark, 3.0, 9.0, 1).collect()] == [3.0]
    cells = grid.mesh(spark, {"a": (0.0, 300.0, 30), "b": (0.0, 50.0, 30)}).orderBy("id").collect()
    a, b = np.meshgrid(np.linspace(0, 300, 30), np.linspace(0, 50, 30))
    assert np.allclose([r["a"] for r in cells], a.ravel()) and np.allclose([r["b"] for r in cells], b.ravel())


def test_code_without_label_is_null(spark):
    df = spark.createDataFrame([(0,), (1,), (7,)], "code int")
    got = reshape.map_codes(df, "code", generate.CREDIT_LABELS, "label").orderBy("code").collect()
    assert [r["label"] for r in got] == ["0: No Default", "1: Default", None]


def test_best_row_takes_the_first_of_ties(spark):
    df = spark.createDataFrame([(3, 0.5), (2, 0.5), (9, 0.7)], "degree int, mse double")
    assert tuple(reshape.best_row(df, "degree", "mse").first()) == (2, 0.5)


def test_materialised_rows_are_read_back(spark):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    assert sorted(materialise(df, "copy").collect()) == sorted(df.collect())


def test_class_shares_and_group_sizes(spark):
    credit = generate.credit_data(spark.range(8000), "id")
    assert abs(credit.agg(F.avg("defaulted")).first()[0] - 0.25) < 0.02
    means = {r["defaulted"]: r["b"] for r in credit.groupBy("defaulted").agg(F.avg("balance").alias("b")).collect()}
    assert abs(means[0] - 800) < 25 and abs(means[1] - 1800) < 40
    sizes = generate.blobs(spark.range(300), "id", [(0.0,), (5.0,), (9.0,)]).groupBy("true_cluster").count().collect()
    assert {r["count"] for r in sizes} == {100}
