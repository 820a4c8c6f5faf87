from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.catalog import QUERIES
from statloom.catalog.networks import CALORIES, MARKETING
from statloom.functions.hashing import hash52
from statloom.operators import layers, network, prepare, training
from statloom.sources import generate
from statloom.sources.tables import load


def test_golden_forward_passes(spark):
    r = network.dense_layers(spark.createDataFrame([(200.0, 40.0)], "tv double, radio double"), ["tv", "radio"], **MARKETING).first()
    assert [r["z1"], r["z2"], r["z3"], r["out1"]] == pytest.approx([11.0, 6.0, 2.0, 28.0])
    r = network.dense_layers(spark.createDataFrame([(2.5,)], "kcal double"), ["kcal"], **CALORIES).first()
    assert [r["z1"], r["z2"], r["z3"], r["z4"]] == pytest.approx([1.5, -1.05, 3.1, 0.0])
    assert [r["out1"], r["out2"]] == pytest.approx([4.42, 19.92])


def test_parameter_counts():
    assert layers.count_parameters(layers.fully_connected(784, 10)) == 235_146
    assert layers.count_parameters(layers.convolutional(28, 28, 10)) == 206_922
    assert layers.count_parameters(layers.curve_fitter(5)) == 12


@pytest.mark.parametrize("loss", ["cross_entropy", "squared"])
@pytest.mark.parametrize("kind", ["dense", "conv", "shared"])
def test_gradient_by_finite_differences(kind, loss):
    rng = np.random.default_rng(1)
    spec = {
        "dense": (("dense", 16, 7), ("relu",), ("dense", 7, 3)),
        "conv": (("image", 1, 4, 4), ("conv", 1, 2, 3), ("relu",), ("pool",), ("conv", 2, 3, 3), ("relu",), ("pool",), ("flatten",), ("dense", 3, 3)),
        "shared": (("dense_one_bias", 16, 5), ("relu",), ("dense", 5, 3)),
    }[kind]
    x = rng.standard_normal((6, 16))
    y = rng.integers(0, 3, 6).astype(float) if loss == "cross_entropy" else rng.standard_normal((6, 3))
    values = layers.flat(layers.initial(spec, 3))

    def at(v):
        return layers.loss_and_gradient(layers.forward(spec, layers.unflat(v, spec), x)[0], y, loss)[0]

    params = layers.unflat(values, spec)
    out, saved = layers.forward(spec, params, x)
    grad = layers.flat(layers.backward(spec, params, saved, layers.loss_and_gradient(out, y, loss)[1]))
    for i in range(0, len(values), max(1, len(values) // 25)):
        step = np.zeros_like(values)
        step[i] = 1e-6
        assert grad[i] == pytest.approx((at(values + step) - at(values - step)) / 2e-6, rel=1e-4, abs=1e-7)


def test_odd_image_is_cropped_by_pooling():
    spec = (("image", 1, 5, 5), ("conv", 1, 1, 3), ("pool",), ("flatten",), ("dense", 4, 2))
    params = layers.initial(spec, 0)
    out, saved = layers.forward(spec, params, np.ones((2, 25)))
    assert out.shape == (2, 2)
    assert [g.shape for g in layers.backward(spec, params, saved, np.ones((2, 2)))] == [p.shape for p in params]


def test_dropout_only_in_training():
    spec = (("dense", 4, 4), ("dropout", 0.5))
    params = [np.eye(4), np.zeros(4)]
    x = np.ones((1000, 4))
    assert (layers.forward(spec, params, x)[0] == 1.0).all()
    dropped = layers.forward(spec, params, x, np.random.default_rng(0))[0]
    assert set(np.unique(dropped)) == {0.0, 2.0} and abs(dropped.mean() - 1.0) < 0.1


def test_training_is_sequential_descent(spark):
    df = generate.sample_data(spark.range(95), "id", "line").cache()
    spec = layers.curve_fitter(5)
    start = layers.initial(spec, 42, "normal")
    fitted = training.train(df, "id", ["x"], "y", spec, "squared", "sgd", 0.005, epochs=2, batch_size=20, seed=42, start=start)
    values = layers.flat(start)
    losses = []
    for epoch in (1, 2):
        rows = df.withColumn("h", hash52("id", f"42/{epoch}")).orderBy("h", "id").collect()
        x, y = np.array([[r["x"]] for r in rows]), np.array([r["y"] for r in rows])
        batch = []
        for i in range(0, 95, 20):
            params = layers.unflat(values, spec)
            out, saved = layers.forward(spec, params, x[i : i + 20])
            loss, grad = layers.loss_and_gradient(out, y[i : i + 20], "squared")
            values = values - 0.005 * layers.flat(layers.backward(spec, params, saved, grad))
            batch.append(loss)
        losses.append(np.mean(batch))
    assert np.allclose(layers.flat(fitted.params), values)
    assert [h[2] for h in fitted.history] == pytest.approx(losses)
    assert [h[1] for h in fitted.history] == [5, 5]


def test_a_step_spreads_over_tasks(spark, monkeypatch):
    """Blocks of 16 rows over four partitions give the gradient of the whole batch."""
    monkeypatch.setattr(training, "SCORE_ROWS", 16)
    df = generate.sample_data(spark.range(400), "id", "line").cache()
    spec = layers.curve_fitter(5)
    start = layers.initial(spec, 42, "normal")
    fitted = training.train(df, "id", ["x"], "y", spec, "squared", "sgd", 0.005, epochs=1, batch_size=400, start=start)
    rows = df.collect()
    out, saved = layers.forward(spec, start, np.array([[r["x"]] for r in rows]))
    loss, grad = layers.loss_and_gradient(out, np.array([r["y"] for r in rows]), "squared")
    assert np.allclose(layers.flat(fitted.params), layers.flat(start) - 0.005 * layers.flat(layers.backward(spec, start, saved, grad)))
    assert fitted.history[0][2] == pytest.approx(loss)


def test_batches_share_jobs(spark, monkeypatch):
    """A run of batches is one task's work: 95 batches take few jobs, and runs that end anywhere give the same descent."""
    df = generate.sample_data(spark.range(950), "id", "line").cache()
    spec = layers.curve_fitter(5)
    start = layers.initial(spec, 42, "normal")

    def trained(group):
        spark.sparkContext.setJobGroup(group, group)
        try:
            return training.train(df, "id", ["x"], "y", spec, "squared", "adam", 0.005, epochs=1, batch_size=10, start=start)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    whole = trained("whole")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("whole")) < 30
    monkeypatch.setattr(training, "RUN_ROWS", 235)  # runs of 23 batches
    cut = trained("cut")
    assert np.allclose(layers.flat(whole.params), layers.flat(cut.params)) and whole.history[0][:2] == cut.history[0][:2] == (1, 95)
    assert whole.history[0][2] == pytest.approx(cut.history[0][2])


def test_the_curve_is_trained_in_small_batches(spark, data):
    """20 passes in batches of ten rows, not fewer passes in larger ones."""
    rows = QUERIES["train_curve_network"](spark, data).collect()
    assert len(rows) == 20 and {r["batches"] for r in rows} == {-(-load(spark, data, "customer").count() // 10)}


def test_training_is_repeatable_on_any_partitioning(spark, data):
    rows = load(spark, data, "embeddings").select("vec_id", "embedding", "label")
    spec = layers.fully_connected(64, 10)
    runs = [training.train(rows.repartition(p), "vec_id", "embedding", "label", spec, epochs=1, batch_size=250) for p in (1, 5)]
    assert np.allclose(layers.flat(runs[0].params), layers.flat(runs[1].params))


def test_classifier_learns_its_training_rows(spark, data):
    rows = load(spark, data, "embeddings").select("vec_id", "embedding", "label")
    rows = prepare.scale_pixels(rows, "embedding", 0.0, 0.125)  # unit variance per element
    spec = layers.fully_connected(64, 10)
    fitted = training.train(rows, "vec_id", "embedding", "label", spec, rate=0.005, epochs=8, batch_size=125)
    assert fitted.history[-1][2] < 0.9 * fitted.history[0][2]
    assert training.evaluate(fitted, rows, "embedding", "label") > 40.0


def test_weights_survive_a_table(spark):
    for spec in (layers.fully_connected(9, 3), layers.convolutional(8, 8, 10), layers.curve_fitter()):
        net = training.Network(spec, layers.initial(spec, 7))
        table = net.weight_table(spark).repartition(3)
        assert table.count() == layers.count_parameters(spec)
        assert np.allclose(layers.flat(training.from_weight_table(table, spec).params), layers.flat(net.params))


def test_expression_gradient_matches_numpy(spark):
    df = generate.sample_data(spark.range(100), "id", "line")
    w1, b1, w2, b2 = [0.5, -1.0, 2.0], 0.25, [1.0, -0.5, 0.75], 0.1
    got = network.squared_loss_gradient(df, "x", "y", w1, b1, w2, b2).first()
    spec = layers.curve_fitter(3)
    params = [np.array([w1]), np.array([b1]), np.array(w2)[:, None], np.array([b2])]
    rows = df.collect()
    out, saved = layers.forward(spec, params, np.array([[r["x"]] for r in rows]))
    loss, grad = layers.loss_and_gradient(out, np.array([r["y"] for r in rows]), "squared")
    expected = layers.flat(layers.backward(spec, params, saved, grad))
    names = ["w1_1", "w1_2", "w1_3", "b1", "w2_1", "w2_2", "w2_3", "b2"]
    assert got["loss"] == pytest.approx(loss)
    assert [got[n] for n in names] == pytest.approx(list(expected))


def test_softmax_entropy_is_stable(spark):
    from statloom.functions.numeric import argmax, cross_entropy

    df = spark.createDataFrame([([1000.0, 0.0, -1000.0], 0), ([3.0, 3.0, 1.0], 1)], "s array<double>, label int")
    got = df.select(cross_entropy(F.col("s"), F.col("label")).alias("l"), argmax(F.col("s")).alias("a")).collect()
    assert got[0]["l"] == pytest.approx(0.0) and [r["a"] for r in got] == [0, 0]


def test_tasks_run_without_the_package():
    """Executors have no copy of this repository: task functions must carry their code along."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    spec = layers.fully_connected(4, 2)
    blob = cloudpickle.dumps((layers.forward, spec, layers.initial(spec, 1)))
    code = (
        "import sys, numpy as np; from pyspark import cloudpickle\n"
        "f, spec, params = cloudpickle.loads(sys.stdin.buffer.read())\n"
        "assert 'statloom' not in sys.modules\n"
        "print(f(spec, params, np.ones((3, 4)))[0].shape)"
    )
    done = subprocess.run([sys.executable, "-c", code], input=blob, capture_output=True, cwd="/", check=True)
    assert done.stdout.strip() == b"(3, 2)"
