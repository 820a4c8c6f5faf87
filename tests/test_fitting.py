from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.functions.hashing import normal, uniform
from statloom.functions.polynomial import exponents
from statloom.operators import exact_tree, kmeans, logistic, metrics, prepare, regression, split_search, validation
from statloom.operators.split import k_fold, split_columns, train_test_split
from statloom.plans.gram import column_gram
from statloom.sources import generate, grid, models
from statloom.session import new_shared_path


@pytest.fixture(scope="module")
def cosine(spark):
    df = generate.sample_data(spark.range(200), "id", "cosine").cache()
    rows = df.orderBy("id").collect()
    yield df, np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows])
    df.unpersist()


def test_exponent_order():
    assert exponents(2, 2) == [(0, 0), (1, 0), (0, 1), (2, 0), (1, 1), (0, 2)]


def test_polynomial_matches_numpy(cosine):
    df, x, y = cosine
    for degree in (1, 3, 12, 20):
        fitted = regression.fit_polynomial(df, ["x"], "y", degree).predict(df).orderBy("id").collect()
        expected = np.polynomial.Chebyshev.fit(x, y, degree)(x)
        assert np.allclose([r["prediction"] for r in fitted], expected, atol=1e-8)


def test_polynomial_extends_beyond_the_data(spark, cosine):
    df, x, y = cosine
    model = regression.fit_polynomial(df, ["x"], "y", 4)
    points = grid.linspace(spark, -0.5, 1.5, 21)
    got = [r["prediction"] for r in model.predict(points).orderBy("id").collect()]
    assert np.allclose(got, np.polynomial.Chebyshev.fit(x, y, 4)(np.linspace(-0.5, 1.5, 21)), atol=1e-7)


def test_surface_matches_lstsq(spark):
    df = generate.sample_data(spark.range(200), "id", "education_2d")
    rows = df.orderBy("id").collect()
    a, b, y = (np.array([r[c] for r in rows]) for c in ("x1", "x2", "y"))
    design = np.stack([a**i * b**j for i, j in exponents(2, 3)], axis=1)
    expected = design @ np.linalg.lstsq(design, y, rcond=None)[0]
    got = regression.fit_polynomial(df, ["x1", "x2"], "y", 3).predict(df).orderBy("id").collect()
    assert np.allclose([r["prediction"] for r in got], expected, rtol=1e-6)


def test_wide_and_narrow_gram_agree(spark):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("g"), *[uniform("id", i, -1, 1).alias(f"x{i}") for i in range(14)])
    basis = [F.col(f"x{i}") for i in range(14)]
    wide = column_gram(df, basis, F.col("x0") * 2 + 1, ["g"])
    narrow = column_gram(df, basis[:5], F.col("x0") * 2 + 1, ["g"])
    for key, g in narrow.items():
        assert g.n == wide[key].n
        assert np.allclose(g.g, wide[key].g[:5, :5]) and np.allclose(g.c, wide[key].c[:5])
        assert g.yy == pytest.approx(wide[key].yy)
    assert column_gram(df, basis, F.col("x0"))[()].n == 500


def test_linear_with_constant_column(spark):
    df = spark.range(50).select("id", F.lit(3.0).alias("c"), uniform("id", 1, 0, 9).alias("x")).withColumn("y", 2 * F.col("x") + 1)
    model = regression.fit_linear(df, ["x", "c"], "y")
    assert model.coefficients[0] == pytest.approx(2.0)
    got = metrics.regression_metrics(model.predict(df), "y", "prediction", 2).first()
    assert got["mse"] == pytest.approx(0.0, abs=1e-18) and got["r2"] == pytest.approx(1.0)


def test_metrics_edge_cases(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    got = metrics.regression_metrics(df, "y", "p", 1).first()
    assert got["r2"] == 1.0 and got["rse"] is None
    assert metrics.regression_metrics(df.withColumn("p", F.lit(2.0)), "y", "p", 0).first()["r2"] == 0.0
    one_class = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    got = metrics.classification_metrics(one_class, "label", "prediction").first()
    assert got["accuracy"] == 1.0 and got["f1"] == 0.0


def _refit(x, y, train, test, degree):
    model = np.polynomial.Chebyshev.fit(x[train], y[train], degree, domain=[x.min(), x.max()])
    return np.mean((y[test] - model(x[test])) ** 2)


def test_cross_validation_equals_refitting(cosine):
    df, x, y = cosine
    folds = np.array([r["fold"] for r in k_fold(df, "id", 10, 42).orderBy("id").collect()])
    got = {r["degree"]: r["mse"] for r in validation.k_fold_cv(df, "id", ["x"], "y", range(1, 11)).collect()}
    for d in (1, 4, 10):
        expected = np.mean([_refit(x, y, folds != f, folds == f, d) for f in range(10)])
        assert got[d] == pytest.approx(expected, rel=1e-8)


def test_leave_one_out_equals_refitting(cosine):
    df, x, y = cosine
    every = np.arange(len(x))
    for d in (1, 5):
        expected = np.mean([_refit(x, y, every != i, every == i, d) for i in every])
        assert validation.loo_cv(df, ["x"], "y", d).first()["mse"] == pytest.approx(expected, rel=1e-8)


def test_repeated_holdout_equals_refitting(cosine):
    df, x, y = cosine
    seeds = list(range(12))  # more than one pass
    sides = split_columns(df, "id", 0.5, seeds).orderBy("id").collect()
    got = {(r["seed"], r["degree"]): r["mse"] for r in validation.repeated_holdout(df, "id", ["x"], "y", seeds, [2, 6]).collect()}
    for s in (0, 9, 11):
        held = np.array([r[f"test_{s}"] for r in sides])
        assert got[(s, 6)] == pytest.approx(_refit(x, y, ~held, held, 6), rel=1e-8)


def test_training_error_never_rises_with_degree(cosine):
    curve = validation.learning_curve(cosine[0], "id", ["x"], "y", range(1, 21)).orderBy("degree").collect()
    train = [r["train_mse"] for r in curve]
    assert all(b <= a + 1e-12 for a, b in zip(train, train[1:]))
    assert min(r["test_mse"] for r in curve) < curve[0]["test_mse"] / 2


def _numpy_logistic(x, y, c):
    design = np.column_stack([np.ones(len(y)), x])
    penalty = np.diag([0.0] + [1.0 / c] * (design.shape[1] - 1))
    beta = np.zeros(design.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-design @ beta))
        h = design.T @ (design * (p * (1 - p))[:, None]) + penalty
        beta = beta + np.linalg.solve(h, design.T @ (y - p) - penalty @ beta)
    return beta


def test_logistic_matches_newton_in_numpy(spark):
    df = generate.credit_data(spark.range(200), "id").cache()
    rows = df.orderBy("id").collect()
    x = np.array([[r["income"], r["balance"]] for r in rows])
    y = np.array([r["defaulted"] for r in rows], dtype=float)
    for c in (1.0, 1e-6):
        model = logistic.fit_logistic(df, ["income", "balance"], "defaulted", c)
        expected = _numpy_logistic(x, y, c)
        assert np.allclose([model.intercept, *model.coefficients], expected, rtol=1e-5)


def test_wide_logistic_agrees_with_newton(spark):
    columns = [f"x{i}" for i in range(12)]
    df = spark.range(400).select("id", *[normal("id", c).alias(c) for c in columns])
    df = df.withColumn("y", (uniform("id", "y") < 1 / (1 + F.exp(-F.col("x0") + F.col("x1")))).cast("int")).cache()
    wide = logistic.fit_logistic(df, columns, "y")
    x = np.array([[r[c] for c in columns] for r in df.collect()])
    expected = _numpy_logistic(x, np.array([r["y"] for r in df.collect()], dtype=float), 1.0)
    assert np.allclose([wide.intercept, *wide.coefficients], expected, atol=1e-4)


def test_scaler_and_filters(spark):
    df = generate.sample_data(spark.range(300), "id", "tv_sales").withColumn("flat", F.lit(4.0))
    got = prepare.standardize(df, ["tv", "flat"]).agg(F.avg("tv"), F.stddev_pop("tv"), F.max("flat")).first()
    assert got[0] == pytest.approx(0.0, abs=1e-12) and got[1] == pytest.approx(1.0) and got[2] == 0.0
    split = train_test_split(df, "id", 0.3, 1)
    seen = prepare.fit_scaler(split, ["tv"], only=~F.col("is_test")).means[0]
    assert seen == pytest.approx(split.where("not is_test").agg(F.avg("tv")).first()[0])
    odd = spark.createDataFrame([(float(i),) for i in range(20)] + [(1000.0,), (None,)], "`연봉(천만원)` double")
    assert prepare.drop_missing(odd, ["연봉(천만원)"]).count() == 21
    assert prepare.iqr_filter(odd, "연봉(천만원)").count() == 20
    filled = prepare.fill_missing(odd, ["연봉(천만원)"], "median")
    assert filled.where("`연봉(천만원)` = 10").count() == 2


def test_awkward_column_names(spark):
    name = "소비 지수(1~100)"
    df = spark.range(40).select("id", (F.col("id") * 1.0).alias(name), (F.col("id") * 3.0 + 2).alias("y"))
    model = regression.fit_linear(df, [name], "y")
    assert model.coefficients[0] == pytest.approx(3.0)
    assert prepare.standardize(df, [name]).columns == df.columns
    assert prepare.polynomial_features(df, [name], 2).where(f"poly_2 <> `{name}` * `{name}`").count() == 0


def test_model_round_trip(spark):
    model = regression.LinearModel(("b", "a"), 1.5, (2.5, -3.5), "logit")
    path = new_shared_path(spark, "roundtrip")
    with pytest.raises(models.IncompleteModel):
        models.load_linear(spark, path)
    assert models.save_linear(spark, model, path) == 1
    assert models.load_linear(spark, path) == model
    other = regression.LinearModel(("b",), 0.0, (float("inf"),), "logit", False)
    assert models.save_linear(spark, other, path) == 2
    assert models.load_linear(spark, path) == other and models.load_linear(spark, path, 1) == model
    models.remove(spark, path)
    with pytest.raises(models.IncompleteModel):
        models.load_linear(spark, path)


def test_half_written_model_is_refused(spark):
    model = regression.LinearModel(("a", "b", "c"), 1.5, (2.5, -3.5, 0.1))
    path = new_shared_path(spark, "half")
    rows = [(0, "(intercept)", 1.0, "identity", True)]
    spark.createDataFrame(rows, models.LINEAR).write.parquet(f"{path}/linear-unnamed")  # written, but never named
    with pytest.raises(models.IncompleteModel):
        models.load_linear(spark, path)
    models.save_linear(spark, model, path)
    name = spark.read.parquet(f"{path}/manifest").first()["name"]
    part = spark.read.parquet(f"{path}/{name}").where("position < 2").collect()
    spark.createDataFrame(part, models.LINEAR).write.mode("overwrite").parquet(f"{path}/{name}")
    with pytest.raises(models.IncompleteModel):
        models.load_linear(spark, path)


def test_recovers_known_line(spark):
    df = generate.sample_data(spark.range(20_000), "id", "tv_radio_sales")
    model = regression.fit_linear(df, ["tv", "radio"], "y")
    assert model.intercept == pytest.approx(5.0, abs=0.15)
    assert model.coefficients == pytest.approx((0.05, 0.15), abs=0.005)


def _best_cut(x, y):
    """Brute force over all gaps of all features: (feature, threshold, error)."""
    options = []
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[:-1] + values[1:]) / 2:
            left = x[:, f] <= cut
            error = ((y[left] - y[left].mean()) ** 2).sum() + ((y[~left] - y[~left].mean()) ** 2).sum()
            options.append((round(error, 6), f, cut))
    return min(options)


def _grow(x, y, depth):
    if depth == 0 or len(np.unique(y)) == 1:
        return np.full(len(y), y.mean())
    _, f, cut = _best_cut(x, y)
    left, result = x[:, f] <= cut, np.empty(len(y))
    result[left], result[~left] = _grow(x[left], y[left], depth - 1), _grow(x[~left], y[~left], depth - 1)
    return result


@pytest.mark.parametrize("values, slots", [(100_000, 32_768), (20, 64), (0, 16)])
def test_exact_tree_equals_brute_force(spark, monkeypatch, values, slots):
    """Few slots and few single values make the search open bins again and again."""
    monkeypatch.setattr(split_search, "VALUE_ROWS", values)
    monkeypatch.setattr(split_search, "BIN_SLOTS", slots)
    df = generate.sample_data(spark.range(200), "id", "education_2d")
    df = df.withColumn("x2", F.floor("x2").cast("double"))  # repeated values
    df = df.withColumn("x1", F.exp(F.col("x1") * 30 - 300))  # crowded at the low end
    tree = exact_tree.fit_regression_tree(df, ["x1", "x2"], "y", 4)
    rows = tree.predict(df).orderBy("id").collect()
    expected = _grow(np.array([[r["x1"], r["x2"]] for r in rows]), np.array([r["y"] for r in rows]), 4)
    assert np.allclose([r["prediction"] for r in rows], expected)
    leaves = tree.table(spark).where("feature is null")
    assert leaves.agg(F.sum("n")).first()[0] == 200 and leaves.agg(F.max("depth")).first()[0] == 4


def test_edges_always_separate_the_ends():
    for low, high in ((0.0, 5e-324), (-1e308, 1e308), (-5e-324, 1.0), (1.0, np.nextafter(1.0, 2.0)), (-2.0, -1.0), (1e-300, 1e300)):
        found = split_search.edges(low, high, 8)
        assert found[0] == low and found[-1] == high and (np.diff(found) > 0).all()


@pytest.mark.parametrize("kind", ["sums", "counts"])
def test_bound_is_never_below_a_cut_inside(kind):
    rng = np.random.default_rng(7)
    for _ in range(300):
        n = int(rng.integers(3, 12))
        statistic = split_search.Counts(3) if kind == "counts" else split_search.Sums(float(rng.integers(0, 2)))
        target = rng.integers(0, 3, n).astype(float) if kind == "counts" else rng.normal(size=n)
        values = statistic.of_rows(rng.integers(1, 4, n).astype(float), target, np.ones(n))
        a, b = sorted(rng.choice(n + 1, 2, replace=False))
        before, inside, totals = values[:a].sum(axis=0), values[a:b], values.sum(axis=0)
        if not len(inside):
            continue
        ends = np.zeros(1), np.ones(1)
        bins = split_search.Bins(*ends, inside.sum(axis=0)[None], target[a:b].min()[None], target[a:b].max()[None])
        bound = statistic.bound(before[None], bins, totals, 0.0)[0]
        for j in range(b - a + 1):
            left = before + inside[:j].sum(axis=0)
            assert statistic.gain(left) + statistic.gain(totals - left) <= bound + 1e-9


def test_tree_of_constant_target_or_features(spark):
    df = spark.range(20).select("id", F.lit(2.0).alias("x"), F.col("id").cast("double").alias("z"), F.lit(7.0).alias("y"))
    assert len(exact_tree.fit_regression_tree(df, ["x", "z"], "y").nodes) == 1
    assert len(exact_tree.fit_regression_tree(df, ["x"], "z").nodes) == 1


def test_logistic_fit_is_the_same_on_any_partitioning(spark):
    df = generate.credit_data(spark.range(2000), "id").cache()
    whole = logistic.fit_logistic(df, ["income", "balance"], "defaulted")
    dealt = logistic.fit_logistic(df.repartition(7), ["income", "balance"], "defaulted")
    assert np.allclose([whole.intercept, *whole.coefficients], [dealt.intercept, *dealt.coefficients], rtol=1e-8)


def test_logistic_says_when_it_does_not_settle(spark):
    df = spark.range(60).select("id", F.col("id").cast("double").alias("x"), (F.col("id") >= 30).cast("int").alias("y"))
    assert not logistic.fit_logistic(df, ["x"], "y", c=float("inf")).converged
    mixed = df.withColumn("y", F.when(F.col("id") % 7 == 0, 1 - F.col("y")).otherwise(F.col("y")))
    assert logistic.fit_logistic(mixed, ["x"], "y", c=float("inf")).converged


def test_block_sums_equal_sums_in_generated_code(spark, monkeypatch):
    df = generate.credit_data(spark.range(500), "id").withColumn("fold", F.col("id") % 3)
    settings = [(1.0, None), (0.1, 0), (5.0, 2)]
    narrow = logistic.fit_logistic_many(df, ["income", "balance"], "defaulted", settings, "fold")
    monkeypatch.setattr(logistic, "SQL_COLUMNS", 2)
    wide = logistic.fit_logistic_many(df, ["income", "balance"], "defaulted", settings, "fold")
    for a, b in zip(narrow, wide):
        assert np.allclose([a.intercept, *a.coefficients], [b.intercept, *b.coefficients], rtol=1e-9) and a.converged and b.converged


def test_logistic_on_separable_rows_is_held_by_the_penalty(spark):
    df = spark.range(60).select("id", F.col("id").cast("double").alias("x"), (F.col("id") >= 30).cast("int").alias("y"))
    model = logistic.fit_logistic(df, ["x"], "y")
    x = np.arange(60.0)[:, None]
    assert np.allclose([model.intercept, *model.coefficients], _numpy_logistic(x, (np.arange(60) >= 30) * 1.0, 1.0), rtol=1e-4)


def test_rows_with_missing_values_take_no_part_in_a_fit(spark):
    clean = generate.sample_data(spark.range(300), "id", "tv_radio_sales").cache()
    gap = clean.withColumn("id", F.col("id") + 1000).withColumn("tv", F.when(F.col("id") % 3 == 1, F.lit(float("nan"))))
    dirty = clean.unionByName(gap)
    a, b = (regression.fit_linear(df, ["tv", "radio"], "y") for df in (clean, dirty))
    assert [b.intercept, *b.coefficients] == pytest.approx([a.intercept, *a.coefficients])
    no_radio = gap.withColumn("radio", F.lit(None).cast("double"))
    a, b = (regression.fit_polynomial(df, ["radio"], "y", 3).coefficients for df in (clean, clean.unionByName(no_radio)))
    assert b == pytest.approx(a)
    label = (F.col("y") > 15).cast("int")
    a, b = (logistic.fit_logistic(df.withColumn("l", label), ["tv"], "l") for df in (clean, dirty))
    assert b.coefficients == pytest.approx(a.coefficients)
    assert exact_tree.fit_regression_tree(dirty, ["tv"], "y", 2).nodes[1].n == 300
    assert kmeans.fit_kmeans(dirty, "id", ["tv", "radio"], 2, n_init=1).counts.sum() == 300
