"""Ensembles over the split search against plain numpy, and their handling of odd input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.functions.hashing import uniform
from statloom.operators import split_search, trees


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(240).select("id", F.floor(uniform("id", "a", 0, 12)).cast("double").alias("a"), uniform("id", "b", -1, 1).alias("b"))
    noise = uniform("id", "n", 0, 1)
    return df.withColumn("kind", F.when(F.col("a") + 8 * F.col("b") + noise > 8, "high").when(F.col("b") < -0.2, "low").otherwise("mid")).cache()


def columns(df):
    rows = df.orderBy("id").collect()
    return np.array([[r["a"], r["b"]] for r in rows]), rows


def best_cut(x, counts, features):
    """Largest drop of the Gini impurity over all gaps; counts are one column for each class."""
    total, best = counts.sum(axis=0), None
    for f in features:
        values = np.unique(x[counts.sum(axis=1) > 0, f])
        for low, high in zip(values, values[1:]):
            left = counts[x[:, f] <= low].sum(axis=0)
            right = total - left
            share = round(((left**2).sum() / left.sum() + (right**2).sum() / right.sum()) / total.sum(), split_search.TIE_DIGITS)
            if best is None or share > best[0]:
                best = (share, f, (low + high) / 2)
    return best


def shares(x, counts, depth, allowed, node=1):
    out = np.tile(counts.sum(axis=0) / counts.sum(), (len(x), 1))
    if depth == 0 or np.count_nonzero(counts.sum(axis=0)) == 1:
        return out
    best = best_cut(x, counts, allowed(node))
    if best:
        left = x[:, best[1]] <= best[2]
        out[left] = shares(x[left], counts[left], depth - 1, allowed, 2 * node)
        out[~left] = shares(x[~left], counts[~left], depth - 1, allowed, 2 * node + 1)
    return out


@pytest.mark.parametrize("considered", [None, 1])
def test_forest_of_three_classes(spark, table, considered, monkeypatch):
    monkeypatch.setattr(split_search, "VALUE_ROWS", 50)
    number = 3
    model = trees.fit_trees(table, ["a", "b"], "kind", "forest", "classification", depth=3, trees=number, considered=considered, seed=5)
    x, rows = columns(model.transform(table.withColumns({f"w{t}": trees.copies("id", f"5/{t}") for t in range(number)})))
    labels, expected = ["high", "low", "mid"], np.zeros((len(x), 3))
    for t in range(number):
        counts = np.array([[r[f"w{t}"] * (r["kind"] == c) for c in labels] for r in rows], dtype=float)
        expected += shares(x, counts, 3, lambda i, t=t: trees.drawn_features(5, t, i, 2, considered or 2)) / number
    assert np.allclose([r["prediction_shares"] for r in rows], expected)
    assert [r["prediction"] for r in rows] == [labels[i] for i in expected.argmax(axis=1)]


def test_same_trees_on_any_partitioning(table):
    found = []
    for parts in (1, 6):
        model = trees.fit_trees(table.repartition(parts), ["a", "b"], "b", "boosting", "regression", depth=2, rounds=3, rate=0.5)
        found.append([r["prediction"] for r in model.transform(table).orderBy("id").collect()])
    assert np.allclose(found[0], found[1])


def test_missing_values_and_one_class(spark, table):
    gaps = table.select((F.col("id") + 1000).alias("id"), F.lit(float("nan")).alias("a"), "b", F.lit(None).cast("string").alias("kind"))
    whole, dirty = table, table.unionByName(gaps)
    models = [trees.fit_trees(df, ["a", "b"], "kind", "tree", "classification", depth=2) for df in (whole, dirty)]
    assert all(np.array_equal(p, q) for p, q in zip(models[0].trees[0], models[1].trees[0]))
    scored = models[1].transform(dirty)
    assert scored.where("prediction IS NULL").count() == gaps.count() == scored.where("prediction_shares IS NULL").count()
    one = trees.fit_trees(table.withColumn("kind", F.lit("only")), ["a"], "kind", "forest", "classification", trees=2)
    assert one.transform(table).select("prediction").distinct().collect() == [("only",)]
    with pytest.raises(ValueError):
        trees.fit_trees(table.where("false"), ["a"], "b", "tree", "regression")


def test_copies_have_mean_and_variance_one(spark):
    drawn = spark.range(20_000).select(trees.copies("id", "x").alias("n")).agg(F.avg("n"), F.var_pop("n")).first()
    assert drawn[0] == pytest.approx(1.0, abs=0.03) and drawn[1] == pytest.approx(1.0, abs=0.05)
