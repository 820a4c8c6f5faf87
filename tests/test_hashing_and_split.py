from __future__ import annotations

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.functions.hashing import hash52, normal, uniform
from statloom.operators import split
from statloom.plans import group_order, order_stats
from statloom.plans.order_stats import order_statistics, quantiles


def test_hash_golden_values(spark):
    rows = spark.range(5).select((hash52("id", 42) / F.lit(16**5)).cast("bigint").alias("h")).collect()
    assert [r["h"] for r in rows] == [2845920338, 2707051513, 2345943595, 1256425374, 1811195397]


def test_distributions(spark):
    r = spark.range(20000).select(uniform("id", 1, 2, 6).alias("u"), normal("id", 1, 5, 3).alias("z"))
    s = r.agg(F.avg("u"), F.min("u"), F.max("u"), F.avg("z"), F.stddev_pop("z")).first()
    assert abs(s[0] - 4) < 0.05 and s[1] >= 2 and s[2] < 6
    assert abs(s[3] - 5) < 0.1 and abs(s[4] - 3) < 0.1


@pytest.mark.parametrize("n,fraction", [(10, 0.3), (7, 0.5), (1000, 0.2), (1, 0.5), (30_000, 0.25)])
def test_split_is_exact_whatever_the_partitioning(spark, n, fraction):
    results = []
    for parts in (1, 4, 17):
        rows = split.train_test_split(spark.range(n).repartition(parts), "id", fraction, 42)
        results.append({r["id"] for r in rows.where("is_test").collect()})
        assert rows.count() == n
    assert len(results[0]) == math.ceil(round(n * fraction, 9))
    assert results[0] == results[1] == results[2]


def test_fold_sizes(spark):
    rows = split.k_fold(spark.range(392), "id", 10, 42)
    sizes = [r["count"] for r in rows.groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [40, 40] + [39] * 8
    few = split.k_fold(spark.range(3), "id", 5, 42).groupBy("fold").count().orderBy("fold").collect()
    assert [(r["fold"], r["count"]) for r in few] == [(0, 1), (1, 1), (2, 1)]


def test_narrowing_finds_the_same_cut_as_a_sort(spark):
    rows = spark.range(5000)
    h = sorted((r["h"], r["id"]) for r in rows.select(hash52("id", 3).alias("h"), "id").collect())
    _, found = order_statistics(rows, hash52("id", 3), lambda _g, n: [1, 17, 2500, n], bins=8, leaf_rows=10)
    assert [found[0][k].value for k in (1, 17, 2500, 5000)] == [h[k - 1][0] for k in (1, 17, 2500, 5000)]


def test_order_statistics_with_a_hot_value_and_outlier(spark):
    values = [0.0] * 400 + [float(i) for i in range(1, 600)] + [1e300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ordered = sorted(values)
    _, found = order_statistics(df, F.col("v"), lambda _g, n: [1, 400, 401, 999, 1000], bins=4, leaf_rows=5)
    assert [found[0][k].value for k in (1, 400, 401, 999, 1000)] == [ordered[k - 1] for k in (1, 400, 401, 999, 1000)]
    assert found[0][1].equal == 400 and found[0][401].below == 400


@pytest.mark.parametrize(("kind", "groups"), [("int", [0, None]), ("string", ["a", None]), ("date", [datetime.date(2020, 1, 2), None])])
def test_spans_become_rows_without_python_workers(spark, kind, groups):
    spans = [order_stats._Span(g, -0.1, math.inf, 3, 9, [4]) for g in groups]
    table = order_stats._span_table(spark, spans, kind, "double")
    assert table.dtypes == [("span", "int"), ("sg", kind), ("lo", "double"), ("hi", "double")]
    assert sorted(map(tuple, table.collect())) == [(i, g, -0.1, math.inf) for i, g in enumerate(groups)]
    if kind != "date":  # a second pool of workers took 85 MB of every executor beside the first
        assert "PythonRDD" not in table._jdf.queryExecution().toRdd().toDebugString()


def test_quantiles_by_group_match_percentile(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), uniform("id", 5, -10, 10).alias("v"))
    _, found = quantiles(df, F.col("v"), [0.25, 0.5, 0.9], F.col("g"))
    for r in df.groupBy("g").agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.9))).alias("p")).collect():
        assert found[r["g"]] == pytest.approx(r["p"])


def test_tied_hashes_are_cut_by_id(spark):
    constant = spark.range(9).withColumn("h", F.lit(7).cast("bigint"))
    _, found = order_statistics(constant, F.col("h"), lambda _g, _n: [4])
    cut = split._cut(constant, "id", F.col("h"), found[0][4], 4)
    kept = constant.where(split._up_to("id", F.col("h"), cut)).collect()
    assert [r["id"] for r in kept] == [0, 1, 2, 3]


def test_ranks_and_batches(spark, monkeypatch):
    monkeypatch.setattr(split, "BUCKET_ROWS", 100)
    rows = spark.range(1050).repartition(7)
    expected = sorted(rows.select("id", hash52("id", 5).alias("h")).collect(), key=lambda r: (r["h"], r["id"]))
    ranks = {r["id"]: r["rank"] for r in split.hash_rank(rows, "id", 5).collect()}
    assert [ranks[r["id"]] for r in expected] == list(range(1, 1051))
    in_order = {r["id"]: r["rank"] for r in split.id_rank(rows, "id").collect()}
    assert in_order == {i: i + 1 for i in range(1050)}
    batches = split.mini_batches(rows, "id", 100, 5).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in batches] == [100] * 10 + [50]


def test_repeated_split_sides_differ_by_seed(spark):
    rows = split.repeated_split(spark.range(100), "id", 0.5, [0, 1, 2])
    sizes = {r["seed"]: r["n"] for r in rows.where("is_test").groupBy("seed").agg(F.count("id").alias("n")).collect()}
    assert sizes == {0: 50, 1: 50, 2: 50}


@pytest.mark.parametrize("bucket_rows", [7, 500_000])
def test_positions_on_any_partitioning(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(split, "BUCKET_ROWS", bucket_rows)
    ids = spark.range(3, 200, 3)
    results = []
    for parts in (1, 4, 17):
        rows = split.shuffle_positions(ids.repartition(parts), "id", 9, [1, 2]).collect()
        results.append(sorted((r["epoch"], r["position"], r["id"]) for r in rows))
        ranked = split.id_rank(ids.unionByName(spark.sql("select cast(null as bigint) as id")).repartition(parts), "id").collect()
        assert sorted((r["rank"], r["id"] or 0) for r in ranked) == [(k + 1, 3 * k) for k in range(67)]
    assert results[0] == results[1] == results[2]
    assert [r[:2] for r in results[0]] == [(e, k) for e in (1, 2) for k in range(66)]
    assert [r[2] for r in results[0][:66]] != [r[2] for r in results[0][66:]]


def test_shuffle_changes_with_epoch_but_not_partitioning(spark):
    def order(epoch, parts):
        return [r["id"] for r in split.shuffle_rows(spark.range(50).repartition(parts), "id", 1, epoch).collect()]

    assert order(1, 2) == order(1, 5) != order(2, 2)
    assert split.pick_row(spark.range(50).repartition(3), "id", 4).collect() == split.pick_row(spark.range(50), "id", 4).collect()


@pytest.mark.parametrize("leaf_rows", [1, 10**6])
def test_group_quantiles_narrow_brackets_down(spark, leaf_rows):
    """One group holds most rows, some hold one, one is NULL; values repeat, crowd at one end, or are all alike."""
    df = spark.range(4000).select(
        F.when(F.col("id") % 10 < 7, "most").when(F.col("id") % 10 == 7, F.concat(F.lit("g"), F.floor(F.col("id") / 100))).when(F.col("id") % 10 == 8, "same").alias("g"),
        F.when(F.col("id") % 10 == 8, 3.0).when(F.col("id") % 10 == 9, F.exp(uniform("id", 3, -300, 300))).otherwise(F.round(uniform("id", 8), 2)).alias("v"),
    )
    gaps = spark.createDataFrame([("most", None), ("most", float("nan")), ("empty", None)], "g string, v double")
    df = df.unionByName(gaps).cache()
    values = {}
    for r in df.collect():
        if r["v"] is not None and r["v"] == r["v"]:
            values.setdefault(r["g"], []).append(r["v"])
    probabilities = [0.0, 0.25, 0.5, 0.99, 1.0]
    found = {r["g"]: (r["n"], r["q"]) for r in group_order.group_quantiles(df, F.col("v"), F.col("g"), probabilities, leaf_rows).collect()}
    assert set(found) == set(values) and len(found) > 40
    for g, v in values.items():
        assert found[g][0] == len(v)
        assert np.allclose(found[g][1], np.quantile(v, probabilities), rtol=1e-9)


def test_order_statistics_of_the_driver_take_few_groups(spark, monkeypatch):
    from statloom.plans import order_stats

    df = spark.range(600).select((F.col("id") % 6).cast("string").alias("g"), uniform("id", 8).alias("v"))
    monkeypatch.setattr(order_stats, "MAX_GROUPS", 3)
    with pytest.raises(order_stats.TooManyGroups):
        order_stats.quantiles(df, F.col("v"), [0.5], F.col("g"))
