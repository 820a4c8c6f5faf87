from __future__ import annotations

import tracemalloc

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.catalog import ORACLES, QUERIES
from statloom.functions.hashing import hash52, normal, uniform
from statloom.operators import kmeans, linkage, prepare
from statloom.sources import generate
from tests.check_oracle import differences

CENTERS = [(-2.5, 9.0), (4.5, 2.0), (-6.5, -7.0)]


@pytest.fixture(scope="module")
def blobs(spark):
    df = prepare.standardize(generate.blobs(spark.range(300), "id", CENTERS), ["x1", "x2"]).cache()
    yield df
    df.unpersist()


def serial_linkage(points, weights, method):
    """Classic loop: merge the closest pair, one at a time."""
    members = {i: [i] for i in range(len(points))}
    base = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))

    def distance(a, b):
        d = base[np.ix_(a, b)]
        if method == "single":
            return d.min()
        if method == "complete":
            return d.max()
        wa, wb = weights[a], weights[b]
        if method == "average":
            return (d * wa[:, None] * wb[None]).sum() / (wa.sum() * wb.sum())
        ca, cb = (np.average(points[m], axis=0, weights=weights[m]) for m in (a, b))
        return np.sqrt(2 * wa.sum() * wb.sum() / (wa.sum() + wb.sum())) * np.linalg.norm(ca - cb)

    merges = []
    while len(members) > 1:
        names = sorted(members)
        d, a, b = min((distance(members[a], members[b]), a, b) for i, a in enumerate(names) for b in names[i + 1 :])
        members[a] = members[a] + members.pop(b)
        merges.append((a, b, d, int(weights[members[a]].sum())))
    return merges


@pytest.mark.parametrize("method", ["average", "single", "complete", "ward"])
@pytest.mark.parametrize("split", [False, True])
def test_rounds_equal_the_serial_loop(spark, monkeypatch, method, split):
    if split:  # force clusters to be spread over several tasks
        monkeypatch.setattr(linkage, "BLOCK_CELLS", 60)
        monkeypatch.setattr(linkage, "TASK_WORK", 500)
    df = spark.range(40).select("id", uniform("id", 1, 0, 10).alias("a"), normal("id", 2).alias("b"))
    df = df.union(df.where("id < 5").withColumn("id", F.col("id") + 100))  # copies of five points
    tree = linkage.fit_tree(df, "id", ["a", "b"], method)
    assert tree.exact and tree.weights.sum() == 45 and len(tree.points) == 40
    expected = serial_linkage(tree.points, tree.weights.astype(float), method)
    assert [(a, b, n) for a, b, _, n in tree.merges] == [(a, b, n) for a, b, _, n in expected]
    assert np.allclose([m[2] for m in tree.merges], [m[2] for m in expected])
    heights = [m[2] for m in tree.merges]
    assert heights == sorted(heights)


@pytest.mark.parametrize("method", ["average", "single", "complete", "ward"])
def test_rounds_over_blocks_equal_the_serial_loop(spark, monkeypatch, method):
    monkeypatch.setattr(linkage, "MATRIX_CLUSTERS", 5)
    monkeypatch.setattr(linkage, "BLOCK_CLUSTERS", 8)
    monkeypatch.setattr(linkage, "NEAREST", 2)
    draw = np.random.default_rng(5)
    points, weights = draw.normal(size=(50, 3)), draw.integers(1, 4, 50).astype(float)
    points[:12] = points[0] + draw.normal(size=(12, 3)) * 1e-3
    merges, _ = linkage._merge_rounds(spark, points, weights, method)
    expected = serial_linkage(points, weights, method)
    assert [(a, b, n) for a, b, _, n in merges] == [(a, b, n) for a, b, _, n in expected]
    assert np.allclose([m[2] for m in merges], [m[2] for m in expected])


def test_single_linkage_of_many_points_is_exact(spark):
    """Merge heights on a line are the gaps between neighbours."""
    df = spark.range(20_200).select("id", uniform("id", "line", 0, 1000).alias("a"))
    tree = linkage.fit_tree(df, "id", ["a"], "single")
    line = np.sort([r["a"] for r in df.collect()])
    assert tree.exact and len(tree.merges) == 20_199 and tree.merges[-1][3] == 20_200
    assert np.allclose([m[2] for m in tree.merges], np.sort(np.diff(line)), rtol=1e-9, atol=0)


def test_top_levels_of_many_points_are_exact(spark):
    """Two clouds of 20,000 and 200 points: the last height is the mean over all pairs of their rows."""
    side = F.when(F.col("id") < 20_000, 0.0).otherwise(50.0)
    df = spark.range(20_200).select("id", (side + uniform("id", "x", 0, 9)).alias("a"), uniform("id", "y", 0, 9).alias("b"))
    tree = linkage.fit_tree(df, "id", ["a", "b"], "average")
    root = tree.top_levels(spark, 0).collect()[0]
    assert tree.exact and len(tree.merges) == 20_199 and (root["left_size"], root["right_size"]) == (20_000, 200)
    x = tree.points
    assert root["height"] == pytest.approx(np.mean([np.sqrt(((x[:20_000] - p) ** 2).sum(axis=1)).mean() for p in x[20_000:]]))
    assert tree.cut(2).tolist() == [0] * 20_000 + [1] * 200


def test_tied_grid_ends_with_one_cluster(spark):
    df = spark.range(36).select("id", (F.col("id") % 6).cast("double").alias("a"), F.floor(F.col("id") / 6).cast("double").alias("b"))
    for method in ("average", "single", "complete", "ward"):
        tree = linkage.fit_tree(df, "id", ["a", "b"], method)
        assert len(tree.merges) == 35 and tree.merges[-1][3] == 36


def test_cut_levels_and_labels(spark, blobs):
    tree = linkage.fit_tree(blobs, "id", ["x1", "x2"], "average")
    labelled = tree.assign(blobs, ["x1", "x2"], 3)
    pairs = labelled.groupBy("cluster", "true_cluster").count().collect()
    assert len(pairs) == 3 and {r["count"] for r in pairs} == {100}
    top = tree.top_levels(spark, 2).collect()
    assert max(r["depth"] for r in top) <= 2
    root = next(r for r in top if r["depth"] == 0)
    assert root["left_size"] + root["right_size"] == 300


def test_condensed_tree_keeps_every_row(spark, blobs):
    with pytest.raises(ValueError):
        linkage.fit_tree(blobs, "id", ["x1", "x2"], max_exact=50)
    tree = linkage.fit_tree(blobs, "id", ["x1", "x2"], max_exact=50, condense=20)
    assert not tree.exact and tree.merges[-1][3] == 300
    pairs = tree.assign(blobs, ["x1", "x2"], 3).groupBy("cluster", "true_cluster").count().collect()
    assert len(pairs) == 3


def test_cut_of_many_customers_equals_the_sql(spark, tmp_path):
    ids = [20_500 - i for i in range(20_500)]
    spark.createDataFrame([(i,) for i in ids], "c_custkey long").write.parquet(str(tmp_path / "customer.parquet"))
    con = duckdb.connect()
    con.execute(f"create view customer as select * from read_parquet('{tmp_path}/customer.parquet/*.parquet')")
    assert differences(QUERIES["tree_cut_blobs"](spark, str(tmp_path)), con, ORACLES["tree_cut_blobs"]) is None


def test_rows_without_a_leaf_go_to_the_nearest(spark):
    rows = [(0, 0.0, 1.0), (1, 0.1, 1.0), (2, 7.0, 7.0)]
    tree = linkage.fit_tree(spark.createDataFrame(rows, "id long, a double, b double"), "id", ["a", "b"])
    other = spark.createDataFrame([(5, -0.0, 1.0), (6, 6.0, 8.0), (7, 7.0, 7.0)], "id long, a double, b double")
    assert {r["id"]: r["cluster"] for r in tree.assign(other, ["a", "b"], 2).collect()} == {5: 0, 6: 1, 7: 1}


def test_kmeans_finds_the_groups(spark, blobs):
    fit = kmeans.fit_kmeans(blobs, "id", ["x1", "x2"], 3)
    labelled = kmeans.assign(blobs, ["x1", "x2"], fit.centers)
    assert sorted(fit.counts) == [100, 100, 100]
    assert labelled.groupBy("cluster", "true_cluster").count().count() == 3
    assert kmeans.inertia(labelled).first()[0] == pytest.approx(fit.inertia)


def test_kmeans_does_not_depend_on_partitions(spark, blobs):
    fits = [kmeans.fit_kmeans(blobs.repartition(p), "id", ["x1", "x2"], 4, n_init=3) for p in (1, 5)]
    assert np.allclose(fits[0].centers, fits[1].centers)


def test_elbow_falls_and_starts_at_n_times_d(spark, blobs):
    rows = {r["k"]: r["wcss"] for r in kmeans.elbow(blobs, "id", ["x1", "x2"], list(range(1, 6))).collect()}
    assert rows[1] == pytest.approx(600.0)
    assert all(rows[k + 1] < rows[k] for k in range(1, 5))


def test_more_clusters_than_points(spark):
    df = spark.range(10).select("id", (F.col("id") % 2).cast("double").alias("a"))
    fit = kmeans.fit_kmeans(df, "id", ["a"], 5, n_init=2)
    assert fit.inertia == pytest.approx(0.0) and len(fit.centers) == 2


def test_runs_in_blocks_equal_runs_together(spark, blobs, monkeypatch):
    together = kmeans.fit_kmeans_runs(blobs, "id", ["x1", "x2"], [2, 5], n_init=3, tol=0.0)
    monkeypatch.setattr(kmeans, "BLOCK_VALUES", 12)
    apart = kmeans.fit_kmeans_runs(blobs, "id", ["x1", "x2"], [2, 5], n_init=3, tol=0.0)
    for a, b in zip(together, apart):
        assert np.allclose(a.centers, b.centers) and a.inertia == pytest.approx(b.inertia) and a.iterations == b.iterations and a.converged


def test_unsettled_runs_say_so(spark, blobs):
    runs = kmeans.fit_kmeans_runs(blobs, "id", ["x1", "x2"], [7], n_init=4, tol=0.0, max_iter=1)
    assert not all(r.converged for r in runs)
    assert kmeans.centers_table(spark, runs).where("not converged").count() > 0


def test_drawn_rows_follow_the_recursion(spark):
    """Starts against plain numpy, with the same hashed numbers."""
    df = spark.range(200).select("id", uniform("id", "p", 0, 9).alias("a"), uniform("id", "q", 0, 9).alias("b"))
    u = {(s, t): uniform("id", f"7/{s}/{t}").alias(f"u{s}_{t}") for s in range(2) for t in range(1, kmeans.ROUNDS + 1)}
    first = [hash52("id", f"7/{s}/0").alias(f"h{s}") for s in range(2)]
    rows = df.select("*", *u.values(), *first).orderBy("id").collect()
    x = np.array([[r["a"], r["b"]] for r in rows])
    found = kmeans._drawn_rows(kmeans.complete_points(df.repartition(3), "id", ["a", "b"]), 2, 6, 7)
    for s in range(2):
        drawn = [int(np.argmin([r[f"h{s}"] for r in rows]))]
        for t in range(1, kmeans.ROUNDS + 1):
            d2 = ((x[:, None] - x[drawn][None]) ** 2).sum(axis=2).min(axis=1)
            chance = [-np.log(r[f"u{s}_{t}"]) / d if d > 0 else np.inf for r, d in zip(rows, d2)]
            drawn += np.argsort(chance, kind="stable")[:6].tolist()
        assert np.allclose(found[s], x[drawn])


def test_rows_with_missing_values_have_no_cluster(spark):
    rows = [(0, 1.0, 2.0), (1, None, 2.0), (2, 1.0, float("nan")), (3, 8.0, 9.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    centers = np.array([[1.0, 2.0], [8.0, 9.0]])
    vectors = df.select("id", F.when(F.col("id") != 3, F.array("a", "b")).alias("v"))
    for table, features, last in ((df, ["a", "b"], (1, 0.0)), (vectors, "v", (None, None))):
        found = {r["id"]: (r["cluster"], r["d2"]) for r in kmeans.assign(table, features, centers).collect()}
        assert found == {0: (0, 0.0), 1: (None, None), 2: (None, None), 3: last}


def test_empty_cluster_keeps_its_centre():
    run = kmeans.KMeansRun(0, 2, np.array([[0.0], [9.0]]), np.zeros(2), 0.0, 0)
    kmeans._update(run, {(0, 0): np.array([2.0, 0.0, 4.0]), (0, 1): np.array([0.0, 0.0, 0.0])})
    assert run.centers.tolist() == [[2.0], [9.0]]


def test_inline_and_vector_assignment_agree(spark, blobs):
    centers = np.array([[0.0, 0.0], [1.0, 1.0], [-1.0, 0.5]])
    a = kmeans.assign(blobs, ["x1", "x2"], centers).orderBy("id").collect()
    as_array = blobs.withColumn("v", F.array("x1", "x2"))
    b = kmeans.assign(as_array, "v", centers).orderBy("id").collect()
    assert [r["cluster"] for r in a] == [r["cluster"] for r in b]
    assert np.allclose([r["d2"] for r in a], [r["d2"] for r in b])


def test_nearest_centre_far_from_the_origin():
    centers = np.array([[1e9], [1e9 + 1]])
    label, d2 = kmeans.nearest_center(np.array([[1e9], [1e9 + 1], [1e9 + 0.9]]), centers)
    assert label.tolist() == [0, 1, 1]
    assert np.allclose(d2, [0.0, 0.0, 0.01], atol=1e-6)


def _peak(call) -> int:
    tracemalloc.start()
    try:
        call()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_nearest_centre_among_many_holds_few_scores():
    """10,000 rows against 4,001 centres: all scores together would be 320 MB."""
    draw = np.random.default_rng(3)
    x, centers = draw.normal(size=(10_000, 8)), draw.normal(size=(4_001, 8))
    assert _peak(lambda: kmeans.nearest_center(x, centers)) < 64e6
    near = ((x[:50, None] - centers[None]) ** 2).sum(axis=2)
    label, d2 = kmeans.nearest_center(x[:50], centers)
    assert (label == near.argmin(axis=1)).all() and np.allclose(d2, near.min(axis=1))
    few = kmeans.nearest_center(x[:50], centers[:20])[0]
    assert (few == near[:, :20].argmin(axis=1)).all()


def test_sums_of_a_batch_hold_no_table_of_members(spark):
    run = kmeans.KMeansRun(0, 3, np.array([[0.0], [5.0], [9.0]]), np.zeros(3), 0.0, 0)
    rows = spark.range(10).select(F.array(F.col("id").cast("double")).alias("x"))
    sums = kmeans._partial_sums(rows, [run], 1)
    assert sum(v[0] for v in sums.values()) == 10 and sum(v[2] for v in sums.values()) == 45
    quick = kmeans._partial_sums(rows, [run], 1, errors=False)
    assert all(q[0] == sums[key][0] and q[1] == 0 and q[2] == sums[key][2] for key, q in quick.items())


def test_distances_of_near_copies_hold_few_pairs():
    """All pairs of a block are close: their differences together would be 256 MB."""
    points = 1000.0 + np.random.default_rng(4).normal(size=(1_000, 32)) * 1e-4
    assert _peak(lambda: linkage._distances(points, points)) < 96e6
    expected = np.sqrt(((points[:9, None] - points[None]) ** 2).sum(axis=2))
    assert np.allclose(linkage._distances(points[:9], points), expected, rtol=1e-9, atol=0)


def test_rows_of_one_file_are_dealt_to_all_cores(spark):
    rows = spark.range(25_000).coalesce(1).select("id", F.array(F.col("id").cast("double")).alias("x")).cache()
    dealt = kmeans._dealt(rows, 25_000, 1)
    assert dealt.rdd.getNumPartitions() == 3 and dealt.agg(F.sum("id")).first()[0] == 25_000 * 24_999 // 2
    dealt.unpersist()
    assert kmeans._dealt(rows, 9_000, 1) is rows
    rows.unpersist()
