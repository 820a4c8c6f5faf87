"""K-means and agglomerative clustering."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.hashing import uniform
from ..operators import kmeans, linkage, prepare
from ..sources.tables import load
from . import oracle as o
from .data import blob_sql, blob_table
from .registry import query, rounded

SCALED_SQL = f"""select id, (x1 - avg(x1) over ()) / stddev_pop(x1) over () as x1,
  (x2 - avg(x2) over ()) / stddev_pop(x2) over () as x2, true_cluster from ({blob_sql()})"""


def scaled_blobs(spark, d):
    return prepare.standardize(blob_table(spark, d), ["x1", "x2"])


def lloyd_ctes(steps: int = 8) -> str:
    """Plain Lloyd steps from the true group means; on separated groups these reach the best fit."""
    ctes = [
        f"p as materialized ({SCALED_SQL})",
        "c0 as materialized (select true_cluster as c, avg(x1) as a, avg(x2) as b from p group by true_cluster)",
    ]
    for s in range(steps):
        ctes.append(f"""c{s + 1} as materialized (select c, avg(x1) as a, avg(x2) as b from
          (select p.id, x1, x2, min_by(c, pow(x1 - a, 2) + pow(x2 - b, 2)) as c from p, c{s} group by all) group by c)""")
    ctes.append(f"""l as materialized (select p.id, x1, x2, min_by(k.r, pow(x1 - a, 2) + pow(x2 - b, 2)) as cluster, min(pow(x1 - a, 2) + pow(x2 - b, 2)) as d2
      from p, (select *, cast(row_number() over (order by a, b) - 1 as integer) as r from c{steps}) k group by p.id, x1, x2)""")
    return ", ".join(ctes)


def _three_means(spark, d):
    rows = scaled_blobs(spark, d)
    return rows, kmeans.fit_kmeans(rows, "id", ["x1", "x2"], 3, n_init=10, seed=42, tol=0.0)


@query(
    "kmeans_centers",
    f"with {lloyd_ctes()} select 3 as k, cluster, {o.rnd('avg(x1)')} as x1, {o.rnd('avg(x2)')} as x2, count(*) as n from l group by cluster",
)
def _(spark, d):
    _, fit = _three_means(spark, d)
    table = kmeans.centers_table(spark, [fit])
    return rounded(table.select("k", "cluster", F.col("center")[0].alias("x1"), F.col("center")[1].alias("x2"), "n"))


@query("kmeans_labels", f"with {lloyd_ctes()} select id, cluster, {o.rnd('d2')} as d2 from l")
def _(spark, d):
    rows, fit = _three_means(spark, d)
    return rounded(kmeans.assign(rows, ["x1", "x2"], fit.centers).select("id", "cluster", "d2"))


@query("kmeans_inertia", f"with {lloyd_ctes()} select {o.rnd('sum(d2)', 4)} as inertia from l")
def _(spark, d):
    rows, fit = _three_means(spark, d)
    return rounded(kmeans.inertia(kmeans.assign(rows, ["x1", "x2"], fit.centers)), 4)


@query("elbow_single_cluster", f"select 1 as k, {o.rnd('sum(x1 * x1 + x2 * x2)', 4)} as wcss, true as converged from ({SCALED_SQL})")
def _(spark, d):
    return rounded(kmeans.elbow(scaled_blobs(spark, d), "id", ["x1", "x2"], [1]), 4)


STEPS = 60


def _kmeans_sql(points: str, width: int, ks: list[int], starts: int) -> str:
    return o.kmeans(points, width, ks, starts, 42, STEPS, kmeans.ROUNDS, kmeans.DRAWN)


@query(
    "elbow_table",
    f"""with {_kmeans_sql(f"select id, x1, x2 from ({SCALED_SQL})", 2, list(range(1, 11)), 10)}
        select k, {o.rnd('inertia')} as wcss, not moved as converged from best_ join moved_ using (k, s)""",
)
def _(spark, d):
    return rounded(kmeans.elbow(scaled_blobs(spark, d), "id", ["x1", "x2"], list(range(1, 11)), max_iter=STEPS, tol=0.0))


LABEL_MEANS = "select label as c, pos, avg(embedding[pos]) as m from embeddings, range(1, 65) t(pos) group by all"
EMBEDDING_DISTANCES = f"""select e.vec_id, m.c, sum(pow(cast(e.embedding[m.pos] as double) - m.m, 2)) as d2
  from embeddings e, ({LABEL_MEANS}) m group by all"""


def label_means(spark, d):
    """Mean vector per label: the starting centres of a step on the embeddings."""
    long = load(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("pos", "value"))
    means = long.groupBy("label", "pos").agg(F.avg(F.col("value").cast("double")).alias("m")).collect()
    labels, width = sorted({r["label"] for r in means}), max(r["pos"] for r in means) + 1
    centers = np.zeros((len(labels), width))
    for r in means:
        centers[labels.index(r["label"]), r["pos"]] = r["m"]
    return labels, centers


@query(
    "nearest_centroid",
    f"select vec_id, cast(min_by(c, d2) as integer) as cluster, {o.rnd('min(d2)')} as d2 from ({EMBEDDING_DISTANCES}) group by vec_id",
)
def _(spark, d):
    _, centers = label_means(spark, d)
    return rounded(kmeans.assign(load(spark, d, "embeddings"), "embedding", centers).select("vec_id", "cluster", "d2"))


# Starting centres of one update step.
START = np.array([[-1.0, 1.0], [1.0, 0.0], [0.0, -1.0]])


@query(
    "centroid_update",
    f"""with p as ({SCALED_SQL}), k(c, a, b) as (values (0, -1e0, 1e0), (1, 1e0, 0e0), (2, 0e0, -1e0)),
        l as (select p.id, x1, x2, min_by(c, pow(x1 - a, 2) + pow(x2 - b, 2)) as cluster from p, k group by p.id, x1, x2)
        select cluster, count(*) as n, {o.rnd('avg(x1)')} as x1, {o.rnd('avg(x2)')} as x2 from l group by cluster""",
)
def _(spark, d):
    assigned = kmeans.assign(scaled_blobs(spark, d), ["x1", "x2"], START)
    return rounded(kmeans.update_centers(assigned, ["x1", "x2"]))


EMBEDDING_COLUMNS = ", ".join(f"cast(embedding[{i}] as double) as x{i}" for i in range(1, 65))


@query(
    "kmeans_embeddings",
    f"""with {_kmeans_sql(f"select vec_id as id, {EMBEDDING_COLUMNS} from embeddings", 64, [10], 3)},
        named as (select c, cast(row_number() over (order by {', '.join(f'x{i}' for i in range(1, 65))}) - 1 as integer) as cluster from fit_ join best_ using (s, k))
        select cluster, label, count(*) as n from near_ join named using (c) join embeddings on vec_id = id group by all""",
)
def _(spark, d):
    rows = load(spark, d, "embeddings")
    fit = kmeans.fit_kmeans(rows, "vec_id", "embedding", 10, n_init=3, seed=42, max_iter=STEPS, tol=0.0)
    assigned = kmeans.assign(rows.select("vec_id", "label", "embedding"), "embedding", fit.centers)
    return assigned.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))


WITH_GAPS = "case when c_custkey % 7 = 0 then null else c_acctbal end as a, case when c_custkey % 11 = 0 then 'nan'::double else cast(c_nationkey as double) end as b"


@query(
    "nearest_centroid_with_gaps",
    f"""select c_custkey, case when whole then cast(if(d0 <= d1, 0, 1) as integer) end as cluster, case when whole then {o.rnd('least(d0, d1)')} end as d2
        from (select c_custkey, a is not null and not isnan(b) as whole, pow(a - 1000e0, 2) + pow(b - 5e0, 2) as d0, pow(a - 7000e0, 2) + pow(b - 15e0, 2) as d1
              from (select c_custkey, {WITH_GAPS} from customer))""",
)
def _(spark, d):
    rows = load(spark, d, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("a"),
        F.when(F.col("c_custkey") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("c_nationkey").cast("double")).alias("b"),
    )
    found = kmeans.assign(rows, ["a", "b"], np.array([[1000.0, 5.0], [7000.0, 15.0]]))
    return rounded(found.select("c_custkey", "cluster", "d2"))


# ---- agglomerative -------------------------------------------------------------------------


def serial_merges(pairs: str, method: str) -> str:
    """One merge per step over a table of all pairs: i < j and their distance d in, merge table out."""
    update = {
        "average": "sum(d * ni * nj) / sum(ni * nj)",
        "single": "min(d)",
        "complete": "max(d)",
        "ward": f"""case when count(*) = 2 then sqrt((sum((case when i2 = a then ni + nj else nj + ni end) * d * d)
          - any_value(case when i2 = a then nj else ni end) * any_value(dab) * any_value(dab))
          / (sum(case when i2 = a then ni else nj end) + any_value(case when i2 = a then nj else ni end))) else any_value(d) end""",
    }[method]
    return f"""with recursive p as materialized ({pairs}),
      r(step, i, j, d, ni, nj) as (
        select 1, i, j, d, 1::bigint, 1::bigint from p
        union all
        select step + 1, i2, j2, d, ni, nj from (
          select any_value(step) as step, i2, j2, {update} as d,
            cast(case when i2 = a then sum(ni) else any_value(ni) end as bigint) as ni,
            cast(case when j2 = a then sum(nj) else any_value(nj) end as bigint) as nj
          from (select step, a, dab, d, least(i1, j1) as i2, greatest(i1, j1) as j2,
                  case when i1 < j1 then ni else nj end as ni, case when i1 < j1 then nj else ni end as nj
                from (select *, case when i = b then a else i end as i1, case when j = b then a else j end as j1
                      from (select *, first_value(i) over w as a, first_value(j) over w as b, first_value(d) over w as dab
                            from r window w as (order by d, i, j))))
          where i2 <> j2 group by i2, j2, a)),
      m as (select step, arg_min(i, (d, i, j)) as i, arg_min(j, (d, i, j)) as j, min(d) as d, arg_min(ni + nj, (d, i, j)) as n from r group by step)
      select step, i as left, j as right, {o.rnd('d')} as height, n as size, true as exact from m"""


def top_levels_sql(pairs: str) -> str:
    """Depth of every merge below the root, by following each merge to the one that uses it."""
    return f"""with recursive t as materialized ({serial_merges(pairs, 'average')}),
  up as materialized (select a.step, min(b.step) as parent from t a left join t b on b.step > a.step and (b.left = a.left or b.right = a.left) group by a.step),
  deep as (select step, 0 as depth from up where parent is null union all select up.step, depth + 1 from up join deep on up.parent = deep.step),
  kids as (select t.step, t.height, t.size, coalesce(arg_max(u.size, u.step), 1) as left_size from t left join t u on u.step < t.step and u.left = t.left group by all)
  select step, depth, height, cast(left_size as bigint) as left_size, cast(size - left_size as bigint) as right_size from kids join deep using (step) where depth <= 5"""


def tree_cut_sql(pairs: str, ids: str, k: int = 3) -> str:
    """Labels after all but the last k - 1 merges: every id follows the merges of its name."""
    return f"""with recursive t as materialized ({serial_merges(pairs, 'average')}),
      kept as materialized (select * from t where step <= (select max(step) from t) - {k - 1}),
      root as (select id, id as name from ({ids})
        union all select root.id, kept.left from root join kept on kept.right = root.name)
      select id, cast(dense_rank() over (order by name) - 1 as integer) as cluster from (select id, min(name) as name from root group by id)"""


EMBEDDING_PAIRS = """select a.vec_id as i, b.vec_id as j, sqrt(sum(pow(cast(a.v as double) - cast(b.v as double), 2))) as d
  from (select vec_id, unnest(embedding) as v, unnest(range(64)) as pos from embeddings) a
  join (select vec_id, unnest(embedding) as v, unnest(range(64)) as pos from embeddings) b on a.pos = b.pos and a.vec_id < b.vec_id group by all"""


def _tree(spark, d, method: str):
    return linkage.fit_tree(load(spark, d, "embeddings"), "vec_id", "embedding", method)


def _linkage_query(method: str) -> None:
    @query(f"merge_table_{method}", serial_merges(EMBEDDING_PAIRS, method))
    def _(spark, d):
        return rounded(_tree(spark, d, method).merge_table(spark))


for _method in ("average", "single", "complete", "ward"):
    _linkage_query(_method)



SUPPLIER_POINTS = f"select s_suppkey as id, s_acctbal / 1000e0 as x1, {o.uniform('s_suppkey', 42, 0, 10)} as x2 from supplier"
SUPPLIERS = f"""select u.id as i, v.id as j, sqrt(pow(u.x1 - v.x1, 2) + pow(u.x2 - v.x2, 2)) as d
  from ({SUPPLIER_POINTS}) u join ({SUPPLIER_POINTS}) v on u.id < v.id"""


def _supplier_tree(spark, d, method: str = "average"):
    rows = load(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), (F.col("s_acctbal") / 1000).alias("x1"), uniform("s_suppkey", 42, 0, 10).alias("x2")
    )
    return rows, linkage.fit_tree(rows, "id", ["x1", "x2"], method)


def _supplier_query(method: str) -> None:
    @query(f"merge_table_suppliers_{method}", serial_merges(SUPPLIERS, method))
    def _(spark, d):
        return rounded(_supplier_tree(spark, d, method)[1].merge_table(spark))


for _method in ("average", "single", "complete", "ward"):
    _supplier_query(_method)


@query("merge_table_suppliers_top_levels", top_levels_sql(SUPPLIERS))
def _(spark, d):
    return rounded(_supplier_tree(spark, d)[1].top_levels(spark, 5))


@query(
    "tree_cut_suppliers",
    tree_cut_sql(SUPPLIERS, "select s_suppkey as id from supplier"),
)
def _(spark, d):
    rows, tree = _supplier_tree(spark, d)
    return tree.assign(rows, ["x1", "x2"], 3).select("id", "cluster")


SPANNING_TREE = """with recursive x as (select vec_id, unnest(embedding) as v, unnest(range(64)) as pos from embeddings),
  e as materialized (select a.vec_id as i, b.vec_id as j, sqrt(sum(pow(cast(a.v as double) - cast(b.v as double), 2))) as d
    from x a join x b on a.pos = b.pos group by all),
  r(step, v, best, seen, picked) as (
    select 0, j, d, j = f, f from e, (select min(vec_id) as f from embeddings) where i = f
    union all
    select step + 1, v, least(best, d), seen or v = pick, pick
    from (select *, first_value(v) over (order by seen, best, v) as pick, bool_and(seen) over () as done from r) join e on i = pick and j = v
    where not done)
  select step, height from (select cast(row_number() over (order by best) as integer) as step, ROUNDED as height from
    (select s.step, min(s.best) as best from r s where not seen group by s.step))"""


@query("single_linkage_heights", SPANNING_TREE.replace("ROUNDED", o.rnd("best")))
def _(spark, d):
    return rounded(_tree(spark, d, "single").merge_table(spark).select("step", "height"))


@query("merge_table_top_levels", top_levels_sql(EMBEDDING_PAIRS))
def _(spark, d):
    return rounded(_tree(spark, d, "average").top_levels(spark, 5))


@query("tree_cut_labels", f"select id as vec_id, cluster from ({tree_cut_sql(EMBEDDING_PAIRS, 'select vec_id as id from embeddings')})")
def _(spark, d):
    rows = load(spark, d, "embeddings").select("vec_id", "embedding")
    tree = _tree(spark, d, "average")
    return tree.assign(rows, "embedding", 3).select("vec_id", "cluster")


@query("tree_cut_blobs", f"with {lloyd_ctes()} select id, cast(dense_rank() over (order by first) - 1 as integer) as cluster from (select id, min(id) over (partition by cluster) as first from l)")
def _(spark, d):
    rows = scaled_blobs(spark, d)
    tree = linkage.fit_tree(rows, "id", ["x1", "x2"], "average")
    return tree.assign(rows, ["x1", "x2"], 3).select("id", "cluster")
