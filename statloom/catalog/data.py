"""Sources, reshaping, feature preparation and splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import hash52, normal, uniform
from ..functions.numeric import argmax, relu, threshold
from ..operators import prepare, reshape, split
from ..operators.validation import k_fold_cv
from ..plans.order_stats import quantiles
from ..sources import generate, grid
from ..sources.tables import load, table_from_columns
from . import oracle as o
from .registry import query, rounded

# ---- sources -------------------------------------------------------------------------------


@query("load_table", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def _(spark, d):
    return reshape.select_columns(load(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])


# A small table of segment weights.
SEGMENTS = {
    "segment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "weight": [1.0, 2.0, 3.0, 4.0, 5.0],
}


@query(
    "table_from_columns",
    """select c_mktsegment as segment, weight, count(*) as n from customer
       join (values ('AUTOMOBILE', 1e0), ('BUILDING', 2e0), ('FURNITURE', 3e0), ('HOUSEHOLD', 4e0), ('MACHINERY', 5e0))
         as w(segment, weight) on c_mktsegment = segment group by all""",
)
def _(spark, d):
    weights = table_from_columns(spark, SEGMENTS, "segment string, weight double")
    customers = load(spark, d, "customer").select(F.col("c_mktsegment").alias("segment"))
    counts = customers.groupBy("segment").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(weights), "segment").select("segment", "weight", "n")


@query("uniform_column", f"select c_custkey, {o.rnd(o.uniform('c_custkey', 42, 10, 300), 9)} as u from customer")
def _(spark, d):
    return rounded(load(spark, d, "customer").select("c_custkey", uniform("c_custkey", 42, 10, 300).alias("u")), 9)


@query("normal_column", f"select event_id, {o.rnd(o.normal('event_id', 42, 5000, 1500))} as z from events")
def _(spark, d):
    return rounded(load(spark, d, "events").select("event_id", normal("event_id", 42, 5000, 1500).alias("z")))


# Centres of the sample clusters.
CENTERS = [(-2.5, 9.0), (4.5, 2.0), (-6.5, -7.0)]


def blob_sql(table="customer", id_col="c_custkey") -> str:
    def at(d):
        cases = " ".join(f"when {i} then {o.num(c[d])}" for i, c in enumerate(CENTERS))
        return f"case {id_col} % 3 {cases} end + {o.normal(id_col, f'42/x{d + 1}')}"

    return f"select {id_col} as id, cast({id_col} % 3 as integer) as true_cluster, {at(0)} as x1, {at(1)} as x2 from {table}"


def blob_table(spark, d):
    ids = load(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    return generate.blobs(ids, "id", CENTERS)


@query("gaussian_blobs", f"select id, true_cluster, {o.rnd('x1')} as x1, {o.rnd('x2')} as x2 from ({blob_sql()})")
def _(spark, d):
    return rounded(blob_table(spark, d))


# Formula of each sample's target in terms of its features.
FORMULAS = {
    "education_1d": "2000e0 + 50e0 * x + 15e0 * x * x",
    "education_2d": "1000e0 + 150e0 * x1 + 200e0 * x2 + 8e0 * x1 * x1 - 4e0 * x2 * x2 + 10e0 * x1 * x2",
    "tv_sales": "5e0 + 0.05e0 * tv",
    "tv_radio_sales": "5e0 + 0.05e0 * tv + 0.15e0 * radio",
    "cosine": "cos(9.42477796076938e0 * x)",
    "cars_linear": "50e0 - 0.2e0 * horsepower",
    "cars_quadratic": "50e0 - 0.2e0 * horsepower + 0.001e0 * horsepower * horsepower",
    "line": "2e0 * x + 1e0",
}


def sample_sql(name: str, table="customer", id_col="c_custkey") -> str:
    return o.sample(table, id_col, generate.RANGES[name], FORMULAS[name], generate.NOISE[name])


def sample_table(spark, d, name: str, table="customer", id_col="c_custkey"):
    ids = load(spark, d, table).select(F.col(id_col).alias("id"))
    return generate.sample_data(ids, "id", name)


def _formula_query(name: str) -> None:
    columns = [*generate.RANGES[name], "y"]
    text = ", ".join(f"{o.rnd(c)} as {c}" for c in columns)

    @query(f"formula_target_{name}", f"select id, {text} from ({sample_sql(name)})")
    def _(spark, d):
        return rounded(sample_table(spark, d, name))


for _name in FORMULAS:
    _formula_query(_name)


@query(
    "credit_classes",
    f"""select id, defaulted, {o.rnd('income')} as income, {o.rnd('balance')} as balance,
        case when defaulted = 1 then '1: Default' else '0: No Default' end as status
        from ({o.credit('customer', 'c_custkey')})""",
)
def _(spark, d):
    ids = load(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    return rounded(generate.credit_data(ids, "id").select("id", "defaulted", "income", "balance", "status"))


@query(
    "linspace_grid",
    f"""select i as id, {o.rnd('lo + i * (hi - lo) / 99e0')} as x
        from (select min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem), range(100) t(i)""",
)
def _(spark, d):
    return rounded(grid.data_line(load(spark, d, "lineitem"), "l_extendedprice", 100))


@query(
    "mesh_grid",
    f"""select j * 20 + i as id, {o.rnd('a0 + i * (a1 - a0) / 19e0')} as p_size, {o.rnd('b0 + j * (b1 - b0) / 19e0')} as p_retailprice
        from (select min(p_size) as a0, max(p_size) as a1, min(p_retailprice) as b0, max(p_retailprice) as b1 from part),
        range(20) t(i), range(20) u(j)""",
)
def _(spark, d):
    return rounded(grid.data_mesh(load(spark, d, "part"), ["p_size", "p_retailprice"], 20))


# ---- reshaping -----------------------------------------------------------------------------


@query("select_features", "select l_quantity, l_extendedprice, l_discount as y from lineitem")
def _(spark, d):
    rows = reshape.select_columns(load(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return rows.withColumnRenamed("l_discount", "y")


@query("first_rows", "select c_custkey, c_name, c_acctbal from customer order by c_custkey limit 5")
def _(spark, d):
    return reshape.first_rows(load(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), "c_custkey", 5)


@query(
    "map_codes",
    """select o_orderkey, case o_orderstatus when 'O' then 'open' when 'F' then 'finished' end as status_label from orders""",
)
def _(spark, d):
    rows = reshape.map_codes(load(spark, d, "orders"), "o_orderstatus", {"O": "open", "F": "finished"}, "status_label")
    return rows.select("o_orderkey", "status_label")


@query(
    "stack_rows",
    """select c_custkey as id, c_acctbal as balance, 0 as is_supplier from customer
       union all select s_suppkey, s_acctbal, 1 from supplier""",
)
def _(spark, d):
    a = load(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.lit(0).alias("is_supplier"))
    b = load(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"), F.lit(1).alias("is_supplier"))
    return reshape.stack_rows([a, b])


@query(
    "join_columns",
    """select doc_id, n_chars, quality, toxic from documents join labels using (doc_id)""",
)
def _(spark, d):
    documents = load(spark, d, "documents").select("doc_id", "n_chars")
    return reshape.join_columns(documents, load(spark, d, "labels"), "doc_id").select("doc_id", "n_chars", "quality", "toxic")


@query(
    "flatten_arrays",
    f"""select vec_id, cast(pos - 1 as integer) as pos, {o.rnd('cast(embedding[pos] as double)', 7)} as value
        from embeddings, range(1, 65) t(pos)""",
)
def _(spark, d):
    rows = reshape.explode_array(load(spark, d, "embeddings"), "vec_id", "embedding")
    return rounded(rows, 7)


@query(
    "flatten_grid",
    f"""select o_orderkey, cast(pos as integer) as pos, {o.rnd('case pos when 0 then 1e0 when 1 then o_totalprice else o_totalprice / 2e0 end', 4)} as value
        from orders, range(3) t(pos)""",
)
def _(spark, d):
    x = F.col("o_totalprice")
    rows = load(spark, d, "orders").select("o_orderkey", F.array(F.array(F.lit(1.0), x), F.array(x / 2.0)).alias("cells"))
    return rounded(reshape.explode_array(reshape.flatten_nested(rows, "cells"), "o_orderkey", "cells"), 4)


@query("sort_values", "select c_custkey, c_acctbal from customer order by c_acctbal, c_custkey")
def _(spark, d):
    return reshape.sort_values(load(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey")


@query(
    "best_degree",
    f"""with m as (select p_size as degree, avg((p_retailprice - 1000e0) * (p_retailprice - 1000e0)) as mse from part group by p_size)
        select degree, {o.rnd('mse', 4)} as mse from m order by m.mse, degree limit 1""",
)
def _(spark, d):
    gap = F.col("p_retailprice") - 1000.0
    metrics = load(spark, d, "part").groupBy(F.col("p_size").alias("degree")).agg(F.avg(gap * gap).alias("mse"))
    return rounded(reshape.best_row(metrics, "degree", "mse"), 4)


@query(
    "argmax_class",
    """select vec_id, cast(list_position(embedding, list_max(embedding)) - 1 as integer) as best from embeddings""",
)
def _(spark, d):
    return load(spark, d, "embeddings").select("vec_id", argmax(F.col("embedding")).alias("best"))


@query(
    "argmax_class_with_gaps",
    """select vec_id, case when vec_id % 5 > 1 then cast(list_position(embedding, list_max(embedding)) - 1 as integer) end as best from embeddings""",
)
def _(spark, d):
    """A vector with a NaN and one with a NULL component have no class."""
    scores = F.transform("embedding", lambda v, i: F.when((F.col("vec_id") % 5 == 0) & (i == 3), F.lit(float("nan"))).when((F.col("vec_id") % 5 != 1) | (i != 60), v))
    return load(spark, d, "embeddings").select("vec_id", argmax(scores).alias("best"))


@query("threshold_class", "select event_id, case when value >= 0.5e0 then 1 else 0 end as predicted from events")
def _(spark, d):
    return load(spark, d, "events").select("event_id", threshold(F.col("value")).alias("predicted"))


@query("clip_negative", "select c_custkey, greatest(0e0, c_acctbal) as clipped from customer")
def _(spark, d):
    return load(spark, d, "customer").select("c_custkey", relu(F.col("c_acctbal")).alias("clipped"))


@query(
    "shuffle_rows",
    f"""select c_custkey, e as epoch, {o.h52_col('c_custkey', "'42/' || cast(e as varchar)")} as place
        from customer, range(1, 3) t(e)""",
)
def _(spark, d):
    rows = load(spark, d, "customer").select("c_custkey")
    epochs = [
        split.shuffle_rows(rows, "c_custkey", 42, e).select("c_custkey", F.lit(e).cast("bigint").alias("epoch"), hash52("c_custkey", f"42/{e}").alias("place"))
        for e in (1, 2)
    ]
    return reshape.stack_rows(epochs)


@query(
    "shuffle_positions",
    f"""select c_custkey, cast(e as integer) as epoch, row_number() over (partition by e order by {o.h52_col('c_custkey', "'42/' || cast(e as varchar)")}, c_custkey) - 1 as position
        from customer, range(1, 4) t(e)""",
)
def _(spark, d):
    return split.shuffle_positions(load(spark, d, "customer").select("c_custkey"), "c_custkey", 42, [1, 2, 3])


@query("shuffle_in_partitions", "select c_custkey from customer")
def _(spark, d):
    rows = load(spark, d, "customer").select("c_custkey").repartition(8, "c_custkey")
    return split.shuffle_in_partitions(rows, "c_custkey", 42, 1)


@query(
    "pick_row",
    f"select event_id, event_type, value from events order by {o.h52('event_id', 7)}, event_id limit 1",
)
def _(spark, d):
    return split.pick_row(load(spark, d, "events").select("event_id", "event_type", "value"), "event_id", 7)


# ---- feature preparation -------------------------------------------------------------------


@query(
    "standardize",
    f"""select c_custkey, {o.rnd('(c_acctbal - avg(c_acctbal) over ()) / stddev_pop(c_acctbal) over ()')} as c_acctbal from customer""",
)
def _(spark, d):
    rows = load(spark, d, "customer").select("c_custkey", "c_acctbal")
    return rounded(prepare.standardize(rows, ["c_acctbal"]))


@query(
    "polynomial_features",
    """select p_partkey, 1e0 as poly_0_0, a as poly_1_0, b as poly_0_1, a * a as poly_2_0, a * b as poly_1_1, b * b as poly_0_2
       from (select p_partkey, cast(p_size as double) as a, cast(p_partkey % 7 as double) as b from part)""",
)
def _(spark, d):
    rows = load(spark, d, "part").select("p_partkey", F.col("p_size").alias("a"), (F.col("p_partkey") % 7).alias("b"))
    return prepare.polynomial_features(rows, ["a", "b"], 2).drop("a", "b")


@query(
    "standardize_train_test",
    f"""with s as ({o.split('select c_custkey, c_acctbal from customer', 'c_custkey', 0.2, 42)}),
        f as (select avg(c_acctbal) as m, stddev_pop(c_acctbal) as sd from s where not is_test)
        select c_custkey, is_test, {o.rnd('(c_acctbal - m) / sd')} as c_acctbal from s, f""",
)
def _(spark, d):
    rows = split.train_test_split(load(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_custkey", 0.2, 42)
    scaler = prepare.fit_scaler(rows, ["c_acctbal"], only=~F.col("is_test"))
    return rounded(scaler.transform(rows))


@query(
    "normalize_pixels",
    f"""select vec_id, cast(pos - 1 as integer) as pos, {o.rnd('(cast(embedding[pos] as double) - 0.1307e0) / 0.3081e0')} as pixel
        from (select vec_id, embedding, unnest(range(1, len(embedding) + 1)) as pos from embeddings)""",
)
def _(spark, d):
    rows = prepare.scale_pixels(load(spark, d, "embeddings"), "embedding", PIXEL_MEAN, PIXEL_SD)
    return rounded(rows.select("vec_id", F.posexplode("embedding").alias("pos", "pixel")))


# Mean and standard deviation of image pixels.
PIXEL_MEAN, PIXEL_SD = 0.1307, 0.3081

# ---- missing values and outliers -----------------------------------------------------------

EVENTS_WITH_GAPS = "select event_id, case when event_type = 'click' then null else value end as value from events"


def _events_with_gaps(spark, d):
    return load(spark, d, "events").select("event_id", F.when(F.col("event_type") != "click", F.col("value")).alias("value"))


@query("drop_missing", f"select event_id, value from ({EVENTS_WITH_GAPS}) where value is not null")
def _(spark, d):
    return prepare.drop_missing(_events_with_gaps(spark, d), ["value"])


@query(
    "fill_missing_mean",
    f"select event_id, {o.rnd('coalesce(value, avg(value) over ())')} as value from ({EVENTS_WITH_GAPS})",
)
def _(spark, d):
    return rounded(prepare.fill_missing(_events_with_gaps(spark, d), ["value"], "mean"))


@query(
    "fill_missing_median",
    f"""with e as ({EVENTS_WITH_GAPS}), m as (select quantile_cont(value, 0.5) as q from e)
        select event_id, {o.rnd('coalesce(value, q)')} as value from e, m""",
)
def _(spark, d):
    return rounded(prepare.fill_missing(_events_with_gaps(spark, d), ["value"], "median"))


@query(
    "outlier_filter",
    """with q as (select quantile_cont(value, 0.25) as a, quantile_cont(value, 0.75) as b from events)
       select event_id, value from events, q where value between a - 1.5e0 * (b - a) and b + 1.5e0 * (b - a)""",
)
def _(spark, d):
    return prepare.iqr_filter(load(spark, d, "events").select("event_id", "value"), "value")


# ---- splitting -----------------------------------------------------------------------------


@query("train_test_split", o.split("select event_id from events", "event_id", 0.2, 42))
def _(spark, d):
    return split.train_test_split(load(spark, d, "events").select("event_id"), "event_id", 0.2, 42)


@query(
    "repeated_split",
    f"""select cast(s as integer) as seed, c_custkey,
          row_number() over (partition by s order by h, c_custkey) <= ceil(count(*) over (partition by s) * 0.5e0) as is_test
        from (select s, c_custkey, {o.h52_col('c_custkey', 's')} as h from customer, range(10) t(s))""",
)
def _(spark, d):
    return split.repeated_split(load(spark, d, "customer"), "c_custkey", 0.5, list(range(10)))


@query("k_fold", o.folds("select c_custkey from customer", "c_custkey", 10, 42))
def _(spark, d):
    return split.k_fold(load(spark, d, "customer").select("c_custkey"), "c_custkey", 10, 42)


@query(
    "k_fold_sizes",
    f"select fold, count(*) as n from ({o.folds('select event_id from events', 'event_id', 7, 3)}) group by fold",
)
def _(spark, d):
    rows = split.k_fold(load(spark, d, "events").select("event_id"), "event_id", 7, 3)
    return rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query("leave_one_out", "select c_custkey, c_custkey as fold from customer")
def _(spark, d):
    return split.leave_one_out(load(spark, d, "customer").select("c_custkey"), "c_custkey")


@query(
    "mini_batches",
    f"""select event_id, (row_number() over (order by {o.h52('event_id', 42)}, event_id) - 1) // 128 as batch from events""",
)
def _(spark, d):
    return split.mini_batches(load(spark, d, "events").select("event_id"), "event_id", 128, 42)


@query(
    "mini_batches_in_order",
    "select event_id, (row_number() over (order by event_id) - 1) // 128 as batch from events",
)
def _(spark, d):
    return split.mini_batches(load(spark, d, "events").select("event_id"), "event_id", 128, 42, shuffle=False)


# ---- the whole path ------------------------------------------------------------------------

FLAGSHIP_SQL = f"select id, x, 5e0 + 0.05e0 * x + {o.normal('id', '42/noise', 0, 2.5)} as y from (select c_custkey as id, (c_acctbal - avg(c_acctbal) over ()) / stddev_pop(c_acctbal) over () as x from customer)"


def flagship(spark, d):
    """Standardise a column, draw a noisy target over it, and cross-validate the line in ten folds."""
    rows = load(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("x"))
    scaled = prepare.standardize(rows, ["x"])
    data = scaled.withColumn("y", 5.0 + 0.05 * F.col("x") + normal("id", "42/noise", 0, 2.5))
    return rounded(k_fold_cv(data, "id", ["x"], "y", (1,), 10, 42))


query(
    "standardize_and_cross_validate",
    f"""with p as ({o.folds(FLAGSHIP_SQL, 'id', 10, 42)}),
        f as (select k, regr_slope(y, x) as b, regr_intercept(y, x) as a from p, range(10) t(k) where fold <> k group by k),
        e as (select k, avg((y - a - b * x) * (y - a - b * x)) as mse from p join f on fold = k group by k)
        select 1 as degree, count(*) as folds, {o.rnd('avg(mse)')} as mse from e""",
)(flagship)


@query(
    "median_value",
    f"select {o.rnd('quantile_cont(l_extendedprice, 0.5)', 4)} as median from lineitem",
)
def _(spark, d):
    _, found = quantiles(load(spark, d, "lineitem"), F.col("l_extendedprice"), [0.5])
    return rounded(spark.createDataFrame([(found[0][0],)], "median double"), 4)
