"""Forward passes, training and comparison of small networks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.hashing import uniform
from ..functions.numeric import argmax, cross_entropy
from ..operators import kmeans, layers, metrics, network, training
from ..operators.prepare import scale_pixels
from ..operators.split import mini_batches, train_test_split
from ..session import new_shared_path
from ..sources import grid, models
from ..sources.tables import load
from . import oracle as o
from .clusters import EMBEDDING_DISTANCES, LABEL_MEANS, label_means
from .data import PIXEL_MEAN, PIXEL_SD, sample_sql, sample_table
from .registry import query, rounded

# Weights of the two example networks.
MARKETING = {
    "w1": [[0.05, -0.02, 0.08], [0.15, 0.30, -0.10]],
    "b1": [-5.0, -2.0, -10.0],
    "w2": [[1.2], [0.8], [2.5]],
    "b2": [5.0],
}
CALORIES = {
    "w1": [[0.8, -0.5, 1.2, -0.2]],
    "b1": [-0.5, 0.2, 0.1, 0.5],
    "w2": [[1.5, 0.8], [-1.0, -0.5], [0.7, 1.2], [-0.2, -0.1]],
    "b2": [0.0, 15.0],
}


def dense_sql(source: str, keep: str, inputs: list[str], w1, b1, w2, b2) -> str:
    """Two dense layers over a source query: z, h and out columns next to the kept ones."""
    z = ", ".join(
        " + ".join([o.num(b1[j])] + [f"{o.num(row[j])} * {c}" for row, c in zip(w1, inputs)]) + f" as z{j + 1}" for j in range(len(b1))
    )
    h = ", ".join(f"greatest(0e0, z{j + 1}) as h{j + 1}" for j in range(len(b1)))
    out = ", ".join(
        " + ".join([o.num(b2[k])] + [f"{o.num(row[k])} * h{j + 1}" for j, row in enumerate(w2)]) + f" as out{k + 1}" for k in range(len(b2))
    )
    return f"select *, {out} from (select *, {h} from (select {keep}, {z} from ({source})))"


def _shown(columns: list[str], digits: int = 6) -> str:
    return ", ".join(f"{o.rnd(c, digits)} as {c}" for c in columns)


MARKETING_COLUMNS = ["z1", "z2", "z3", "h1", "h2", "h3", "out1"]
LINEITEM = "select l_orderkey, l_linenumber, l_quantity * 6e0 as tv, l_discount * 500e0 as radio from lineitem"


@query(
    "two_input_network",
    f"""select l_orderkey, l_linenumber, {_shown(['tv', 'radio', 'out1'])} from ({dense_sql(LINEITEM, '*', ['tv', 'radio'], **MARKETING)})""",
)
def _(spark, d):
    rows = load(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") * 6.0).alias("tv"), (F.col("l_discount") * 500.0).alias("radio")
    )
    return rounded(network.dense_layers(rows, ["tv", "radio"], **MARKETING).select(*rows.columns, "out1"))


GRID_900 = """select j * 30 + i as id, i * (select max(l_quantity) * 6e0 from lineitem) / 29e0 as tv, j * (select max(l_discount) * 500e0 from lineitem) / 29e0 as radio
  from range(30) t(i), range(30) u(j)"""


@query(
    "two_input_network_surface",
    f"select id, {_shown(['tv', 'radio', *MARKETING_COLUMNS])} from ({dense_sql(GRID_900, '*', ['tv', 'radio'], **MARKETING)})",
)
def _(spark, d):
    top = load(spark, d, "lineitem").agg(F.max("l_quantity") * 6.0, F.max("l_discount") * 500.0).first()
    surface = grid.mesh(spark, {"tv": (0.0, top[0], 30), "radio": (0.0, top[1], 30)})
    return rounded(network.dense_layers(surface, ["tv", "radio"], **MARKETING))


ORDERS = "select o_orderkey, o_totalprice / 100000e0 as kcal from orders"
CALORIES_COLUMNS = ["kcal", "z1", "z2", "z3", "z4", "h1", "h2", "h3", "h4", "out1", "out2"]


@query(
    "two_output_network",
    # prices in cents give outputs of nine decimals, so a coarser rounding would sit on halves
    f"select o_orderkey, {_shown(CALORIES_COLUMNS, 10)} from ({dense_sql(ORDERS, '*', ['kcal'], **CALORIES)})",
)
def _(spark, d):
    rows = load(spark, d, "orders").select("o_orderkey", (F.col("o_totalprice") / 100000.0).alias("kcal"))
    return rounded(network.dense_layers(rows, ["kcal"], **CALORIES), 10)


# ---- gradient and descent ------------------------------------------------------------------

# Weights at which the gradient of the 1-5-1 network is taken.
POINT = {"w1": [0.5, -0.25, 1.0, -1.5, 0.125], "b1": 0.1, "w2": [1.0, 0.5, -0.75, 0.25, 2.0], "b2": -0.2}


def gradient_sql(source: str, w1, b1, w2, b2) -> str:
    inner = dense_sql(source, "*", ["x"], [w1], [b1] * 5, [[w] for w in w2], [b2])
    gap = "2e0 * (out1 - y)"
    through = [f"case when z{j + 1} > 0 then {gap} * {o.num(w2[j])} else 0e0 end" for j in range(5)]
    parts = ["avg((out1 - y) * (out1 - y)) as loss"]
    parts += [f"avg(({t}) * x) as w1_{j + 1}" for j, t in enumerate(through)]
    parts += [f"avg({' + '.join(through)}) as b1"]
    parts += [f"avg({gap} * h{j + 1}) as w2_{j + 1}" for j in range(5)] + [f"avg({gap}) as b2"]
    names = ["loss", *[f"w1_{j}" for j in range(1, 6)], "b1", *[f"w2_{j}" for j in range(1, 6)], "b2"]
    return f"select {_shown(names)} from (select {', '.join(parts)} from ({inner}))"


@query("network_gradient", gradient_sql(sample_sql("line"), **POINT))
def _(spark, d):
    return rounded(network.squared_loss_gradient(sample_table(spark, d, "line"), "x", "y", **POINT))


CURVE = layers.curve_fitter(5)
CURVE_START = layers.initial(CURVE, 42, "normal")


def descent_sql(source: str, epochs: int, size: int, rate: float) -> str:
    """Loss per epoch of sequential mini-batch descent: one recursion step per mini-batch."""
    names = [*[f"u{j}" for j in range(5)], "b", *[f"v{j}" for j in range(5)], "c"]
    start = ", ".join(f"{o.num(v)} as {n}" for v, n in zip(layers.flat(CURVE_START), names))
    h = [f"greatest(0e0, x * u{j} + b)" for j in range(5)]
    active = [f"(case when x * u{j} + b > 0 then 1e0 else 0e0 end)" for j in range(5)]
    gap = "(" + " + ".join([f"{h[j]} * v{j}" for j in range(5)]) + " + c - y)"
    slopes = [f"avg(2e0 * {gap} * v{j} * {active[j]} * x)" for j in range(5)]
    slopes.append("avg(2e0 * " + gap + " * (" + " + ".join(f"v{j} * {active[j]}" for j in range(5)) + "))")
    slopes += [f"avg(2e0 * {gap} * {h[j]})" for j in range(5)] + [f"avg(2e0 * {gap})"]
    moved = ", ".join(f"any_value({n}) - {o.num(rate)} * {g} as {n}" for n, g in zip(names, slopes))
    place = o.h52_col("id", "'42/' || cast(e as varchar)")
    return f"""with recursive p as materialized ({source}),
      q as materialized (select e, x, y, (row_number() over (partition by e order by {place}, id) - 1) // {size} as n from p, range(1, {epochs + 1}) t(e)),
      rows_ as materialized (select cast(dense_rank() over (order by e, n) - 1 as integer) as k, e, x, y from q),
      r as (select 0 as k, 0e0 as loss, cast(0 as bigint) as e, {start}
        union all select any_value(r.k) + 1, avg({gap} * {gap}), any_value(rows_.e), {moved} from r join rows_ on r.k = rows_.k group by r.k)
      select cast(e as integer) as epoch, count(*) as batches, {o.rnd('avg(loss)')} as loss from r where e > 0 group by e"""


@query("train_curve_network", descent_sql(sample_sql("line"), 20, 10, 0.005))
def _(spark, d):
    fitted = training.train(
        sample_table(spark, d, "line"), "id", ["x"], "y", CURVE, loss="squared", optimizer="sgd", rate=0.005,
        epochs=20, batch_size=10, seed=42, start=CURVE_START,
    )
    return rounded(fitted.history_table(spark))


# ---- classifiers over the embeddings -------------------------------------------------------


def _embedding_split(spark, d):
    rows = load(spark, d, "embeddings").select("vec_id", "embedding", "label")
    rows = scale_pixels(rows, "embedding", PIXEL_MEAN, PIXEL_SD)
    split = train_test_split(rows, "vec_id", 0.2, 42)
    return split.where(~F.col("is_test")), split.where("is_test")


def _classifiers(spark, d) -> dict:
    """Layers for the width of the vectors in the table, read as a square image for the second."""
    width = load(spark, d, "embeddings").agg(F.max(F.size("embedding"))).first()[0]
    side = int(round(width**0.5))
    return {"fully_connected": layers.fully_connected(width, 10), "convolutional": layers.convolutional(side, side, 10)}


@query(
    "count_parameters",
    """select 'fully_connected' as model, cast(w * 256 + 256 + 256 * 128 + 128 + 128 * 10 + 10 as bigint) as parameters from (select any_value(len(embedding)) as w from embeddings)
       union all select 'convolutional', cast(9 * 16 + 16 + 9 * 16 * 32 + 32 + 32 * (w // 16) * 128 + 128 + 128 * 10 + 10 as bigint) from (select any_value(len(embedding)) as w from embeddings)""",
)
def _(spark, d):
    parts = [
        training.Network(spec, layers.initial(spec, 42)).weight_table(spark).agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("parameters"))
        for name, spec in _classifiers(spark, d).items()
    ]
    return parts[0].unionByName(parts[1])


@query("train_and_compare_classifiers")
def _(spark, d):
    train_rows, test_rows = _embedding_split(spark, d)
    rows = [
        training.train_and_evaluate(name, spec, train_rows, test_rows, "vec_id", "embedding", "label", epochs=5, batch_size=256, rate=0.001, seed=42)[1]
        for name, spec in _classifiers(spark, d).items()
    ]
    return training.comparison_table(spark, rows)


@query("classifier_loss_history")
def _(spark, d):
    train_rows, _ = _embedding_split(spark, d)
    fitted = training.train(train_rows, "vec_id", "embedding", "label", _classifiers(spark, d)["convolutional"], epochs=5, batch_size=256, seed=42)
    return rounded(fitted.history_table(spark))


@query(
    "trained_network_reload",
    "select cast(ceil(count(*) * 0.2e0) as bigint) as n, cast(0 as bigint) as different from embeddings",
)
def _(spark, d):
    """Rows scored differently by a trained network and by its stored copy."""
    train_rows, test_rows = _embedding_split(spark, d)
    spec = _classifiers(spark, d)["fully_connected"]
    fitted = training.train(train_rows, "vec_id", "embedding", "label", spec, epochs=2, batch_size=256, seed=42)
    path = new_shared_path(spark, "network")
    models.save_table(fitted.weight_table(spark), path, "network")
    reloaded = training.from_weight_table(models.load_table(spark, path, "network", training.WEIGHT_SCHEMA), spec)
    models.remove(spark, path)
    before = training.predict_class(fitted, test_rows, "embedding").select("vec_id", F.col("scores").alias("before"))
    after = training.predict_class(reloaded, test_rows, "embedding").select("vec_id", F.col("scores").alias("after"))
    both = before.join(after, "vec_id")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("before") != F.col("after"), 1)).alias("different"))


HIDDEN = 16


def _hashed_network(spark, width: int) -> training.Network:
    """Network whose weights are hashed numbers, so that SQL can state them too."""
    spec = (("dense", width, HIDDEN), ("relu",), ("dense", HIDDEN, 10))
    ids = spark.range(width * HIDDEN + HIDDEN * 10).select("id", uniform("id", "net", -0.5, 0.5).alias("w"))
    w = np.array([r["w"] for r in ids.orderBy("id").collect()])
    first, second = w[: width * HIDDEN].reshape(width, HIDDEN), w[width * HIDDEN :].reshape(HIDDEN, 10)
    return training.Network(spec, [first, np.zeros(HIDDEN), second, np.zeros(10)])


HASHED_SCORES = f"""hidden as materialized (select vec_id, label, j, greatest(0e0, sum(cast(embedding[i + 1] as double) * w)) as h
    from embeddings, (select i, j, {o.uniform(f'i * {HIDDEN} + j', 'net', -0.5, 0.5)} as w from range(64) t(i), range({HIDDEN}) u(j)) group by all),
  scored as materialized (select vec_id, label, c, sum(h * w) as s from hidden
    join (select j, c, {o.uniform(f'64 * {HIDDEN} + j * 10 + c', 'net', -0.5, 0.5)} as w from range({HIDDEN}) t(j), range(10) u(c)) using (j) group by all)"""


def _hashed_scored(spark, d):
    rows = load(spark, d, "embeddings").select("vec_id", "embedding", "label")
    return training.predict_class(_hashed_network(spark, 64), rows, "embedding")


@query(
    "wide_network_scores",
    f"with {HASHED_SCORES} select vec_id, cast(c as integer) as pos, {o.rnd('s')} as score from scored",
)
def _(spark, d):
    return rounded(_hashed_scored(spark, d).select("vec_id", F.posexplode("scores").alias("pos", "score")))


@query(
    "reloaded_network_scores",
    f"with {HASHED_SCORES} select vec_id, cast(c as integer) as pos, {o.rnd('s')} as score from scored",
)
def _(spark, d):
    """Scores of a network that was stored and read back, against SQL scores of its weights."""
    rows = load(spark, d, "embeddings")
    network_ = _hashed_network(spark, rows.agg(F.max(F.size("embedding"))).first()[0])
    path = new_shared_path(spark, "network")
    models.save_table(network_.weight_table(spark), path, "network")
    reloaded = training.from_weight_table(models.load_table(spark, path, "network", training.WEIGHT_SCHEMA), network_.layers)
    models.remove(spark, path)
    scored = training.predict_class(reloaded, rows, "embedding")
    return rounded(scored.select("vec_id", F.posexplode("scores").alias("pos", "score")))


@query(
    "evaluate_network",
    f"""with {HASHED_SCORES}, b as (select vec_id, any_value(label) as label, arg_max(c, s) as prediction from scored group by vec_id)
        select count(*) as n, round(100e0 * sum(case when label = prediction then 1 else 0 end) / count(*), 2) as accuracy from b""",
)
def _(spark, d):
    return metrics.accuracy(_hashed_scored(spark, d), "label", "prediction")


@query(
    "evaluation_loss_by_batch",
    f"""with {HASHED_SCORES}, l as (select vec_id, ln(sum(exp(s))) - any_value(s) filter (where c = label) as loss from scored group by vec_id),
        b as (select loss, (row_number() over (order by {o.h52('vec_id', 42)}, vec_id) - 1) // 128 as batch from l)
        select batch, count(*) as n, {o.rnd('avg(loss)')} as loss from b group by batch""",
)
def _(spark, d):
    scored = _hashed_scored(spark, d).select("vec_id", cross_entropy(F.col("scores"), F.col("label")).alias("loss"))
    batches = mini_batches(scored, "vec_id", 128, 42)
    return rounded(batches.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.avg("loss").alias("loss")))


@query(
    "prediction_disagreements",
    f"""with a as (select vec_id, cast(min_by(c, d2) as integer) as pa from ({EMBEDDING_DISTANCES}) group by vec_id),
        s as (select e.vec_id, m.c, sum(cast(e.embedding[m.pos] as double) * m.m) as dot from embeddings e, ({LABEL_MEANS}) m group by all),
        b as (select vec_id, cast(max_by(c, dot) as integer) as pb from s group by vec_id)
        select vec_id, label, pa as prediction_a, pb as prediction_b from embeddings join a using (vec_id) join b using (vec_id) where pa <> pb""",
)
def _(spark, d):
    rows = load(spark, d, "embeddings").select("vec_id", "label", "embedding")
    _, centers = label_means(spark, d)
    nearest = kmeans.assign(rows, "embedding", centers, "prediction")
    dots = training.Network((("dense", centers.shape[1], len(centers)),), [centers.T, np.zeros(len(centers))])
    strongest = rows.withColumn("prediction", argmax(dots.scores(spark, kmeans.features_column("embedding"))))
    return metrics.disagreements(nearest, strongest, "vec_id", "label")
