"""Regression, classification and their metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import cross_entropy, softmax
from ..operators import exact_tree, logistic, metrics, regression, trees
from ..operators.prepare import polynomial_features
from ..operators.split import mini_batches, train_test_split
from ..session import new_shared_path
from ..sources import generate, grid, models
from ..sources.tables import load
from . import oracle as o
from .data import sample_sql, sample_table
from .registry import query, rounded

# Slope and intercept of the line that is not fitted, the range of the curve's grid, and the ranges of the surface's.
HYPOTHESIS = (300.0, 1000.0)
CURVE_GRID = (8.0, 21.0, 100)
SURFACE_GRID = {"x1": (9.0, 20.0, 50), "x2": (1.0, 20.0, 50)}

# ---- lines and planes ----------------------------------------------------------------------


@query(
    "fixed_hypothesis_line",
    f"select id, {o.rnd('300e0 * x + 1000e0')} as prediction from ({sample_sql('education_1d')})",
)
def _(spark, d):
    line = regression.fixed_line(*HYPOTHESIS, "x")
    return rounded(line.predict(sample_table(spark, d, "education_1d")).select("id", "prediction"))


@query(
    "simple_regression",
    f"""select {o.rnd('regr_slope(l_extendedprice, l_quantity)')} as slope,
        {o.rnd('regr_intercept(l_extendedprice, l_quantity)', 4)} as intercept, count(*) as n from lineitem""",
)
def _(spark, d):
    fit = regression.simple_regression(load(spark, d, "lineitem"), "l_quantity", "l_extendedprice")
    return fit.select(F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"), "n")


@query(
    "simple_regression_by_group",
    f"""select l_returnflag, l_linestatus, {o.rnd('regr_slope(l_extendedprice, l_quantity)')} as slope,
        {o.rnd('regr_intercept(l_extendedprice, l_quantity)', 4)} as intercept, count(*) as n
        from lineitem group by all""",
)
def _(spark, d):
    keys = ["l_returnflag", "l_linestatus"]
    fit = regression.simple_regression(load(spark, d, "lineitem"), "l_quantity", "l_extendedprice", keys)
    return fit.select(*keys, F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"), "n")


@query(
    "simple_regression_tv",
    f"""select {o.rnd('regr_slope(y, tv)')} as slope, {o.rnd('regr_intercept(y, tv)')} as intercept, count(*) as n
        from ({sample_sql('tv_sales', 'events', 'event_id')})""",
)
def _(spark, d):
    return rounded(regression.simple_regression(sample_table(spark, d, "tv_sales", "events", "event_id"), "tv", "y"))


def _plane_sql(y: str, x1: str, x2: str, source: str) -> str:
    det = f"(var_pop({x1}) * var_pop({x2}) - covar_pop({x1}, {x2}) * covar_pop({x1}, {x2}))"
    b1 = f"(covar_pop({y}, {x1}) * var_pop({x2}) - covar_pop({y}, {x2}) * covar_pop({x1}, {x2})) / {det}"
    b2 = f"(covar_pop({y}, {x2}) * var_pop({x1}) - covar_pop({y}, {x1}) * covar_pop({x1}, {x2})) / {det}"
    return f"select {b1} as b1, {b2} as b2, avg({y}) - ({b1}) * avg({x1}) - ({b2}) * avg({x2}) as b0, avg({y}) as my from {source}"


@query(
    "multiple_regression",
    f"""with f as ({_plane_sql('l_extendedprice', 'l_quantity', 'l_discount', 'lineitem')})
        select '(intercept)' as term, {o.rnd('b0', 4)} as coefficient from f
        union all select 'l_quantity', {o.rnd('b1', 4)} from f union all select 'l_discount', {o.rnd('b2', 4)} from f""",
)
def _(spark, d):
    model = regression.fit_linear(load(spark, d, "lineitem"), ["l_quantity", "l_discount"], "l_extendedprice")
    return rounded(model.table(spark), 4)


TV_RADIO = sample_sql("tv_radio_sales", "events", "event_id")
TV_RADIO_FIT = f"p as materialized ({TV_RADIO}), f as ({_plane_sql('y', 'tv', 'radio', 'p')})"
TV_RADIO_SCORED = f"{TV_RADIO_FIT}, s as (select p.*, b0 + b1 * tv + b2 * radio as prediction, my from p, f)"


def _tv_radio(spark, d):
    data = sample_table(spark, d, "tv_radio_sales", "events", "event_id")
    return data, regression.fit_linear(data, ["tv", "radio"], "y")


@query(
    "multiple_regression_predict",
    f"with {TV_RADIO_SCORED} select id, {o.rnd('prediction')} as prediction from s",
)
def _(spark, d):
    data, model = _tv_radio(spark, d)
    return rounded(model.predict(data).select("id", "prediction"))


@query(
    "multiple_regression_surface",
    f"""with {TV_RADIO_FIT}, r as (select min(tv) as a0, max(tv) as a1, min(radio) as c0, max(radio) as c1 from p),
        m as (select j * 20 + i as id, a0 + i * (a1 - a0) / 19e0 as tv, c0 + j * (c1 - c0) / 19e0 as radio
              from r, range(20) t(i), range(20) u(j))
        select id, {o.rnd('tv')} as tv, {o.rnd('radio')} as radio, {o.rnd('b0 + b1 * tv + b2 * radio')} as prediction from m, f""",
)
def _(spark, d):
    data, model = _tv_radio(spark, d)
    return rounded(model.predict(grid.data_mesh(data, ["tv", "radio"], 20)))


@query(
    "regression_metrics",
    f"""with {TV_RADIO_SCORED}, r as (select count(*) as n, sum((y - prediction) * (y - prediction)) as rss,
          sum((y - my) * (y - my)) as tss from s)
        select n, {o.rnd('rss / n')} as mse, {o.rnd('rss', 4)} as rss, {o.rnd('1e0 - rss / tss')} as r2,
          {o.rnd('sqrt(rss / (n - 3))')} as rse from r""",
)
def _(spark, d):
    data, model = _tv_radio(spark, d)
    m = metrics.regression_metrics(model.predict(data), "y", "prediction", 2)
    return m.select("n", *[F.round(c, 4 if c == "rss" else 6).alias(c) for c in ("mse", "rss", "r2", "rse")])


@query(
    "residual_table",
    f"""with {TV_RADIO_SCORED} select id, {o.rnd('tv')} as tv, {o.rnd('prediction')} as predicted, {o.rnd('y')} as actual,
          {o.rnd('y - prediction')} as residual from s""",
)
def _(spark, d):
    data, model = _tv_radio(spark, d)
    return rounded(metrics.residuals(model.predict(data), "y", "prediction", ["id", "tv"]))


# ---- curves and surfaces -------------------------------------------------------------------


def _education_points() -> str:
    grid_rows = """select 0 as g, i as id, 8e0 + i * 13e0 / 99e0 as x, 0e0 as y, true as held from range(100) t(i)"""
    return f"select 0 as g, id, x, y, false as held from ({sample_sql('education_1d')}) union all {grid_rows}"


@query(
    "curve_comparison",
    f"""with {o.polynomial_fits(_education_points(), 3)}
        select 'line' as model, s2.id, {o.rnd('8e0 + s2.id * 13e0 / 99e0')} as x, {o.rnd('f', 4)} as prediction from s2 where held
        union all select 'cubic', s4.id, {o.rnd('8e0 + s4.id * 13e0 / 99e0')}, {o.rnd('f', 4)} from s4 where held
        union all select 'hypothesis', i, {o.rnd('8e0 + i * 13e0 / 99e0')}, {o.rnd('300e0 * (8e0 + i * 13e0 / 99e0) + 1000e0', 4)} from range(100) t(i)""",
)
def _(spark, d):
    data = sample_table(spark, d, "education_1d")
    curves = {
        "hypothesis": regression.fixed_line(*HYPOTHESIS, "x"),
        "line": regression.fit_linear(data, ["x"], "y"),
        "cubic": regression.fit_polynomial(data, ["x"], "y", 3),
    }
    table = regression.compare_curves(grid.linspace(spark, *CURVE_GRID), curves, ["id", "x"])
    return table.select("model", "id", F.round("x", 6).alias("x"), F.round("prediction", 4).alias("prediction"))


SURFACE_POINTS = f"""select 0 as g, id, (x1 - 14.5e0) / 5.5e0 as a, (x2 - 10.5e0) / 9.5e0 as b, y, false as held from ({sample_sql('education_2d')})
    union all select 0, j * 50 + i, (i * 11e0 / 49e0 - 5.5e0) / 5.5e0, (j * 19e0 / 49e0 - 9.5e0) / 9.5e0, 0e0, true from range(50) t(i), range(50) u(j)"""


def _surface_sql() -> str:
    ctes, last = o.least_squares(SURFACE_POINTS, ["1e0", "a", "b", "a * a", "a * b", "b * b"])
    return f"with {ctes} select id, {o.rnd('f', 4)} as prediction from {last} where held"


@query("quadratic_surface", _surface_sql())
def _(spark, d):
    model = regression.fit_polynomial(sample_table(spark, d, "education_2d"), ["x1", "x2"], "y", 2)
    surface = grid.mesh(spark, SURFACE_GRID)
    return model.predict(surface).select("id", F.round("prediction", 4).alias("prediction"))


def _part_sql() -> str:
    points = """select 0 as g, p_partkey as id, 2e0 * (p_size - 1) / 49e0 - 1e0 as a,
      2e0 * (p_partkey - min(p_partkey) over ()) / (max(p_partkey) over () - min(p_partkey) over ()) - 1e0 as b,
      p_retailprice as y, false as held from part"""
    ctes, last = o.least_squares(points, ["1e0", "a", "b", "a * a", "a * b", "b * b"])
    return f"with {ctes} select id as p_partkey, {o.rnd('f', 4)} as prediction from {last}"


@query("polynomial_regression_part", _part_sql())
def _(spark, d):
    part = load(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    model = regression.fit_polynomial(part, ["p_size", "p_partkey"], "p_retailprice", 2)
    return model.predict(part).select("p_partkey", F.round("prediction", 4).alias("prediction"))


def _chain_sql() -> str:
    points = "select 0 as g, p_partkey as id, cast(p_size as double) / 50e0 as a, p_retailprice as y, false as held from part"
    ctes, last = o.least_squares(points, ["1e0", "a", "a * a"])
    return f"with {ctes} select id as p_partkey, {o.rnd('f', 4)} as prediction from {last}"


@query("transform_then_fit", _chain_sql())
def _(spark, d):
    part = load(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    expanded = polynomial_features(part, ["p_size"], 2, include_bias=False)
    model = regression.fit_linear(expanded, ["poly_1", "poly_2"], "p_retailprice")
    return model.predict(expanded).select("p_partkey", F.round("prediction", 4).alias("prediction"))


# ---- trees ---------------------------------------------------------------------------------


def _tree_sql(source: str, depth: int) -> str:
    """Mean of the node of every point after `depth` levels of exact splits.

    `source` yields id, x1, x2, y; a point without y takes no part in the fit.
    """
    ctes = [f"p0 as materialized (select id, x1, x2, y, 1 as node from ({source}))"]
    for k in range(depth):
        centred = f"""select *, y - avg(y) over (partition by node) as e,
          var_pop(y) over (partition by node) * count(*) over (partition by node) as t from p{k} where y is not null"""
        sides = [
            f"""select node, {f} as f, x, lead(x) over w as nx, sum(s) over w as sl, sum(n) over w as nl, sum(n) over (partition by node) as n, t
            from (select node, x{f} as x, count(*) as n, sum(e) as s, any_value(t) as t from ({centred}) group by node, x{f})
            window w as (partition by node order by x)"""
            for f in (1, 2)
        ]
        share = f"(round((sl * sl / nl + sl * sl / (n - nl)) / t, {exact_tree.TIE_DIGITS}), -f, -x)"
        ctes.append(f"""b{k} as materialized (select node, arg_max(f, {share}) as f, arg_max((x + nx) / 2, {share}) as cut
          from ({' union all '.join(sides)}) where nx is not null and t > 0 group by node)""")
        ctes.append(f"""p{k + 1} as materialized (select id, x1, x2, y, 2 * p{k}.node + case when (case f when 1 then x1 else x2 end) > cut then 1 else 0 end as node
          from p{k} left join b{k} using (node))""")
    return f"with {', '.join(ctes)} select id, y, {o.rnd('avg(y) over (partition by node)', 4)} as prediction from p{depth}"


@query("regression_tree", f"select id, prediction from ({_tree_sql(sample_sql('education_2d'), 5)})")
def _(spark, d):
    data = sample_table(spark, d, "education_2d")
    tree = exact_tree.fit_regression_tree(data, ["x1", "x2"], "y", 5)
    return tree.predict(data).select("id", F.round("prediction", 4).alias("prediction"))


PART_POINTS = "select p_partkey as id, cast(p_partkey as double) as x1, cast(p_size as double) as x2, p_retailprice as y from part"


@query("regression_tree_part", f"select id, prediction from ({_tree_sql(PART_POINTS, 3)})")
def _(spark, d):
    part = load(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_partkey", "p_size", "p_retailprice")
    tree = exact_tree.fit_regression_tree(part, ["p_partkey", "p_size"], "p_retailprice", 3)
    return tree.predict(part).select("id", F.round("prediction", 4).alias("prediction"))


TREE_GRID = f"""select id, x1, x2, y from ({sample_sql('education_2d')})
  union all select j * 50 + i, 9e0 + i * 11e0 / 49e0, 1e0 + j * 19e0 / 49e0, null from range(50) t(i), range(50) u(j)"""


@query("regression_tree_surface", f"select id, prediction from ({_tree_sql(TREE_GRID, 5)}) where y is null")
def _(spark, d):
    tree = exact_tree.fit_regression_tree(sample_table(spark, d, "education_2d"), ["x1", "x2"], "y", 5)
    surface = grid.mesh(spark, SURFACE_GRID)
    return tree.predict(surface).select("id", F.round("prediction", 4).alias("prediction"))


FOREST = {"depth": 4, "trees": 5, "seed": 42}
BOOSTING = {"depth": 3, "rounds": 4, "rate": 0.3, "ridge": 1.0}
DIGITS = exact_tree.TIE_DIGITS


def _forest_points(points: str) -> str:
    copies = o.poisson_copies("id", f"'{FOREST['seed']}/' || cast(tree as varchar)", trees.MOST_COPIES)
    return f"""select cast(t.tree as integer) as tree, id, x1, x2, y, case when trained then {copies} else 0 end as w, cast(y as double) as a, 1e0 as h
      from ({points}) p, range({FOREST['trees']}) t(tree)"""


def _one_tree(points: str) -> str:
    return f"select 0 as tree, id, x1, x2, y, case when trained then 1 else 0 end as w, cast(y as double) as a, 1e0 as h from ({points})"


def _ensemble_ctes(points: str, mode: str, depth: int) -> str:
    """CTEs tree_, forest_ and boosted_ with id, y, trained and the predicted number or share of class 1."""
    tree, tree_last = o.grown("t", _one_tree(points), depth, mode, DIGITS)
    forest, forest_last = o.grown("f", _forest_points(points), FOREST["depth"], mode, DIGITS)
    boosted, boosted_last = o.boosted(
        "g", f"select id, x1, x2, cast(y as double) as y, case when trained then 1 else 0 end as w from ({points})",
        BOOSTING["depth"], BOOSTING["rounds"], BOOSTING["rate"], "newton" if mode == "gini" else "squares", DIGITS,
    )
    margin = "1e0 / (1e0 + exp(-margin))" if mode == "gini" else "margin"
    leaf = "sum(w * a) over (partition by tree, node) / sum(w) over (partition by tree, node)"
    return f"""{tree}, {forest}, {boosted},
      tree_ as (select id, y, w > 0 as trained, {leaf} as p from {tree_last}),
      forest_ as (select id, any_value(y) as y, avg(p) as p from (select id, y, {leaf} as p from {forest_last}) group by id),
      boosted_ as (select id, y, w > 0 as trained, {margin} as p from {boosted_last})"""


REGRESSION_POINTS = f"select id, x1, x2, y, true as trained from ({sample_sql('education_2d')})"


def _regression_scores(table: str, name: str) -> str:
    return f"""select '{name}' as model, count(*) as n, {o.rnd('avg((y - p) * (y - p))', 4)} as mse,
      {o.rnd('1e0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))', 4)} as r2 from {table}"""


@query(
    "regression_tree_ensembles",
    f"with {_ensemble_ctes(REGRESSION_POINTS, 'squares', 5)} "
    + " union all ".join(_regression_scores(t, n) for t, n in (("tree_", "tree"), ("forest_", "forest"), ("boosted_", "boosting"))),
)
def _(spark, d):
    data = sample_table(spark, d, "education_2d").select("id", "x1", "x2", "y")
    kinds = {"tree": {"depth": 5}, "forest": FOREST, "boosting": BOOSTING}
    parts = []
    for kind, options in kinds.items():
        scored = trees.fit_trees(data, ["x1", "x2"], "y", kind, "regression", **options).transform(data)
        parts.append(metrics.regression_metrics(scored, "y", "prediction", 2).select(F.lit(kind).alias("model"), "n", "mse", "r2"))
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), 4)


def _credit_split(spark, d):
    ids = load(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    return train_test_split(generate.credit_data(ids, "id"), "id", 0.2, 42)


CREDIT_POINTS = f"""select id, income as x1, balance as x2, defaulted as y, not is_test as trained
  from ({o.split(o.credit('customer', 'c_custkey'), 'id', 0.2, 42)})"""
CREDIT_ENSEMBLES = _ensemble_ctes(CREDIT_POINTS, "gini", 5)


def _class_scores(table: str, name: str) -> str:
    return f"""select '{name}' as model, count(*) as n, {o.rnd('avg(case when y = c then 1e0 else 0e0 end)', 4)} as accuracy,
      {o.rnd('coalesce(sum(y * c) / nullif(sum(c), 0), 0)', 4)} as precision, {o.rnd('coalesce(sum(y * c) / nullif(sum(y), 0), 0)', 4)} as recall,
      {o.rnd('coalesce(2e0 * sum(y * c) / nullif(sum(c) + sum(y), 0), 0)', 4)} as f1
      from (select {table}.*, case when p > 0.5e0 then 1 else 0 end as c from {table} join ({CREDIT_POINTS}) s using (id) where not s.trained)"""


@query(
    "classification_tree_ensembles",
    f"with {CREDIT_ENSEMBLES} "
    + " union all ".join(_class_scores(t, n) for t, n in (("tree_", "tree"), ("forest_", "forest"), ("boosted_", "boosting"))),
)
def _(spark, d):
    data = _credit_split(spark, d)
    kinds = {"tree": {"depth": 5}, "forest": FOREST, "boosting": BOOSTING}
    parts = []
    for kind, options in kinds.items():
        model = trees.fit_trees(data.where("not is_test"), ["income", "balance"], "defaulted", kind, "classification", **options)
        scored = model.transform(data.where("is_test"))
        parts.append(metrics.classification_metrics(scored, "defaulted", "prediction").select(F.lit(kind).alias("model"), "*"))
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), 4)


def _share_query(name: str, kind: str, table: str, options: dict) -> None:
    sql = f"with {CREDIT_ENSEMBLES} select id, {o.rnd('p', 6)} as share, case when p > 0.5e0 then 1 else 0 end as predicted from {table}"

    @query(name, sql)
    def _(spark, d):
        data = _credit_split(spark, d)
        model = trees.fit_trees(data.where("not is_test"), ["income", "balance"], "defaulted", kind, "classification", **options)
        scored = model.transform(data, "predicted")
        return scored.select("id", F.round(F.col("predicted_shares")[1], 6).alias("share"), "predicted")


_share_query("classification_tree", "tree", "tree_", {"depth": 5})
_share_query("random_forest_classes", "forest", "forest_", FOREST)
_share_query("boosted_classes", "boosting", "boosted_", BOOSTING)


# ---- logistic regression -------------------------------------------------------------------

CREDIT = o.credit("customer", "c_custkey")


def _credit(spark, d):
    return generate.credit_data(load(spark, d, "customer").select(F.col("c_custkey").alias("id")), "id")


NEWTON_1 = o.newton_logistic(f"select -1 as left_out, cast(defaulted as double) as y, balance / 1000e0 as x1 from ({CREDIT})", 1, [0.0, 1e-6])
NEWTON_2_TRAIN = o.newton_logistic(
    f"""select -1 as left_out, cast(defaulted as double) as y, income / 1000e0 as x1, balance / 1000e0 as x2
        from ({o.split(CREDIT, 'id', 0.2, 42)}) where not is_test""",
    2,
    [0.0, 1e-6, 1e-6],
)


@query(
    "logistic_regression",
    f"""with {NEWTON_1} select '(intercept)' as term, {o.rnd('b0', 5)} as coefficient from b14_
        union all select 'balance', {o.rnd('b1 / 1000e0', 7)} from b14_""",
)
def _(spark, d):
    table = logistic.fit_logistic(_credit(spark, d), ["balance"], "defaulted").table(spark)
    digits = F.when(F.col("term") == "(intercept)", F.round("coefficient", 5)).otherwise(F.round("coefficient", 7))
    return table.select("term", digits.alias("coefficient"))


@query(
    "odds_ratios",
    f"""with {NEWTON_2_TRAIN} select 'income' as term, {o.rnd('b1 / 1000e0', 8)} as coefficient, {o.rnd('exp(b1 / 1000e0)', 8)} as odds_ratio from b14_
        union all select 'balance', {o.rnd('b2 / 1000e0', 8)}, {o.rnd('exp(b2 / 1000e0)', 8)} from b14_""",
)
def _(spark, d):
    train = train_test_split(_credit(spark, d), "id", 0.2, 42).where("not is_test")
    model = logistic.fit_logistic(train, ["income", "balance"], "defaulted")
    return rounded(logistic.odds_ratios(spark, model), 8)


@query(
    "class_probability",
    f"""with {NEWTON_2_TRAIN}, s as (select id, 1e0 / (1e0 + exp(-(b0 + b1 * income / 1000e0 + b2 * balance / 1000e0))) as p from ({CREDIT}), b14_)
        select id, {o.rnd('p')} as probability, case when p >= 0.5e0 then 1 else 0 end as predicted from s""",
)
def _(spark, d):
    data = _credit(spark, d)
    train = train_test_split(data, "id", 0.2, 42).where("not is_test")
    scored = logistic.fit_logistic(train, ["income", "balance"], "defaulted").predict(data, "probability")
    return scored.select("id", F.round("probability", 6).alias("probability"), F.when(F.col("probability") >= 0.5, 1).otherwise(0).alias("predicted"))


@query(
    "linear_beside_logistic",
    f"""with {NEWTON_1}, l as (select regr_slope(defaulted, balance) as m, regr_intercept(defaulted, balance) as c from ({CREDIT}))
        select i as id, {o.rnd('i * 3000e0 / 299e0')} as balance, {o.rnd('c + m * (i * 3000e0 / 299e0)')} as p_linear,
          {o.rnd('1e0 / (1e0 + exp(-(b0 + b1 * (i * 3e0 / 299e0))))')} as p_logistic from l, b14_, range(300) t(i)""",
)
def _(spark, d):
    data = _credit(spark, d)
    line = regression.fit_linear(data, ["balance"], "defaulted")
    curve = logistic.fit_logistic(data, ["balance"], "defaulted")
    points = grid.linspace(spark, 0.0, 3000.0, 300, "balance")
    return rounded(curve.predict(line.predict(points, "p_linear"), "p_logistic"))


QUALITY_POINTS = """select -1 as left_out, cast(quality as double) as y, n_chars / 10000e0 as x1, cast(toxic as double) as x2
    from documents join labels using (doc_id)"""


@query(
    "logistic_quality_labels",
    f"""with {o.newton_logistic(QUALITY_POINTS, 2, [0.0, 1e-8, 1.0])}
        select '(intercept)' as term, {o.rnd('b0', 5)} as coefficient from b14_
        union all select 'n_chars', {o.rnd('b1 / 10000e0', 9)} from b14_ union all select 'toxic', {o.rnd('b2', 5)} from b14_""",
)
def _(spark, d):
    data = load(spark, d, "documents").select("doc_id", "n_chars").join(load(spark, d, "labels"), "doc_id")
    table = logistic.fit_logistic(data, ["n_chars", "toxic"], "quality").table(spark)
    digits = F.when(F.col("term") == "n_chars", F.round("coefficient", 9)).otherwise(F.round("coefficient", 5))
    return table.select("term", digits.alias("coefficient"))


# ---- classification metrics ----------------------------------------------------------------

LONG_ENOUGH = "select doc_id, quality, case when n_chars >= 400 then 1 else 0 end as predicted from documents join labels using (doc_id)"


def _length_rule(spark, d):
    rows = load(spark, d, "documents").select("doc_id", "n_chars").join(load(spark, d, "labels"), "doc_id")
    return rows.withColumn("predicted", F.when(F.col("n_chars") >= 400, 1).otherwise(0))


@query(
    "accuracy",
    f"""select count(*) as n, round(100e0 * sum(case when quality = predicted then 1 else 0 end) / count(*), 2) as accuracy from ({LONG_ENOUGH})""",
)
def _(spark, d):
    return metrics.accuracy(_length_rule(spark, d), "quality", "predicted")


@query("confusion_counts", f"select quality as label, predicted as prediction, count(*) as n from ({LONG_ENOUGH}) group by all")
def _(spark, d):
    return metrics.confusion(_length_rule(spark, d), "quality", "predicted")


@query(
    "precision_recall_f1",
    f"""with c as (select count(*) as n, sum(quality * predicted) as tp, sum((1 - quality) * predicted) as fp,
          sum(quality * (1 - predicted)) as fn, sum(case when quality = predicted then 1 else 0 end) as hits from ({LONG_ENOUGH}))
        select n, {o.rnd('hits / n')} as accuracy, {o.rnd('coalesce(tp / nullif(tp + fp, 0), 0)')} as precision,
          {o.rnd('coalesce(tp / nullif(tp + fn, 0), 0)')} as recall, {o.rnd('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)')} as f1 from c""",
)
def _(spark, d):
    return rounded(metrics.classification_metrics(_length_rule(spark, d), "quality", "predicted"))


SCORES = "list_transform(embedding, lambda s: cast(s as double))"


@query(
    "cross_entropy",
    f"""with s as (select vec_id, label, {SCORES} as e from embeddings), m as (select *, list_max(e) as top from s)
        select vec_id, {o.rnd('top + ln(list_sum(list_transform(e, lambda s: exp(s - top)))) - e[label + 1]')} as loss from m""",
)
def _(spark, d):
    rows = load(spark, d, "embeddings").withColumn("scores", F.col("embedding"))
    return rounded(rows.select("vec_id", cross_entropy(F.col("scores"), F.col("label")).alias("loss")))


@query(
    "mean_cross_entropy",
    f"""with s as (select label, {SCORES} as e from embeddings)
        select {o.rnd('avg(ln(list_sum(list_transform(e, lambda s: exp(s)))) - e[label + 1])')} as loss from s""",
)
def _(spark, d):
    rows = load(spark, d, "embeddings").withColumn("scores", F.col("embedding"))
    return rounded(metrics.mean_cross_entropy(rows, "scores", "label"))


@query(
    "softmax_scores",
    f"""with s as (select vec_id, {SCORES} as e from embeddings), m as (select vec_id, e, list_sum(list_transform(e, lambda s: exp(s))) as z from s)
        select vec_id, cast(pos - 1 as integer) as pos, {o.rnd('exp(e[pos]) / z')} as p from (select *, unnest(range(1, len(e) + 1)) as pos from m)""",
)
def _(spark, d):
    return rounded(load(spark, d, "embeddings").select("vec_id", F.posexplode(softmax(F.col("embedding"))).alias("pos", "p")))


@query(
    "loss_history",
    f"""with {TV_RADIO_SCORED}, b as (select (y - prediction) * (y - prediction) as loss, cast(e as integer) as epoch,
          (row_number() over (partition by e order by {o.h52_col('id', "'42/' || cast(e as varchar)")}, id) - 1) // 128 as batch
          from s, range(1, 4) t(e)), m as (select epoch, batch, avg(loss) as loss from b group by all)
        select epoch, count(*) as batches, {o.rnd('avg(loss)')} as loss from m group by epoch""",
)
def _(spark, d):
    data, model = _tv_radio(spark, d)
    gap = F.col("y") - F.col("prediction")
    scored = model.predict(data).select("id", (gap * gap).alias("loss"))
    parts = [mini_batches(scored, "id", 128, f"42/{e}").withColumn("epoch", F.lit(e)) for e in (1, 2, 3)]
    return rounded(metrics.batch_loss(parts[0].unionByName(parts[1]).unionByName(parts[2]), "epoch", "batch", F.col("loss")))


# ---- stored models -------------------------------------------------------------------------


@query(
    "save_and_reload_model",
    f"with {TV_RADIO_SCORED} select id, {o.rnd('prediction')} as prediction from s",
)
def _(spark, d):
    data, model = _tv_radio(spark, d)
    path = new_shared_path(spark, "model")
    models.save_linear(spark, model, path)
    reloaded = models.load_linear(spark, path)
    models.remove(spark, path)
    return rounded(reloaded.predict(data).select("id", "prediction"))
