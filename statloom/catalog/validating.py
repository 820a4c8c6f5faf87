"""Hold-out, cross-validation and degree sweeps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tuning, validation
from ..sources import generate
from ..sources.tables import load
from . import oracle as o
from .data import sample_sql, sample_table
from .registry import query, rounded


def _points(name: str, x: str, pattern: str) -> str:
    """Points of a sample set for the fitting CTEs; `pattern` adds g and held to id, x, y."""
    return pattern.format(source=f"select id, {x} as x, y from ({sample_sql(name)})")


SPLIT = "select 0 as g, id, x, y, is_test as held from (" + o.split("{source}", "id", 0.5, 42) + ")"
FOLDS = "select k as g, id, x, y, fold = k as held from (" + o.folds("{source}", "id", 10, 42) + "), range(10) t(k)"
SEEDS = f"""select s as g, id, x, y,
  row_number() over (partition by s order by {o.h52_col('id', 's')}, id) <= ceil(count(*) over (partition by s) * 0.5e0) as held
  from ({{source}}), range(10) t(s)"""


@query(
    "holdout_validation",
    f"""with {o.polynomial_fits(_points('cars_linear', 'horsepower', SPLIT), 1)}
        select count(*) as n, {o.rnd('avg((y - f) * (y - f))')} as mse from s2 where held""",
)
def _(spark, d):
    return rounded(validation.holdout(sample_table(spark, d, "cars_linear"), "id", ["horsepower"], "y"))


def _curve_sql() -> str:
    ctes = o.polynomial_fits(_points("cosine", "x", SPLIT), 20)
    parts = [
        f"""select {k} as degree, {o.rnd('avg((y - f) * (y - f)) filter (where not held)')} as train_mse,
        {o.rnd('avg((y - f) * (y - f)) filter (where held)')} as test_mse from s{k + 1}"""
        for k in range(1, 21)
    ]
    return f"with {ctes} {' union all '.join(parts)}"


@query("learning_curve", _curve_sql())
def _(spark, d):
    return rounded(validation.learning_curve(sample_table(spark, d, "cosine"), "id", ["x"], "y", range(1, 21)))


@query(
    "best_curve_degree",
    f"select degree, test_mse from ({_curve_sql()}) order by test_mse, degree limit 1",
)
def _(spark, d):
    curve = validation.learning_curve(sample_table(spark, d, "cosine"), "id", ["x"], "y", range(1, 21))
    best = curve.agg(F.min_by("degree", F.struct("test_mse", "degree")).alias("degree"), F.min("test_mse").alias("test_mse"))
    return rounded(best)


def _sweep_sql(pattern: str, select: str, rest: str = "") -> str:
    ctes = o.polynomial_fits(_points("cars_quadratic", "horsepower", pattern), 10)
    parts = [select.format(k=k, s=f"s{k + 1}") for k in range(1, 11)]
    return f"with {ctes}, e as ({' union all '.join(parts)}) {rest or 'select * from e'}"


PER_GROUP = "cast(g as integer) as {0}, {{k}} as degree, count(*) as n, " + o.rnd("avg((y - f) * (y - f))") + " as mse from {{s}} where held group by g"


@query("repeated_holdout_by_degree", _sweep_sql(SEEDS, "select " + PER_GROUP.format("seed")))
def _(spark, d):
    data = sample_table(spark, d, "cars_quadratic")
    return rounded(validation.repeated_holdout(data, "id", ["horsepower"], "y", list(range(10)), range(1, 11)))


@query("fold_errors_by_degree", _sweep_sql(FOLDS, "select " + PER_GROUP.format("fold")))
def _(spark, d):
    data = sample_table(spark, d, "cars_quadratic")
    return rounded(validation.fold_errors(data, "id", ["horsepower"], "y", range(1, 11)))


FOLD_MEANS = "select {k} as degree, avg((y - f) * (y - f)) as mse from {s} where held group by g"


@query(
    "k_fold_cv_by_degree",
    _sweep_sql(FOLDS, FOLD_MEANS, f"select degree, count(*) as folds, {o.rnd('avg(mse)')} as mse from e group by degree"),
)
def _(spark, d):
    data = sample_table(spark, d, "cars_quadratic")
    return rounded(validation.k_fold_cv(data, "id", ["horsepower"], "y", range(1, 11)))


@query(
    "tune_degree",
    _sweep_sql(
        FOLDS, FOLD_MEANS,
        f", m as (select degree, avg(mse) as mse from e group by degree) select degree, {o.rnd('mse')} as mse from m order by m.mse, degree limit 1",
    ),
)
def _(spark, d):
    data = sample_table(spark, d, "cars_quadratic")
    return rounded(validation.tune_degree(data, "id", ["horsepower"], "y", range(1, 11)))


@query(
    "k_fold_cv",
    f"""with p as materialized ({o.folds(sample_sql('cars_linear'), 'id', 10, 42)}),
        f as (select k, regr_slope(y, horsepower) as b, regr_intercept(y, horsepower) as a from p, range(10) t(k) where fold <> k group by k),
        e as (select k, avg((y - a - b * horsepower) * (y - a - b * horsepower)) as mse from p join f on fold = k group by k)
        select 1 as degree, count(*) as folds, {o.rnd('avg(mse)')} as mse from e""",
)
def _(spark, d):
    return rounded(validation.k_fold_cv(sample_table(spark, d, "cars_linear"), "id", ["horsepower"], "y"))


@query(
    "leave_one_out_cv",
    f"""with p as materialized ({sample_sql('cars_linear')}),
        t as (select count(*) as n, sum(horsepower) as sx, sum(y) as sy, sum(horsepower * horsepower) as sxx, sum(horsepower * y) as sxy from p),
        l as (select horsepower as x, y, n - 1e0 as m, sx - horsepower as sx, sy - y as sy, sxx - horsepower * horsepower as sxx,
              sxy - horsepower * y as sxy from p, t),
        f as (select x, y, sx, sy, m, (m * sxy - sx * sy) / (m * sxx - sx * sx) as b from l)
        select count(*) as fits, {o.rnd('avg(pow(y - (sy - b * sx) / m - b * x, 2))')} as mse from f""",
)
def _(spark, d):
    return rounded(validation.loo_cv(sample_table(spark, d, "cars_linear"), ["horsepower"], "y"))


def _loo_cubic_sql() -> str:
    source = f"select id, (horsepower - 125e0) / 75e0 as x, y from ({sample_sql('cars_quadratic')})"
    points = f"select a.id as g, b.id, b.x, b.y, a.id = b.id as held from ({source}) a, ({source}) b"
    ctes, last = o.least_squares(points, ["1e0", "x", "x * x", "x * x * x"])
    return f"with {ctes} select count(*) as fits, {o.rnd('avg((y - f) * (y - f))')} as mse from {last} where held"


@query("leave_one_out_cv_cubic", _loo_cubic_sql())
def _(spark, d):
    return rounded(validation.loo_cv(sample_table(spark, d, "cars_quadratic"), ["horsepower"], "y", 3))


# Penalty strengths compared, and the folds of the comparison.
STRENGTHS = [0.01, 1.0, 100.0]
TUNE_FOLDS = 3


def _tune_sql() -> str:
    """One Newton fit per (strength, fold), numbered 100 * strength + fold."""
    points = f"""select fold as left_out, cast(defaulted as double) as y, income / 1000e0 as x1, balance / 1000e0 as x2
      from ({o.folds(o.credit('customer', 'c_custkey'), 'id', TUNE_FOLDS, 42)})"""
    settings = " union all ".join(
        f"select {100 * i + fold} as g, {o.num(1 / c)} as lam" for i, c in enumerate(STRENGTHS) for fold in range(TUNE_FOLDS)
    )
    strength = " ".join(f"when {i} then {o.num(c)}" for i, c in enumerate(STRENGTHS))
    return f"""with {o.newton_logistic(points, 2, [0.0, 1e-6, 1e-6], settings=settings)},
      h as (select g, avg(case when (b0 + b1 * x1 + b2 * x2 >= 0) = (y = 1) then 1e0 else 0e0 end) as accuracy
            from pts join b14_ on left_out = g % 100 group by g)
      select case g // 100 {strength} end as c, {TUNE_FOLDS} as folds, {o.rnd('avg(accuracy)')} as accuracy from h group by g // 100"""


@query("tune_regularisation", _tune_sql())
def _(spark, d):
    ids = load(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    data = generate.credit_data(ids, "id")
    return rounded(tuning.tune_logistic(data, "id", ["income", "balance"], "defaulted", STRENGTHS, TUNE_FOLDS))
