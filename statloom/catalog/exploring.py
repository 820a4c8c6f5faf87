"""Tables behind exploratory charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import explore, regression
from ..sources import grid
from ..sources.tables import load
from . import oracle as o
from .data import sample_sql, sample_table
from .models import CREDIT, _credit
from .registry import query, rounded

BOX = """with q as (select {c} as category, quantile_cont({v}, 0.25) as q1, quantile_cont({v}, 0.5) as median, quantile_cont({v}, 0.75) as q3, count(*) as n from ({t}) group by {c}),
  w as (select category, min({v}) as low_whisker, max({v}) as high_whisker from ({t}) join q on {c} = category
        where {v} between q1 - 1.5e0 * (q3 - q1) and q3 + 1.5e0 * (q3 - q1) group by category)
  select category, {q1} as q1, {median} as median, {q3} as q3, {low_whisker} as low_whisker, {high_whisker} as high_whisker, n from q join w using (category)"""


def box_sql(table: str, category: str, value: str) -> str:
    shown = {c: o.rnd(c) for c in ("q1", "median", "q3", "low_whisker", "high_whisker")}
    return BOX.format(t=table, c=category, v=value, **shown)


@query("box_plot_events", box_sql("select event_type, value from events", "event_type", "value"))
def _(spark, d):
    return rounded(explore.box_plot(load(spark, d, "events"), "event_type", "value"))


CREDIT_STATUS = f"select case when defaulted = 1 then '1: Default' else '0: No Default' end as status, balance from ({CREDIT})"


@query("box_plot_credit", box_sql(CREDIT_STATUS, "status", "balance"))
def _(spark, d):
    return rounded(explore.box_plot(_credit(spark, d), "status", "balance"))


@query(
    "scatter_points",
    f"""select c_custkey, c_mktsegment, c_acctbal from customer
        qualify row_number() over (partition by c_mktsegment order by {o.h52('c_custkey', 42)}) <= 50""",
)
def _(spark, d):
    rows = load(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return explore.scatter_points(rows, "c_custkey", "c_mktsegment", 50)


MANY_CATEGORIES = """select case when l_linenumber <= 4 then 'most'
  else cast(l_orderkey as varchar) || '/' || cast(l_linenumber as varchar) || '/' || cast(l_suppkey as varchar) end as c, l_extendedprice from lineitem"""


@query("box_plot_many_categories", box_sql(MANY_CATEGORIES, "c", "l_extendedprice"))
def _(spark, d):
    """Tens of thousands of categories, one of which holds most rows."""
    rows = load(spark, d, "lineitem").select("l_linenumber", "l_orderkey", "l_suppkey", "l_extendedprice")
    own = F.concat_ws("/", "l_orderkey", "l_linenumber", "l_suppkey")
    return rounded(explore.box_plot(rows.withColumn("c", F.when(F.col("l_linenumber") <= 4, "most").otherwise(own)), "c", "l_extendedprice"))


@query(
    "scatter_points_many_categories",
    f"""select event_id, c, value from (select event_id, value, case when event_id % 3 = 0 then 'most' when event_id % 20011 <> 1 then cast(event_id % 20011 as varchar) end as c from events)
        qualify row_number() over (partition by c order by {o.h52('event_id', 42)}) <= 2""",
)
def _(spark, d):
    key = F.col("event_id")
    c = F.when(key % 3 == 0, "most").when(key % 20011 != 1, (key % 20011).cast("string"))
    rows = load(spark, d, "events").select("event_id", c.alias("c"), "value")
    return explore.scatter_points(rows, "event_id", "c", 2)


@query(
    "axis_range",
    f"select {o.rnd('min(y) - 500e0')} as low, {o.rnd('max(y) + 1000e0')} as high from ({sample_sql('education_1d')})",
)
def _(spark, d):
    return rounded(explore.axis_range(sample_table(spark, d, "education_1d"), "y", 500.0, 1000.0))


@query(
    "fitted_line_table",
    f"""with p as materialized ({sample_sql('tv_sales')}), f as (select regr_slope(y, tv) as b, regr_intercept(y, tv) as a, min(tv) as lo, max(tv) as hi from p)
        select i as id, {o.rnd('lo + i * (hi - lo) / 99e0')} as tv, {o.rnd('a + b * (lo + i * (hi - lo) / 99e0)')} as prediction from f, range(100) t(i)""",
)
def _(spark, d):
    data = sample_table(spark, d, "tv_sales")
    points = grid.data_line(data, "tv", 100, "tv")
    return rounded(regression.fit_linear(data, ["tv"], "y").predict(points))


def _profile_sql(table: str, columns: list[str]) -> str:
    parts = []
    for c in columns:
        x = f"cast({c} as double)"
        parts.append(f"""select '{c}' as "column", count({c}) as n, count(*) - count({c}) as missing, {o.rnd(f'avg({x})', 4)} as mean,
          {o.rnd(f'stddev_samp({x})', 4)} as sd, {o.rnd(f'min({x})', 4)} as low, {o.rnd(f'max({x})', 4)} as high,
          {o.rnd(f'quantile_cont({x}, 0.25)', 4)} as q1, {o.rnd(f'quantile_cont({x}, 0.5)', 4)} as median, {o.rnd(f'quantile_cont({x}, 0.75)', 4)} as q3 from {table}""")
    return " union all ".join(parts)


PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("column_profile", _profile_sql("lineitem", PROFILED))
def _(spark, d):
    return rounded(explore.profile(load(spark, d, "lineitem"), PROFILED), 4)
