from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.operators import explore
from statloom.plans import group_order


@pytest.fixture(scope="module")
def rows(spark):
    """A group of 600 rows, a NULL group of 200, and 200 groups of one row; a NULL value in each of the first two."""
    g = F.when(F.col("id") < 600, "most").when(F.col("id") >= 800, F.col("id").cast("string"))
    v = F.when(~F.col("id").isin(5, 605), (F.col("id") * 37 % 101).cast("double"))
    df = spark.range(1000).select("id", g.alias("g"), v.alias("v")).cache()
    yield df
    df.unpersist()


def test_rows_of_a_large_group_stay_where_they_are(spark, rows, monkeypatch):
    monkeypatch.setattr(group_order, "HOT_ROWS", 100)
    sizes = rows.groupBy(F.col("g").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    got = group_order.beside_groups(rows, "g", sizes, "key", "n")
    plain = rows.join(sizes, F.col("g").eqNullSafe(F.col("key")))
    assert sorted(got.collect(), key=str) == sorted(plain.collect(), key=str)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") >= 1 and plan.count("strategy=broadcast") == 2


def test_box_plot_of_large_and_small_groups(spark, rows, monkeypatch):
    monkeypatch.setattr(group_order, "HOT_ROWS", 100)
    monkeypatch.setattr(group_order, "LEAF_ROWS", 256)
    values: dict = {}
    for r in rows.collect():
        if r["v"] is not None:
            values.setdefault(r["g"], []).append(r["v"])
    found = {r["category"]: r for r in explore.box_plot(rows, "g", "v").collect()}
    assert found.keys() == values.keys()
    for g, vs in values.items():
        q = np.quantile(vs, [0.25, 0.5, 0.75])
        reach = 1.5 * (q[2] - q[0])
        inside = [v for v in vs if q[0] - reach <= v <= q[2] + reach]
        r = found[g]
        assert [r["q1"], r["median"], r["q3"], r["low_whisker"], r["high_whisker"], r["n"]] == pytest.approx([*q, min(inside), max(inside), len(vs)])
