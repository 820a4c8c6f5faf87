"""Exact order statistics without sorting the data.

A histogram between the known minimum and maximum tells which bin holds a wanted rank; the next
pass looks only inside that bin. Each pass narrows the search by the number of bins, so a few
scans find the exact value in any volume, and no task ever holds a whole group.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BINS = 4096  # histogram bins of one span
LEAF_ROWS = 20_000  # a span of at most this many rows is fetched as value counts
MAX_GROUPS = 10_000
DRIVER_ROWS = 400_000  # bins or leaf values fetched per pass, over all spans
PLAIN = {"boolean", "int", "bigint", "double", "string"}  # types that Arrow takes from Python values as they are


class TooManyGroups(ValueError):
    """The groups themselves are big data: `group_order` takes any number of them."""


@dataclass(frozen=True)
class OrderStatistic:
    value: float
    below: int  # rows smaller than value
    equal: int  # rows equal to value


@dataclass
class _Span:
    group: object
    lo: float
    hi: float
    below: int
    count: int
    ranks: list[int]


def order_statistics(
    df: DataFrame,
    value: Column,
    ranks: Callable[[object, int], list[int]],
    group: Column | None = None,
    bounds: tuple | None = None,
    bins: int = BINS,
    leaf_rows: int = LEAF_ROWS,
) -> tuple[dict, dict]:
    """Exact values at 1-based ranks per group.

    `ranks(group, n)` names the wanted ranks of a group with n values. Returns the group sizes
    and {group: {rank: OrderStatistic}}. NULL and NaN values are left out. Values of known
    `bounds`, such as hashes, save the pass that looks for them.
    """
    one_group = group is None
    group = F.lit(0) if one_group else group
    rows = df.select(group.alias("g"), value.alias("v")).where(
        F.col("v").isNotNull() & ~F.isnan(F.col("v").cast("double"))
    )
    if bounds is None:
        sizes, spans = _first_look(rows, ranks)
    else:
        sizes, spans = _first_histogram(rows, ranks, bounds, bins if one_group else min(bins, 512))
    found: dict = {g: {} for g in sizes}
    leaves: list[_Span] = []
    while spans:
        fetched = min(leaf_rows, max(8, DRIVER_ROWS // len(spans)))
        wide = []
        for s in spans:
            if s.lo == s.hi:
                found[s.group].update({k: OrderStatistic(s.lo, s.below, s.count) for k in s.ranks})
            elif s.count <= fetched:
                leaves.append(s)
            else:
                wide.append(s)
        spans = _narrow(rows, wide, min(bins, max(8, DRIVER_ROWS // len(wide)))) if wide else []
    if leaves:
        _resolve(rows, leaves, found)
    return sizes, found


def _first_look(rows: DataFrame, ranks) -> tuple[dict, list[_Span]]:
    """Size and value range of every group."""
    whole = rows.groupBy("g").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    totals = whole.limit(MAX_GROUPS + 1).collect()
    _check_groups(len(totals))
    spans = []
    for r in totals:
        wanted = sorted(set(ranks(r["g"], r["n"])))
        if wanted:
            spans.append(_Span(r["g"], r["lo"], r["hi"], 0, r["n"], wanted))
    return {r["g"]: r["n"] for r in totals}, spans


def _check_groups(n: int) -> None:
    if n > MAX_GROUPS:
        raise TooManyGroups(f"more than {MAX_GROUPS} groups")


def _first_histogram(rows: DataFrame, ranks, bounds: tuple, bins: int) -> tuple[dict, list[_Span]]:
    """Sizes and the spans holding the wanted ranks from one pass over values of known bounds."""
    lo, hi = (float(b) for b in bounds)
    counted = _histogram(rows, ["g"], F.lit(lo), F.lit(hi), bins).collect()
    by_group: dict = {}
    for r in counted:
        by_group.setdefault(r["g"], []).append(r)
    _check_groups(len(by_group))
    sizes = {g: sum(r["n"] for r in found) for g, found in by_group.items()}
    spans = []
    for g, found in by_group.items():
        spans += _holding(g, 0, sorted(set(ranks(g, sizes[g]))), found)
    return sizes, spans


def _histogram(rows: DataFrame, keys: list[str], lo: Column, hi: Column, bins: int) -> DataFrame:
    """Count, minimum and maximum per equal-width bin."""
    position = F.least(F.lit(bins - 1), F.floor((F.col("v").cast("double") - lo) / (hi - lo) * bins))
    return (
        rows.withColumn("bin", position)
        .groupBy(*keys, "bin")
        .agg(F.count("v").alias("n"), F.min("v").alias("a"), F.max("v").alias("b"))
    )


def _holding(group, below: int, ranks: list[int], bins: list) -> list[_Span]:
    """The bins that hold a wanted rank, narrowed to the values found in them."""
    result = []
    for r in sorted(bins, key=lambda r: r["bin"]):
        held = [k for k in ranks if below < k <= below + r["n"]]
        if held:
            result.append(_Span(group, r["a"], r["b"], below, r["n"], held))
        below += r["n"]
    return result


def _inside(rows: DataFrame, spans: list[_Span]) -> DataFrame:
    """Rows falling in a span. Spans of one group are disjoint, so a row matches one at most."""
    table = _span_table(rows.sparkSession, spans, *(rows.schema[c].dataType.simpleString() for c in "gv"))
    on = rows["g"].eqNullSafe(table["sg"]) & (rows["v"] >= table["lo"]) & (rows["v"] <= table["hi"])
    return rows.join(F.broadcast(table), on)  # at most MAX_GROUPS times the wanted ranks


def _span_table(spark: SparkSession, spans: list[_Span], g_type: str, v_type: str) -> DataFrame:
    """The spans as rows; through Arrow where the types allow, because a list of tuples is read by Python workers of a pool of its own, which stays in memory."""
    names, kinds = ("span", "sg", "lo", "hi"), ("int", g_type, v_type, v_type)
    cells = [(i, s.group, s.lo, s.hi) for i, s in enumerate(spans)]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds))
    return spark.createDataFrame(pa.table(dict(zip(names, map(list, zip(*cells))))) if {g_type, v_type} <= PLAIN else cells, schema)


def _narrow(rows: DataFrame, spans: list[_Span], bins: int) -> list[_Span]:
    lo, hi = (F.col(c).cast("double") for c in ("lo", "hi"))
    by_span: dict[int, list] = {}
    for r in _histogram(_inside(rows, spans), ["span"], lo, hi, bins).collect():
        by_span.setdefault(r["span"], []).append(r)
    return [n for i, s in enumerate(spans) for n in _holding(s.group, s.below, s.ranks, by_span[i])]


def _resolve(rows: DataFrame, spans: list[_Span], found: dict) -> None:
    """Spans of at most `leaf_rows` rows: count each value and walk through them."""
    counted = _inside(rows, spans).groupBy("span", "v").agg(F.count("v").alias("n")).collect()
    by_span: dict[int, list] = {}
    for r in counted:
        by_span.setdefault(r["span"], []).append((r["v"], r["n"]))
    for i, s in enumerate(spans):
        below = s.below
        for value, n in sorted(by_span[i]):
            for k in s.ranks:
                if below < k <= below + n:
                    found[s.group][k] = OrderStatistic(value, below, n)
            below += n


def quantiles(
    df: DataFrame, value: Column, probabilities: list[float], group: Column | None = None
) -> tuple[dict, dict]:
    """Exact quantiles with linear interpolation between neighbours: {group: [q, ...]}."""

    def neighbours(_g, n):
        return [k for p in probabilities for k in (int(p * (n - 1)) + 1, min(n, int(p * (n - 1)) + 2))]

    sizes, found = order_statistics(df, value.cast("double"), neighbours, group)
    result = {}
    for g, n in sizes.items():
        result[g] = []
        for p in probabilities:
            at = p * (n - 1)
            low = found[g][int(at) + 1].value
            high = found[g][min(n, int(at) + 2)].value
            result[g].append(low + (high - low) * (at - int(at)))
    return sizes, result
