"""Exact order statistics per group for any number of groups of any size.

Every wanted rank has a bracket, a range of values that holds it, kept with exact counts in a DataFrame. Where a bracket holds many rows, a
mergeable quantile sketch of the values inside it names a narrower one, and a pass counts exactly what lies below and inside. Once brackets
hold few rows, their values are counted and the ranks read off. Nothing per group reaches the driver, no group is gathered or sorted
whole, and rows of a group of more than HOT_ROWS meet what is known of it by a broadcast, where they are read: there are at most as many such
groups as the rows hold HOT_ROWS.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

LEAF_ROWS = 1_000_000  # rows of a bracket whose values are counted and sorted
HOT_ROWS = 1_000_000  # rows of a group that are not sent to one task
STEPS = 64  # a sketch is read at this many even steps
ACCURACY = 1000  # relative error of a sketch, far below a step
MOST_ROUNDS = 20


def group_order_statistics(df: DataFrame, value: Column, group: Column, ranks: Callable[[Column], Column], leaf_rows: int | None = None) -> DataFrame:
    """`g, n, rank, v, below, equal`: the value at each wanted rank of each group, the rows below it and those equal to it.

    `ranks` turns the size of a group into an array of 1-based ranks. NULL and NaN values are left out; a NULL group is a group.
    """
    leaf_rows = max(leaf_rows or LEAF_ROWS, 4 * STEPS)  # a sketch can't narrow fewer rows down
    rows = df.select(group.alias("g"), value.alias("v"))
    rows = rows.where(F.col("v").isNotNull() & ~F.isnan(F.col("v").cast("double")))
    sizes = rows.groupBy("g").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    wanted = sizes.select("g", "n", F.explode(F.array_distinct(ranks(F.col("n")))).alias("rank"), "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"))
    wanted = materialise(wanted, "brackets")
    for _ in range(MOST_ROUNDS):
        if not _wide(wanted, leaf_rows):
            return _resolved(rows, wanted)
        wanted = materialise(_narrowed(rows, wanted, leaf_rows), "brackets")
    raise RuntimeError(f"brackets did not close in {MOST_ROUNDS} rounds")


def _wide(wanted: DataFrame, leaf_rows: int) -> bool:
    return not wanted.where((F.col("inside") > leaf_rows) & (F.col("lo") < F.col("hi"))).isEmpty()


def _brackets(wanted: DataFrame) -> DataFrame:
    """One row per bracket under names of its own, with the ranks it serves."""
    named = wanted.select(F.col("g").alias("bg"), "lo", "hi", "below", "inside", "rank", "n")
    return named.groupBy("bg", "lo", "hi", "below", "inside", "n").agg(F.collect_list("rank").alias("ranks"))


def beside_groups(rows: DataFrame, group: str, table: DataFrame, key: str, size: str, also: Column | None = None) -> DataFrame:
    """Rows beside every row of `table` that has their group under `key`, and meets `also`; `size` counts the rows of the group.

    `table` should be cheap to read again. Rows of groups over HOT_ROWS stay where they are.
    """
    hot = table.where(F.col(size) > HOT_ROWS)  # at most as many groups as the rows hold HOT_ROWS
    names = hot.select(F.col(key).alias("__hot")).distinct()
    matched = F.col(group).eqNullSafe(F.col(key))
    matched = matched if also is None else matched & also
    others = rows.join(F.broadcast(names), F.col(group).eqNullSafe(F.col("__hot")), "left_anti")
    return rows.join(F.broadcast(hot), matched).unionByName(others.join(table.where(F.col(size) <= HOT_ROWS), matched))


def _holds() -> Column:
    """A group has few brackets, a row lies in fewer."""
    return (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))


def _inside(rows: DataFrame, large: DataFrame) -> DataFrame:
    """Rows beside every bracket that holds them, for brackets of more rows than a leaf has: there are few."""
    return rows.join(F.broadcast(large), rows["g"].eqNullSafe(large["bg"]) & _holds())


def _narrowed(rows: DataFrame, wanted: DataFrame, leaf_rows: int) -> DataFrame:
    large = (F.col("inside") > leaf_rows) & (F.col("lo") < F.col("hi"))
    done, open_ = wanted.where(~large), _brackets(wanted.where(large))
    steps = F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)])
    keys = ["bg", "lo", "hi", "below", "inside", "n"]
    sketched = _inside(rows, open_.select(*keys)).groupBy(*keys).agg(F.percentile_approx("v", steps, ACCURACY).alias("e"))
    sketched = sketched.select(*[F.col(c).alias(f"s_{c}") for c in ("bg", "lo", "hi")], "e")
    same = F.col("bg").eqNullSafe(F.col("s_bg")) & (F.col("lo") == F.col("s_lo")) & (F.col("hi") == F.col("s_hi"))
    ranked = open_.join(sketched, same).select(*keys, "e", F.explode("ranks").alias("rank"))
    step = F.floor((F.col("rank") - F.col("below") - 1) * STEPS / F.col("inside")).cast("int")
    low = F.element_at("e", F.greatest(step, F.lit(1)))
    high = F.element_at("e", F.least(step + 3, F.lit(STEPS + 1)))
    guess = ranked.select("bg", "n", "rank", "lo", "hi", "below", "inside", low.alias("new_lo"), high.alias("new_hi"))
    # outermost steps reach to the ends of the old bracket
    guess = guess.withColumns({"new_lo": F.when(step <= 1, F.col("lo")).otherwise(F.col("new_lo")), "new_hi": F.when(step + 3 > STEPS, F.col("hi")).otherwise(F.col("new_hi"))})
    guess = materialise(guess, "guesses")
    ranges = guess.groupBy("bg", "lo", "hi", "new_lo", "new_hi").agg(F.first("below").alias("below"))
    v = F.col("v")
    counts = _inside(rows, ranges).groupBy("bg", "lo", "hi", "new_lo", "new_hi").agg(
        F.count_if(v < F.col("new_lo")).alias("skipped"), F.count_if((v >= F.col("new_lo")) & (v <= F.col("new_hi"))).alias("found")
    )
    counts = counts.select(*[F.col(c).alias(f"c_{c}") for c in ("bg", "lo", "hi", "new_lo", "new_hi")], "skipped", "found")
    alike = F.col("bg").eqNullSafe(F.col("c_bg"))
    for c in ("lo", "hi", "new_lo", "new_hi"):
        alike &= F.col(c) == F.col(f"c_{c}")
    before = F.col("below") + F.col("skipped")
    held = (F.col("rank") > before) & (F.col("rank") <= before + F.col("found"))
    pick = {"lo": F.col("new_lo"), "hi": F.col("new_hi"), "below": before, "inside": F.col("found")}
    moved = guess.join(counts, alike).select(F.col("bg").alias("g"), "n", "rank", *[F.when(held, new).otherwise(F.col(c)).alias(c) for c, new in pick.items()])
    return done.unionByName(moved)


def _resolved(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Ranks read off the counted values of their brackets."""
    brackets = _brackets(wanted)
    keys = ["g", "n", "lo", "hi", "below", "ranks"]
    counted = beside_groups(rows, "g", brackets, "bg", "n", _holds()).groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("equal"))
    so_far = Window.partitionBy("g", "lo", "hi").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = (F.col("below") + F.sum("equal").over(so_far)).alias("upto")
    placed = counted.select("g", "n", "v", "equal", "ranks", upto)
    ranks = F.filter("ranks", lambda r: (r > F.col("upto") - F.col("equal")) & (r <= F.col("upto")))
    return placed.select("g", "n", F.explode(ranks).alias("rank"), "v", (F.col("upto") - F.col("equal")).alias("below"), "equal")


def group_quantiles(df: DataFrame, value: Column, group: Column, probabilities: list[float], leaf_rows: int | None = None) -> DataFrame:
    """`g, n, q`: exact quantiles of each group in the order of `probabilities`, with linear interpolation between neighbours."""

    def at(n: Column, p: float) -> Column:
        return F.floor(F.lit(p) * (n - 1)) + 1

    def ranks(n: Column) -> Column:
        return F.array(*[r for p in probabilities for r in (at(n, p), F.least(n, at(n, p) + 1))])

    found = group_order_statistics(df, value.cast("double"), group, ranks, leaf_rows)
    gathered = found.groupBy("g", "n").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("m"))
    n, parts = F.col("n"), []
    for p in probabilities:
        low, high = F.col("m")[at(n, p)], F.col("m")[F.least(n, at(n, p) + 1)]
        parts.append(low + (high - low) * (F.lit(p) * (n - 1) - (at(n, p) - 1)))
    return gathered.select("g", "n", F.array(*parts).alias("q"))
