"""Splits, folds and batches with exact sizes, decided by a hash of the row id.

The order of rows is the order of (hash52(id, seed), id). A split needs only the value at the
cut, found by `order_statistics`; the split itself is then a comparison with a literal, with no
shuffle, sort or join. Ids must be unique; copies of an id stay on one side.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import HASH_SPAN, hash52
from ..plans.order_stats import order_statistics

BUCKET_ROWS = 500_000


def _cut(df: DataFrame, id_col: str, hashed: Column, stat, rank: int) -> tuple[int, object | None]:
    """Cut after the given rank; an id too where several ids share the hash at the cut."""
    if stat.equal == 1 or rank == stat.below + stat.equal:
        return stat.value, None
    tied = df.where(hashed == F.lit(stat.value)).select(id_col).distinct().orderBy(id_col)
    ids = [r[0] for r in tied.limit(rank - stat.below).collect()]
    return stat.value, ids[-1]


def _up_to(id_col: str, hashed: Column, cut: tuple) -> Column:
    value, last_id = cut
    if last_id is None:
        return hashed <= F.lit(value)
    return (hashed < F.lit(value)) | ((hashed == F.lit(value)) & (F.col(id_col) <= F.lit(last_id)))


def train_test_split(
    df: DataFrame, id_col: str, fraction: float, seed, name: str = "is_test"
) -> DataFrame:
    """Mark exactly ceil(n * fraction) rows as test rows."""
    hashed = hash52(id_col, seed)
    sizes, found = order_statistics(
        df, hashed, lambda _g, n: _wanted(_test_size(n, fraction)), bounds=(0, HASH_SPAN)
    )
    if not sizes:
        return df.withColumn(name, F.lit(False))
    rank = _test_size(sizes[0], fraction)
    if rank == 0:
        return df.withColumn(name, F.lit(False))
    cut = _cut(df, id_col, hashed, found[0][rank], rank)
    return df.withColumn(name, _up_to(id_col, hashed, cut))


def _wanted(rank: int) -> list[int]:
    return [rank] if rank else []


def _test_size(n: int, fraction: float) -> int:
    # a product such as 10 * 0.3 may exceed the whole number by rounding alone
    return min(n, math.ceil(round(n * fraction, 9)))


def split_columns(
    df: DataFrame, id_col: str, fraction: float, seeds: list[int], prefix: str = "test_"
) -> DataFrame:
    """One boolean column per seed, each an independent split; the cuts come from one search."""
    ids = df.select(id_col)
    spread = ids.select(id_col, F.explode(F.array(*[F.lit(s) for s in seeds])).alias("seed"))
    sizes, found = order_statistics(
        spread,
        hash52(id_col, F.col("seed")),
        lambda _g, n: _wanted(_test_size(n, fraction)),
        F.col("seed"),
        bounds=(0, HASH_SPAN),
    )
    result = {}
    for s in seeds:
        rank = _test_size(sizes.get(s, 0), fraction)
        hashed = hash52(id_col, s)
        result[f"{prefix}{s}"] = (
            _up_to(id_col, hashed, _cut(ids, id_col, hashed, found[s][rank], rank)) if rank else F.lit(False)
        )
    return df.withColumns(result)


def repeated_split(df: DataFrame, id_col: str, fraction: float, seeds: list[int]) -> DataFrame:
    """One row per (seed, id) with its side of the split."""
    wide = split_columns(df.select(id_col), id_col, fraction, seeds)
    sides = F.array(*[F.struct(F.lit(s).alias("seed"), F.col(f"test_{s}").alias("is_test")) for s in seeds])
    return wide.select(id_col, F.inline(sides)).select("seed", id_col, "is_test")


def k_fold(df: DataFrame, id_col: str, k: int, seed, name: str = "fold") -> DataFrame:
    """Assign folds 0..k-1 whose sizes differ by at most one, larger folds first."""
    hashed = hash52(id_col, seed)

    def ends(_g, n):
        small, extra = divmod(n, k)
        running, result = 0, []
        for f in range(k - 1):
            running += small + (1 if f < extra else 0)
            result.append(running)
        return result

    sizes, found = order_statistics(
        df, hashed, lambda g, n: [r for r in ends(g, n) if r], bounds=(0, HASH_SPAN)
    )
    if not sizes:
        return df.withColumn(name, F.lit(0))
    fold = F.lit(k - 1)
    for f, rank in reversed(list(enumerate(ends(0, sizes[0])))):
        if rank:
            cut = _cut(df, id_col, hashed, found[0][rank], rank)
            fold = F.when(_up_to(id_col, F.col("__hash"), cut), f).otherwise(fold)
    return df.withColumn("__hash", hashed).withColumn(name, fold.cast("int")).drop("__hash")


def leave_one_out(df: DataFrame, id_col: str, name: str = "fold") -> DataFrame:
    """Every row is its own fold, so the id names the fold; see `loo_cv` for the fit."""
    return df.withColumn(name, F.col(id_col).cast("bigint"))


def hash_rank(df: DataFrame, id_col: str, seed, name: str = "rank") -> DataFrame:
    """Exact 1-based position in hash order.

    Rows are grouped by leading hash bits into buckets of bounded size (hashes are uniform), the
    bucket totals give each bucket its offset, and rows are ranked inside their bucket.
    """
    n = df.count()
    buckets = max(1, math.ceil(n / BUCKET_ROWS))
    hashed = df.withColumn("__hash", hash52(id_col, seed)).withColumn(
        "__bucket", F.floor(F.col("__hash") / F.lit(HASH_SPAN / buckets))
    )
    return _rank_in_buckets(hashed, ["__hash", id_col], name).drop("__hash")


def mini_batches(df: DataFrame, id_col: str, size: int, seed, shuffle: bool = True) -> DataFrame:
    """Number the batches of a shuffled (or id-ordered) pass; the last batch may be short."""
    if shuffle:
        ranked = hash_rank(df, id_col, seed, "__rank")
    else:
        ranked = id_rank(df, id_col, "__rank")
    return ranked.withColumn("batch", F.floor((F.col("__rank") - 1) / F.lit(size)).cast("bigint")).drop("__rank")


def id_rank(df: DataFrame, id_col: str, name: str = "rank") -> DataFrame:
    """Exact 1-based position in id order, a NULL id first.

    Cuts between buckets are exact order statistics of the id, so a row's bucket is a function of its id and nothing need be written.
    """
    if not isinstance(df.schema[id_col].dataType, T.NumericType):
        raise TypeError(f"{id_col} is not a number")
    rows = df.select(id_col)
    n = rows.where(F.col(f"`{id_col}`").isNotNull()).count()
    buckets = max(1, math.ceil(n / BUCKET_ROWS))
    ranks = sorted({i * n // buckets for i in range(1, buckets)} - {0})
    cuts = []
    if ranks:
        _, found = order_statistics(rows, F.col(f"`{id_col}`"), lambda _g, _n: ranks)
        cuts = sorted({found[0][r].value for r in ranks})
    return _rank_in_buckets(df.withColumn("__bucket", _bucket_of(F.col(f"`{id_col}`"), cuts)), [id_col], name)


def _bucket_of(value: Column, cuts: list) -> Column:
    """Number of cuts below a value, by bisection of a sorted array: few steps also for very many cuts."""
    if not cuts:
        return F.lit(0).cast("bigint")
    table, low, high = F.array(*[F.lit(c) for c in cuts]), F.lit(0), F.lit(len(cuts))
    bounds = F.struct(low.alias("low"), high.alias("high"))
    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length()))

    def halved(acc: Column, _step: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        above = (acc["low"] < acc["high"]) & (F.get(table, middle) < value)
        return F.struct(
            F.when(above, middle + 1).otherwise(acc["low"]).alias("low"),
            F.when((acc["low"] < acc["high"]) & ~above, middle).otherwise(acc["high"]).alias("high"),
        )

    return F.coalesce(F.aggregate(steps, bounds, halved)["low"].cast("bigint"), F.lit(0).cast("bigint"))


def _rank_in_buckets(df: DataFrame, order: list, name: str, groups: tuple[str, ...] = ()) -> DataFrame:
    """Rows before the bucket plus the place inside it, for buckets that follow each other, in each group for itself."""
    keys = [*groups, "__bucket"]
    earlier = Window.partitionBy(*groups).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(*keys).count()  # one row per half million input rows
    offsets = sizes.select(*keys, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("__offset"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        df.withColumn("__place", place)
        .join(offsets, keys)
        .withColumn(name, (F.col("__offset") + F.col("__place")).cast("bigint"))
        .drop("__bucket", "__offset", "__place")
    )


def shuffle_positions(df: DataFrame, id_col: str, seed, epochs: list[int]) -> DataFrame:
    """Every row once per epoch with its `epoch` and its 0-based `position` in that epoch's order, all epochs in one pass.

    The order is that of a hash, whose leading bits name buckets of bounded size: the counts of earlier buckets and the place inside the own
    one give the position, whatever the partitioning.
    """
    buckets = max(1, math.ceil(df.count() / BUCKET_ROWS))
    each = df.withColumn("epoch", F.explode(F.array(*[F.lit(int(e)) for e in epochs])))
    hashed = each.withColumn("__hash", hash52(id_col, F.concat(F.lit(f"{seed}/"), F.col("epoch").cast("string"))))
    hashed = hashed.withColumn("__bucket", F.floor(F.col("__hash") / F.lit(HASH_SPAN / buckets)))
    ranked = _rank_in_buckets(hashed, ["__hash", id_col], "position", ("epoch",))
    return ranked.withColumn("position", F.col("position") - 1).drop("__hash")


def shuffle_in_partitions(df: DataFrame, id_col: str, seed, epoch: int) -> DataFrame:
    """Another row order per epoch inside every partition, without moving rows."""
    return df.sortWithinPartitions(hash52(id_col, f"{seed}/{epoch}"), id_col)


def shuffle_rows(df: DataFrame, id_col: str, seed, epoch: int) -> DataFrame:
    """Global shuffle: rows are range partitioned by the epoch's hash."""
    return df.orderBy(hash52(id_col, f"{seed}/{epoch}"), id_col)


def pick_row(df: DataFrame, id_col: str, seed) -> DataFrame:
    """The row with the smallest hash, by one aggregate."""
    whole = F.struct(*[F.col(c) for c in df.columns])
    order = F.struct(hash52(id_col, seed), F.col(id_col))
    return df.agg(F.min_by(whole, order).alias("row")).select("row.*")
