"""K-means with many starts and many k in one job per iteration.

Starting centres come from rounds over all rows: each round draws rows with a chance in proportion to their squared distance from what is
drawn already, all rows are then counted to their nearest drawn row, and the centres of every k are picked among the drawn ones by
weight times squared distance. Draws depend on the id and the seed alone, so the fit is the same on any partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash52, uniform
from ..functions.numeric import squared_distance
from ..plans.vectors import collect_vectors, list_column, matrix

ROUNDS = 4  # rounds of drawing
DRAWN = 2  # rows drawn in a round, times the largest k
BLOCK_VALUES = 1 << 20  # numbers in the centres of the runs that one pass advances
DEALT_ROWS = 10_000  # fewer rows are not spread over more tasks
DEALT_VALUES = 1 << 22  # numbers of a task's rows, where there are more tasks than cores
CELLS = 1 << 20  # scores of rows against centres that a task holds at once
FEW = 32  # centres that are compared one after the other
ROUNDING = 1e-24  # a squared shift of the centres, as a share of the variance, that is no movement but rounding
CENTER_SCHEMA = "run int, k int, cluster int, center array<double>, n bigint, converged boolean"


@dataclass
class KMeansRun:
    run: int
    k: int
    centers: np.ndarray
    counts: np.ndarray
    inertia: float
    iterations: int
    converged: bool = False


def features_column(features: list[str] | str) -> Column:
    """One array of doubles, from scalar columns or from an array column."""
    if isinstance(features, str):
        return F.col(features).cast("array<double>")
    return F.array(*[F.col(f"`{f}`").cast("double") for f in features])


def complete_points(df: DataFrame, id_col: str, features: list[str] | str) -> DataFrame:
    """Id and vector of the rows without a missing value."""
    rows = df.select(F.col(id_col).alias("id"), features_column(features).alias("x"))
    return rows.where(F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))


def fit_kmeans_runs(
    df: DataFrame,
    id_col: str,
    features: list[str] | str,
    ks: list[int],
    n_init: int = 10,
    seed: int = 42,
    max_iter: int = 300,
    tol: float = 1e-4,
) -> list[KMeansRun]:
    """Fit every (k, start) pair; pairs advance together, as many in a pass over the data as BLOCK_VALUES allows.

    A run has `converged` when its centres move by no more than tol times the mean feature variance, and takes no part in further
    passes; one that still moves after `max_iter` steps says so.
    """
    rows = complete_points(df, id_col, features)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        first = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
        n, width = first
        if n == 0:
            raise ValueError("no rows to cluster")
        rows = _dealt(rows, n, width)
        drawn = _drawn_rows(rows, n_init, DRAWN * max(ks), seed)
        weights = _nearest_counts(rows, drawn, width)
        runs = []
        for k in ks:
            for start in range(n_init):
                centers = _picked(drawn[start], weights[start], k)
                runs.append(KMeansRun(len(runs), k, centers, np.zeros(len(centers)), 0.0, 0))
        limit = (tol + ROUNDING) * _mean_variance(rows, n, width)
        active = runs
        for _ in range(max_iter):
            sums = _sums_of(rows, active, width, errors=False)
            for r in active:
                r.converged = _update(r, sums) <= limit
                r.iterations += 1
            active = [r for r in active if not r.converged]
            if not active:
                break
        sums = _sums_of(rows, runs, width)  # sizes and errors for the final centres
        for r in runs:
            block = np.array([sums[(r.run, c)] if (r.run, c) in sums else np.zeros(width + 2) for c in range(len(r.centers))])
            r.counts, r.inertia = block[:, 0], float(block[:, 1].sum())
        return runs
    finally:
        rows.unpersist()


def _dealt(rows: DataFrame, n: int, width: int) -> DataFrame:
    """The rows over all cores: a small file is read by one task, which every pass would then wait for."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = max(min(cores, -(-n // DEALT_ROWS)), -(-n * width // DEALT_VALUES))
    if parts == 1:
        return rows
    dealt = rows.repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)
    dealt.count()
    rows.unpersist()
    return dealt


def _drawn_rows(rows: DataFrame, starts: int, number: int, seed: int) -> list[np.ndarray]:
    """Per start the rows drawn: the one of smallest hash, then `number` more in each round.

    A round takes the rows with the smallest -ln(u) / d2, u a uniform number from the id and d2 the squared distance to the nearest row
    drawn before: a sample without replacement with chances in proportion to d2 (Efraimidis and Spirakis, 2006). A task
    passes on its `number` best rows for each start.
    """
    names = [f"h{s}" for s in range(starts)]
    hashes = rows.select("id", "x", *[hash52("id", f"{seed}/{s}/0").alias(n) for s, n in enumerate(names)])
    firsts = hashes.agg(*[F.min_by("x", F.struct(n, "id")).alias(n) for n in names]).first()
    drawn = [np.array([list(x)], dtype=np.float64) for x in firsts]
    for turn in range(1, ROUNDS + 1):
        with_u = rows.select("id", "x", F.array(*[uniform("id", f"{seed}/{s}/{turn}") for s in range(starts)]).alias("u"))
        kept = with_u.mapInArrow(_best_draws(drawn, number), f"start int, chance double, id {rows.schema['id'].dataType.simpleString()}, x array<double>")
        order = Window.partitionBy("start").orderBy("chance", "id")  # at most `number` rows a task and start
        best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= number)
        found: dict[int, list] = {}
        for r in best.orderBy("start", "rank").collect():
            found.setdefault(r["start"], []).append(r["x"])
        for start, more in found.items():
            drawn[start] = np.concatenate([drawn[start], np.array(more, dtype=np.float64)])
    return drawn


def _best_draws(drawn: list[np.ndarray], number: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch | None] = [None] * len(drawn)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, u = matrix(batch.column("x")), matrix(batch.column("u"))
            for start, points in enumerate(drawn):
                d2 = nearest_center(x, points)[1]
                away = np.flatnonzero(d2 > 0)
                with np.errstate(divide="ignore"):
                    chance = -np.log(u[away, start]) / d2[away]
                # a task's best rows, and any that tie with the last of them
                if len(chance) > number:
                    inside = chance <= np.partition(chance, number - 1)[number - 1]
                    away, chance = away[inside], chance[inside]
                rows = batch.take(pa.array(away))
                new = pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(away), start, np.int32)), pa.array(chance), rows.column("id"), rows.column("x")], ["start", "chance", "id", "x"]
                )
                if kept[start] is not None:
                    new = pa.Table.from_batches([kept[start], new]).sort_by([("chance", "ascending"), ("id", "ascending")])
                    new = new.slice(0, number).combine_chunks()
                    new = new.to_batches()[0] if new.num_rows else kept[start]
                kept[start] = new
        yield from (k for k in kept if k is not None and k.num_rows)

    return task


def _nearest_counts(rows: DataFrame, drawn: list[np.ndarray], width: int) -> list[np.ndarray]:
    """How many rows are nearest to each drawn row."""
    runs = [KMeansRun(s, len(points), points, np.zeros(len(points)), 0.0, 0) for s, points in enumerate(drawn)]
    sums = _sums_of(rows, runs, width)
    return [np.array([sums[(r.run, c)][0] for c in range(len(r.centers))]) for r in runs]


def _picked(points: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """Up to k of the points: the heaviest, then always the one of largest weight times squared distance to those picked; first on a tie."""
    chosen = [int(weights.argmax())]
    nearest = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k:
        value = weights * nearest
        best = int(value.argmax())
        if value[best] <= 0:
            break  # fewer distinct points than centres
        chosen.append(best)
        nearest = np.minimum(nearest, ((points - points[best]) ** 2).sum(axis=1))
    return points[chosen]


def _mean_variance(rows: DataFrame, n: int, width: int) -> float:
    origin = KMeansRun(0, 1, np.zeros((1, width)), np.zeros(1), 0.0, 0)
    whole = _partial_sums(rows, [origin], width)[(0, 0)]
    return max(0.0, float(whole[1] / n - ((whole[2:] / n) ** 2).sum())) / width


def _sums_of(rows: DataFrame, runs: list[KMeansRun], width: int, errors: bool = True) -> dict:
    """`_partial_sums` of any number of runs, in blocks whose centres have about BLOCK_VALUES numbers."""
    found, block, held = {}, [], 0
    for r in runs:
        if block and held + r.centers.size > BLOCK_VALUES:
            found |= _partial_sums(rows, block, width, errors)
            block, held = [], 0
        block.append(r)
        held += r.centers.size
    return found | _partial_sums(rows, block, width, errors)


def _partial_sums(rows: DataFrame, runs: list[KMeansRun], width: int, errors: bool = True) -> dict:
    """Per (run, cluster): count, squared error (0 without `errors`) and feature sums of the assigned rows."""
    broadcast = rows.sparkSession.sparkContext.broadcast([(r.run, r.centers) for r in runs])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(c), width + 2)) for _, c in broadcast.value]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(0))
            columns = np.ascontiguousarray(x.T)
            for total, (_, centers) in zip(totals, broadcast.value):
                k = len(centers)
                if errors:
                    label, d2 = nearest_center(x, centers)
                    total[:, 1] += np.bincount(label, d2, k)
                else:
                    label = nearest_label(x, centers)
                total[:, 0] += np.bincount(label, minlength=k)
                for j, column in enumerate(columns):
                    total[:, 2 + j] += np.bincount(label, column, k)
        ids = [(run, c) for run, centers in broadcast.value for c in range(len(centers))]
        values = np.concatenate(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array([i[0] for i in ids], pa.int32()), pa.array([i[1] for i in ids], pa.int32()), list_column(values)],
            names=["run", "cluster", "sums"],
        )

    try:
        partial = rows.select("x").mapInArrow(task, "run int, cluster int, sums array<double>")
        return collect_vectors(partial, ["run", "cluster"], "sums", width + 2)
    finally:
        broadcast.destroy()


def nearest_center(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest centre (lowest index on a tie) and the squared distance to it."""
    label = nearest_label(x, centers)
    return label, ((x - centers[label]) ** 2).sum(axis=1)


def nearest_label(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Index of the nearest centre, in slices of rows that bound the scores held.

    Rows and centres are moved by the mean centre first: far from the origin the products would swallow the differences.
    """
    middle = centers.mean(axis=0)
    near = centers - middle
    own = (near**2).sum(axis=1)[:, None]
    label, step = np.zeros(len(x), np.int64), max(1, CELLS // len(centers))
    for i in range(0, len(x), step):
        scores = near @ (x[i : i + step] - middle).T
        scores *= -2.0
        scores += own
        if len(centers) > FEW:
            label[i : i + step] = scores.argmin(axis=0)
            continue
        best = scores[0]
        for c in range(1, len(centers)):
            np.putmask(label[i : i + step], scores[c] < best, c)
            best = np.minimum(best, scores[c])
    return label


def _update(run: KMeansRun, sums: dict) -> float:
    """Move centres to the mean of their rows; an empty cluster stays. Returns the shift."""
    moved = run.centers.copy()
    for c in range(len(moved)):
        s = sums[(run.run, c)]
        if s[0] > 0:
            moved[c] = s[2:] / s[0]
    shift = float(((moved - run.centers) ** 2).sum())
    run.centers = moved
    return shift


def best_run(runs: list[KMeansRun], k: int) -> KMeansRun:
    """Lowest inertia among the starts, with clusters renumbered by their centre."""
    best = min((r for r in runs if r.k == k), key=lambda r: (r.inertia, r.run))
    order = sorted(range(len(best.centers)), key=lambda i: tuple(best.centers[i]))
    return KMeansRun(best.run, k, best.centers[order], best.counts[order], best.inertia, best.iterations, best.converged)


def fit_kmeans(df: DataFrame, id_col: str, features, k: int, n_init: int = 10, seed: int = 42, **options) -> KMeansRun:
    return best_run(fit_kmeans_runs(df, id_col, features, [k], n_init, seed, **options), k)


def centers_table(spark: SparkSession, runs: list[KMeansRun]) -> DataFrame:
    rows = [
        (r.run, r.k, c, [float(v) for v in center], int(n), r.converged)
        for r in runs
        for c, (center, n) in enumerate(zip(r.centers, r.counts))
    ]
    return spark.createDataFrame(rows, CENTER_SCHEMA)


def elbow(df: DataFrame, id_col: str, features, ks: list[int], n_init: int = 10, seed: int = 42, **options) -> DataFrame:
    """Smallest within-cluster sum of squares per k over all starts, and whether that run's centres came to rest."""
    runs = fit_kmeans_runs(df, id_col, features, ks, n_init, seed, **options)
    best = [best_run(runs, k) for k in ks]
    return df.sparkSession.createDataFrame([(r.k, r.inertia, r.converged) for r in best], "k int, wcss double, converged boolean")


INLINE_TERMS = 400  # more go to an Arrow function, which gives the same rows


def assign(df: DataFrame, features: list[str] | str, centers: np.ndarray, name: str = "cluster") -> DataFrame:
    """Nearest centre and squared distance per row; the lowest cluster id wins a tie. A row with a missing value gets NULL for both."""
    k, width = centers.shape
    x = features_column(features)
    whole = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v))
    if not isinstance(features, str) and k * width <= INLINE_TERMS:
        values = [F.col(f"`{f}`").cast("double") for f in features]
        options = [
            F.struct(squared_distance(values, [F.lit(float(v)) for v in c]).alias("d2"), F.lit(i).alias("c"))
            for i, c in enumerate(centers)
        ]
        best = F.array_min(F.array(*options))
    else:
        best = _nearest_udf(df.sparkSession, centers)(x)
    return df.withColumn("__best", F.when(whole, best)).withColumns({name: F.col("__best.c"), "d2": F.col("__best.d2")}).drop("__best")


def _nearest_udf(spark: SparkSession, centers: np.ndarray):
    shared = spark.sparkContext.broadcast(centers)

    @F.arrow_udf("c int, d2 double")
    def nearest(x: pa.Array) -> pa.Array:
        rows = matrix(x)
        label, d2 = nearest_center(rows, shared.value) if rows.size else (np.zeros(len(x)), np.zeros(len(x)))
        return pa.StructArray.from_arrays([pa.array(label, pa.int32()), pa.array(d2, pa.float64())], names=["c", "d2"])

    return nearest


def update_centers(assigned: DataFrame, features: list[str], cluster: str = "cluster") -> DataFrame:
    """Mean of the members of every cluster: one step of the fit."""
    return assigned.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f"`{f}`").alias(f) for f in features]
    )


def inertia(assigned: DataFrame) -> DataFrame:
    return assigned.agg(F.sum("d2").alias("inertia"))
