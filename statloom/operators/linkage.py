"""Agglomerative clustering with average, single, complete and ward linkage.

The tree is exact at every size: its leaves are the distinct points of the table. All clusters that are each
other's nearest neighbour merge in the same round; for these four linkages that gives the same tree as merging one
pair at a time. No table of pairs is built: tasks recompute the distances they need from the shared points, and only
the nearest neighbour of a cluster leaves a task.

- A cluster keeps its neighbour until one of the two merges: a merged cluster is never nearer than the nearer of its parts.
- Centres and spreads bound the distance of two clusters from below and above. Members meet only where the
  bounds leave it open which cluster is nearest.
- Clusters lie in blocks of near ones; a block looks at those blocks alone whose boxes are in reach.
- Once no more than `MATRIX_CLUSTERS` are left, one pass gives all their distances, and the driver ends the tree.

Single linkage is a minimum spanning tree: every leaf keeps its nearest leaves, and only leaves of a component whose
lightest edge is still open look again.

The heights of average linkage are means over all pairs of rows, so the work stays quadratic in the number of distinct
points. A caller who wants less may name `max_exact` and `condense`: above that many points K-means centres, weighted
by their sizes, become the leaves; every row is still in the tree, and the result says `exact = false`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.vectors import list_column, matrix
from .kmeans import complete_points, features_column, fit_kmeans, nearest_center

MAX_BYTES = 256 * 1024 * 1024
MATRIX_CLUSTERS = 3_000  # clusters whose distances to each other the driver holds, 72 MB
BLOCK_CELLS = 1 << 18  # distances a task holds at once
CACHE_CELLS = 1 << 16  # those of a pass over all pairs
BLOCK_CLUSTERS = 256  # clusters of a block
NEAREST = 8  # leaves that a leaf keeps in single linkage
FEW = 16  # clusters whose rows are summed by a product
CLOSE_PAIRS = 1 << 15  # pairs whose differences are held at once
MARGIN = 1 + 1e-8  # for the rounding of a bound
CONDENSE_STEPS = 20
TASK_WORK = 40_000_000
MERGE_SCHEMA = "step int, left bigint, right bigint, height double, size bigint, exact boolean"
LEVEL_SCHEMA = "step int, depth int, height double, left_size bigint, right_size bigint"


@dataclass
class Tree:
    """Leaves (their points, ids and row counts) and the merges in order of height.

    A cluster is named by the smallest leaf id in it, so names do not depend on the run.
    """

    points: np.ndarray
    ids: np.ndarray
    weights: np.ndarray
    merges: list[tuple]  # (left id, right id, height, size)
    pairs: np.ndarray  # (left leaf, right leaf) of every merge, as positions
    exact: bool
    rounds: int

    def merge_table(self, spark: SparkSession) -> DataFrame:
        n = len(self.merges)
        left, right, height, size = zip(*self.merges) if n else ((), (), (), ())
        columns = [
            pa.array(np.arange(1, n + 1, dtype=np.int32)),
            pa.array(left, pa.int64()),
            pa.array(right, pa.int64()),
            pa.array(height, pa.float64()),
            pa.array(size, pa.int64()),
            pa.array(np.full(n, self.exact)),
        ]
        return spark.createDataFrame(pa.table(columns, names=["step", "left", "right", "height", "size", "exact"]), MERGE_SCHEMA)

    def cut(self, k: int) -> np.ndarray:
        """Cluster 0..k-1 of every leaf after undoing the last k-1 merges, by smallest member id."""
        name = np.arange(len(self.ids))
        kept = self.pairs[: max(0, len(self.ids) - k)]
        name[kept[:, 1]] = kept[:, 0]
        while (name != name[name]).any():
            name = name[name]
        return np.unique(name, return_inverse=True)[1].astype(np.int32)

    def top_levels(self, spark: SparkSession, levels: int) -> DataFrame:
        """Merges at most `levels` below the root, with the sizes of both children."""
        parts = {i: (int(w), -1) for i, w in enumerate(self.weights)}
        children, depth = [], {}
        for step, (a, b) in enumerate(self.pairs.tolist()):
            children.append((parts[a], parts.pop(b)))
            parts[a] = (int(self.merges[step][3]), step)
        for step in reversed(range(len(self.merges))):
            depth.setdefault(step, 0)
            for _, child in children[step]:
                if child >= 0:
                    depth[child] = depth[step] + 1
        rows = [
            (step + 1, depth[step], float(self.merges[step][2]), children[step][0][0], children[step][1][0])
            for step in sorted(depth)
            if depth[step] <= levels
        ]
        return spark.createDataFrame(rows, LEVEL_SCHEMA)

    def assign(self, df: DataFrame, features, k: int, name: str = "cluster") -> DataFrame:
        """Cluster of every row: that of its own point, or of the nearest leaf where its point is no leaf."""
        keys = _row_keys(self.points)
        order = np.argsort(keys, kind="stable")
        shared = df.sparkSession.sparkContext.broadcast((self.points, self.cut(k), keys[order], order))

        @F.arrow_udf("int")
        def label(x: pa.Array) -> pa.Array:
            points, cut, sorted_keys, leaves = shared.value
            rows = matrix(x)
            if not rows.size:
                return pa.array(np.zeros(len(rows), np.int32))
            at = np.minimum(np.searchsorted(sorted_keys, _row_keys(rows)), len(points) - 1)
            found = leaves[at]
            other = np.flatnonzero((points[found] != rows).any(axis=1))
            step = max(1, BLOCK_CELLS // len(points))
            for i in range(0, len(other), step):
                found[other[i : i + step]] = nearest_center(rows[other[i : i + step]], points)[0]
            return pa.array(cut[found], pa.int32())

        return df.withColumn(name, label(features_column(features)))


def _row_keys(rows: np.ndarray) -> np.ndarray:
    """One 64-bit number per row, from the bits of its values; 0.0 and -0.0 are the same."""
    key = np.zeros(len(rows), np.uint64)
    for column in (rows + 0.0).T:
        key = (key ^ np.ascontiguousarray(column).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def fit_tree(
    df: DataFrame,
    id_col: str,
    features: list[str] | str,
    method: str = "average",
    max_exact: int | None = None,
    condense: int | None = None,
    seed: int = 42,
) -> Tree:
    """Merge tree of a table, over all its distinct points.

    Only a caller who names `max_exact` gets less above that many points: `condense` K-means leaves, or an error without it.
    """
    if method not in ("average", "single", "complete", "ward"):
        raise ValueError(f"unknown linkage {method!r}")
    if condense is not None and max_exact is None:
        raise ValueError("name the number of points above which to condense")
    points, ids, weights, exact = _leaves(df, id_col, features, max_exact, condense, seed)
    if points.nbytes > MAX_BYTES:
        raise ValueError(f"{points.nbytes} bytes of leaves exceed the broadcast bound of {MAX_BYTES}")
    merges, rounds = _merge_rounds(df.sparkSession, points, weights.astype(np.float64), method)
    names = [(ids[a], ids[b], h, n) for a, b, h, n in merges]
    pairs = np.array([m[:2] for m in merges], dtype=np.int64).reshape(-1, 2)
    return Tree(points, ids, weights, names, pairs, exact, rounds)


def _leaves(df, id_col, features, max_exact, condense, seed):
    """Distinct points with their row counts, in order of their ids: equal rows are merged before any distance is taken."""
    rows = complete_points(df, id_col, features).withColumn("id", F.col("id").cast("bigint"))
    if max_exact is not None and rows.select("x").distinct().limit(max_exact + 1).count() > max_exact:
        if condense is None:
            raise ValueError(f"more than {max_exact} distinct points; name a number of leaves to condense to")
        run = fit_kmeans(rows, "id", "x", condense, n_init=1, seed=seed, max_iter=CONDENSE_STEPS)
        kept = run.counts > 0
        return run.centers[kept], np.arange(int(kept.sum())), run.counts[kept].astype(np.int64), False
    found = rows.groupBy("x").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")).toArrow().combine_chunks()
    if found["id"].null_count:
        raise ValueError("a point without an id has no name")
    points, ids, counts = matrix(found["x"].combine_chunks()), found["id"].to_numpy(), found["n"].to_numpy()
    order = np.lexsort((*points.T[::-1], ids)) if len(np.unique(ids)) < len(ids) else np.argsort(ids)
    return points[order], ids[order], counts[order], True


def _merge_rounds(spark: SparkSession, points: np.ndarray, weights: np.ndarray, method: str):
    """Merges as (left, right, height, size) in leaf positions, sorted by height."""
    if len(points) < 2:
        return [], 0
    if method == "single":
        edges, rounds = _spanning_edges(spark, points)
    else:
        edges, rounds = _neighbour_edges(spark, points, weights, method)
    return _in_height_order(edges, weights, method), rounds


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _join(parent: list[int], a: int, b: int) -> bool:
    a, b = _root(parent, a), _root(parent, b)
    parent[max(a, b)] = min(a, b)
    return a != b


def _neighbour_edges(spark: SparkSession, points: np.ndarray, weights: np.ndarray, method: str) -> tuple[list[tuple], int]:
    """Merges of average, complete and ward linkage as (height, round, leaf, leaf)."""
    cluster, names = np.arange(len(points)), np.arange(len(points))  # clusters are numbered by their smallest leaf
    nearest, height = np.full(len(points), -1), np.full(len(points), np.inf)
    away = np.zeros(len(points))  # no other leaf is nearer to a leaf
    edges, rounds = [], 0
    while len(names) > MATRIX_CLUSTERS:
        rounds += 1
        a, b, d = _nearest_clusters(spark, points, weights, cluster, nearest < 0, away, method)
        nearest[a], height[a] = b, d
        if rounds == 1 and method != "ward":
            away = height.copy()
        left, right = _mutual(nearest, height)
        edges += zip(height[left].tolist(), [rounds] * len(left), names[left].tolist(), names[right].tolist())
        moved, gone = np.zeros(len(names), bool), np.zeros(len(names), bool)
        moved[left], moved[right], gone[right] = True, True, True
        number = np.cumsum(~gone) - 1
        number[right] = number[left]
        open_ = moved | moved[nearest]  # a merged cluster is never nearer than the nearer of its parts
        nearest = np.where(open_, -1, number[nearest])[~gone]
        height, names, cluster = height[~gone], names[~gone], number[cluster]
    distances, sizes, centers = _cluster_distances(spark, points, weights, cluster, method)
    edges += _matrix_edges(distances, sizes, centers, names, method, rounds)
    return edges, edges[-1][1]


def _mutual(nearest: np.ndarray, height: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Clusters that are each other's nearest.

    Rounding can leave tied clusters without a mutual pair; then the closest pair merges alone.
    """
    numbers = np.arange(len(nearest))
    left = np.flatnonzero((nearest[nearest] == numbers) & (numbers < nearest))
    if not len(left):
        low, high = np.minimum(numbers, nearest), np.maximum(numbers, nearest)
        first = np.lexsort((high, low, height))[0]
        return low[[first]], high[[first]]
    return left, nearest[left]


def _matrix_edges(d: np.ndarray, sizes: np.ndarray, centers: np.ndarray, names: np.ndarray, method: str, rounds: int) -> list[tuple]:
    """The same rounds over a matrix of all distances, infinite from a cluster to itself."""
    edges, stale, numbers = [], np.ones(len(names), bool), np.arange(len(names))
    alive, nearest = numbers, numbers.copy()
    while len(alive) > 1:
        rounds += 1
        again = alive[stale[alive]]
        nearest[again] = d[again].argmin(axis=1)
        other = nearest[alive]
        left, right = _mutual(np.searchsorted(alive, other), d[alive, other])
        left, right = alive[left], alive[right]
        edges += zip(d[left, right].tolist(), [rounds] * len(left), names[left].tolist(), names[right].tolist())
        both = sizes[left] + sizes[right]
        if method == "ward":
            centers[left] = (sizes[left, None] * centers[left] + sizes[right, None] * centers[right]) / both[:, None]
        elif method == "average":
            p, q = sizes[left] / both, sizes[right] / both
            d[left] = p[:, None] * d[left] + q[:, None] * d[right]
            d[:, left] = p * d[:, left] + q * d[:, right]
        else:
            d[left] = np.maximum(d[left], d[right])
            d[:, left] = np.maximum(d[:, left], d[:, right])
        sizes[left] = both
        alive = np.setdiff1d(alive, right, assume_unique=True)
        d[right], d[:, right] = np.inf, np.inf
        if method == "ward":
            d[np.ix_(left, alive)] = _ward(_distances(centers[left], centers[alive]), sizes[left], sizes[alive])
            d[np.ix_(alive, left)] = d[np.ix_(left, alive)].T
            d[left, left] = np.inf
        square = d[np.ix_(left, left)]
        d[np.ix_(left, left)] = np.minimum(square, square.T)  # sums in another order may differ in the last digit
        moved = np.zeros(len(names), bool)
        moved[left], moved[right] = True, True
        stale = moved | moved[nearest]
    return edges


def _ward(d: np.ndarray, sizes: np.ndarray, others: np.ndarray) -> np.ndarray:
    return d * np.sqrt(2.0 * sizes[:, None] * others / (sizes[:, None] + others))


def _in_height_order(edges: list[tuple], weights: np.ndarray, method: str) -> list[tuple]:
    """Join clusters along the edges by rising height, naming each by its smallest leaf."""
    if method != "single":
        edges = _levelled(edges, len(weights))
    parent = list(range(len(weights)))
    rows = {i: int(w) for i, w in enumerate(weights)}
    merges = []
    for height, _, a, b in sorted(edges):
        a, b = sorted((_root(parent, a), _root(parent, b)))
        if _join(parent, a, b):
            rows[a] += rows[b]
            merges.append((a, b, height, rows[a]))
    return merges


def _levelled(edges: list[tuple], n: int) -> list[tuple]:
    """Lift a merge that rounding left a digit below one of the merges inside it."""
    parent, reached, result = list(range(n)), {}, []
    for height, number, a, b in sorted(edges, key=lambda e: e[1]):
        inside = [reached.get(_root(parent, i), 0.0) for i in (a, b)]
        _join(parent, a, b)
        reached[_root(parent, a)] = max(height, *inside)
        result.append((max(height, *inside), number, a, b))
    return result


def _task_count(spark: SparkSession, work: int, most: int) -> int:
    return int(max(1, min(4 * spark.sparkContext.defaultParallelism, 1 + work // TASK_WORK, most)))


def _run_slices(spark: SparkSession, count: int, work, schema: str) -> DataFrame:
    """One task per slice; `work(number)` gives its Arrow batch."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(0).to_pylist():
                yield work(t)

    return spark.range(0, count, 1, count).mapInArrow(task, schema)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Numbers of all ranges, one after the other."""
    lengths = ends - starts
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


def _squared(block: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances by a matrix product; close pairs, where it loses digits, by differences."""
    own, other, width = (block**2).sum(axis=1), (points**2).sum(axis=1), block.shape[1]
    left, right = np.ones((len(block), width + 2)), np.ones((len(points), width + 2))
    left[:, :width], left[:, width] = -2.0 * block, own
    right[:, :width], right[:, width + 1] = points, other
    squared = left @ right.T
    limit = 1e-6 * (own.max(initial=0.0) + other.max(initial=0.0))
    if squared.min(initial=np.inf) < limit:
        i, j = np.nonzero(squared < limit)
        close = squared[i, j] < 1e-6 * (own[i] + other[j])
        i, j = i[close], j[close]
        for a in range(0, len(i), CLOSE_PAIRS):  # near copies may be all pairs of a block
            some = i[a : a + CLOSE_PAIRS], j[a : a + CLOSE_PAIRS]
            squared[some] = ((block[some[0]] - points[some[1]]) ** 2).sum(axis=1)
    return squared


def _distances(block: np.ndarray, points: np.ndarray) -> np.ndarray:
    squared = _squared(block, points)
    return np.sqrt(squared, out=squared)


@dataclass
class Blocks:
    """Points in an order that keeps near ones together, in blocks with their boxes."""

    order: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def near(self, points: np.ndarray, reach: Callable[[], float]) -> Iterator[np.ndarray]:
        """Positions of the blocks within reach of the points, the nearest first; the reach may shrink on the way."""
        gap = np.maximum(self.low - points.max(axis=0), points.min(axis=0) - self.high)
        gap = np.sqrt((np.maximum(gap, 0.0) ** 2).sum(axis=1))
        order, at = np.argsort(gap, kind="stable"), 0
        step = max(1, BLOCK_CELLS // (len(points) * BLOCK_CLUSTERS))
        while at < len(order):
            some = order[at : at + step]
            some = some[gap[some] <= reach() * MARGIN]
            if not len(some):
                return
            yield _ranges(self.starts[some], self.ends[some])
            at += step


def _blocks(points: np.ndarray) -> Blocks:
    """Halves of halves along the widest side of their box."""
    order, todo, starts = np.arange(len(points)), [(0, len(points))], []
    while todo:
        first, last = todo.pop()
        if last - first <= BLOCK_CLUSTERS:
            starts.append(first)
            continue
        block, middle = points[order[first:last]], (last - first) // 2
        side = block[:, np.ptp(block, axis=0).argmax()]
        order[first:last] = order[first:last][np.argpartition(side, middle)]
        todo += [(first, first + middle), (first + middle, last)]
    starts = np.sort(np.array(starts))
    low, high = (f.reduceat(points[order], starts, axis=0) for f in (np.minimum, np.maximum))
    return Blocks(order, starts, np.append(starts[1:], len(points)), low, high)


@dataclass
class Clusters:
    """Clusters in the order of blocks, with what bounds their distances. Members of a cluster are neighbours in `points`."""

    blocks: Blocks
    points: np.ndarray
    weights: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    sizes: np.ndarray  # rows
    centers: np.ndarray
    spread: np.ndarray  # mean squared distance of the rows to the centre
    radius: np.ndarray
    away: np.ndarray  # no member has a leaf of another cluster nearer than that
    widest: float  # no two leaves are farther apart
    stale: np.ndarray
    method: str

    def bounds(self, rows: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest distance that two clusters can have."""
        d = _distances(self.centers[rows], self.centers[others])
        if self.method == "ward":
            d = _ward(d, self.sizes[rows], self.sizes[others])
            return d, d
        if not self.spread.any():
            return d, d
        reach = self.radius[rows, None] + self.radius[others]
        far = np.minimum(d + reach, self.widest)
        mean = d * d  # of the squared distances
        mean += self.spread[rows, None] + self.spread[others]
        root = np.sqrt(mean)
        if self.method == "complete":
            return root, np.maximum(far, root)
        near = np.maximum(d - reach, np.maximum(self.away[rows, None], self.away[others]))
        near = np.minimum(near, far)
        # the root is concave: above its chord between near and far, below its value at the mean
        mean += near * far
        mean /= np.maximum(near + far, 1e-300)
        return np.minimum(np.maximum(mean, d), root), root

    def nearest(self, number: int) -> Iterator[tuple[int, int, float]]:
        """(cluster, nearest other cluster, distance) of the stale clusters of a block."""
        first, last = self.blocks.starts[number], self.blocks.ends[number]
        rows = first + np.flatnonzero(self.stale[first:last])
        if not len(rows):
            return
        reach, found = np.full(len(rows), np.inf), []
        for others in self.blocks.near(self.centers[rows], lambda: reach.max()):
            low, high = self.bounds(rows, others)
            same = rows[:, None] == others
            high = np.where(same, np.inf, high)
            reach = np.minimum(reach, high.min(axis=1))
            i, j = np.nonzero((low <= reach[:, None] * MARGIN) & ~same)
            found.append((i, others[j], low[i, j]))
        i, other, low = (np.concatenate(f) for f in zip(*found))
        kept = low <= reach[i] * MARGIN
        i, other, low = i[kept], other[kept], low[kept]
        names = self.blocks.order
        order = np.lexsort((names[other], low, i))
        i, other, low = i[order], other[order], low[order]
        single = self.ends - self.starts == 1
        known = single[rows[i]] & single[other] if self.method != "ward" else np.ones(len(i), bool)
        begins = np.flatnonzero(np.diff(i, prepend=-1))
        for begin, end in zip(begins, np.append(begins[1:], len(i))):
            a = rows[i[begin]]
            if known[begin:end].all():
                yield int(names[a]), int(names[other[begin]]), float(low[begin])
            else:
                b, d = self._nearest_of(a, other[begin:end], low[begin:end])
                yield int(names[a]), int(names[b]), d

    def _nearest_of(self, a: int, others: np.ndarray, low: np.ndarray) -> tuple[int, float]:
        """The nearest of some clusters, by rising lower bounds: most of them are never looked at."""
        best, at, step = (np.inf, -1, -1), 0, 8
        while at < len(others) and low[at] <= best[0] * MARGIN:
            some = others[at : at + step]
            some = some[low[at : at + step] <= best[0] * MARGIN]
            d = self._exact(a, some)
            names = self.blocks.order[some]
            first = np.lexsort((names, d))[0]
            best = min(best, (float(d[first]), int(names[first]), int(some[first])))
            at, step = at + step, 4 * step
        return best[2], best[0]

    def _exact(self, a: int, others: np.ndarray) -> np.ndarray:
        lengths = self.ends[others] - self.starts[others]
        columns = _ranges(self.starts[others], self.ends[others])
        own = slice(self.starts[a], self.ends[a])
        total = _summed(self.points[own], self.weights[own], self.points[columns], self.method)
        begins = np.cumsum(lengths) - lengths
        if self.method == "complete":
            return np.maximum.reduceat(total, begins)
        return np.add.reduceat(total * self.weights[columns], begins) / (self.sizes[a] * self.sizes[others])


def _summed(block: np.ndarray, weights: np.ndarray, points: np.ndarray, method: str) -> np.ndarray:
    """Weighted sum (or maximum) over the block of the distances to every point."""
    total, rows = np.zeros(len(points)), min(len(block), 256)
    columns = max(1, CACHE_CELLS // rows)
    for j in range(0, len(points), columns):
        for i in range(0, len(block), rows):
            d = _distances(block[i : i + rows], points[j : j + columns])
            part = total[j : j + columns]
            if method == "complete":
                np.maximum(part, d.max(axis=0), out=part)
            else:
                part += weights[i : i + rows] @ d
    return total


def _nearest_clusters(
    spark: SparkSession, points: np.ndarray, weights: np.ndarray, cluster: np.ndarray, stale: np.ndarray, away: np.ndarray, method: str
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stale clusters, the nearest other cluster of each, and the distance."""
    shared = spark.sparkContext.broadcast(_clusters(points, weights, cluster, stale, away, method))
    blocks = len(shared.value.blocks.starts)
    tasks = _task_count(spark, int(stale.sum()) * len(points) * points.shape[1], blocks)

    def work(task: int) -> pa.RecordBatch:
        found = [row for number in range(task, blocks, tasks) for row in shared.value.nearest(number)]
        columns = [pa.array([f[c] for f in found], t) for c, t in enumerate((pa.int32(), pa.int32(), pa.float64()))]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "d"])

    try:
        found = _run_slices(spark, tasks, work, "a int, b int, d double").toArrow()  # one row per cluster
        return tuple(found[c].to_numpy() for c in "abd")
    finally:
        shared.destroy()


def _clusters(points, weights, cluster, stale, away, method) -> Clusters:
    order = np.argsort(cluster, kind="stable")
    starts = np.flatnonzero(np.diff(cluster[order], prepend=-1))
    lengths = np.diff(starts, append=len(points))
    sizes, centers = _centers(points[order], weights[order], starts)
    single = lengths == 1
    centers[single] = points[order[starts[single]]]
    blocks = _blocks(centers)
    rank = np.empty(len(starts), np.int64)
    rank[blocks.order] = np.arange(len(starts))
    order = np.argsort(rank[cluster], kind="stable")
    lengths, sizes, centers = lengths[blocks.order], sizes[blocks.order], centers[blocks.order]
    ends = np.cumsum(lengths)
    starts = ends - lengths
    points, weights = points[order], weights[order]
    squares = ((points - np.repeat(centers, lengths, axis=0)) ** 2).sum(axis=1)
    widest = 2.0 * np.sqrt(((points - points.mean(axis=0)) ** 2).sum(axis=1).max())
    return Clusters(
        blocks, points, weights, starts, ends, sizes, centers,
        np.add.reduceat(squares * weights, starts) / sizes, np.sqrt(np.maximum.reduceat(squares, starts)),
        np.minimum.reduceat(away[order], starts), float(widest), stale[blocks.order], method,
    )


def _centers(points: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.add.reduceat(weights, starts)
    return sizes, np.add.reduceat(points * weights[:, None], starts, axis=0) / sizes[:, None]


def _cluster_distances(
    spark: SparkSession, points: np.ndarray, weights: np.ndarray, cluster: np.ndarray, method: str
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distances of at most MATRIX_CLUSTERS clusters from each other, with their sizes and centres."""
    order = np.argsort(cluster, kind="stable")
    starts = np.flatnonzero(np.diff(cluster[order], prepend=-1))
    points, weights, cluster = points[order], weights[order], cluster[order]
    sizes, centers = _centers(points, weights, starts)
    if method == "ward":
        d = _ward(_distances(centers, centers), sizes, sizes)
    else:
        n, d = len(points), np.zeros((len(starts), len(starts)))
        tasks = _task_count(spark, n * n * points.shape[1] // 2, n)
        # a leaf meets those behind it: equal shares of the pairs
        cuts = n - np.sqrt(np.linspace(n**2, 0, tasks + 1)).astype(int)
        shared = spark.sparkContext.broadcast((points, weights, cluster, starts, method))
        try:
            rows = _run_slices(spark, tasks, lambda t: _slice_sums(cuts[t], cuts[t + 1], *shared.value), "a int, sums array<double>")
            found = rows.toArrow()  # half of the matrix, and one row more for each task
        finally:
            shared.destroy()
        for a, sums in zip(found["a"].to_numpy(), found["sums"]):
            part, sums = d[a, a:], sums.values.to_numpy()
            part[:] = part + sums if method == "average" else np.maximum(part, sums)
        if method == "average":
            d /= sizes[:, None] * sizes
    d = np.triu(d, 1)
    d += d.T
    np.fill_diagonal(d, np.inf)
    return d, sizes, centers


def _slice_sums(first: int, last: int, points, weights, cluster, starts, method) -> pa.RecordBatch:
    """Sums (or maxima) of the distances from the leaves of a slice, by cluster, to the own cluster and all behind it."""
    found: dict[int, np.ndarray] = {}
    reduce_by = np.maximum if method == "complete" else np.add
    for i in range(first, last, 256):
        block = slice(i, min(last, i + 256))
        own, inner = np.unique(cluster[block], return_index=True)
        begin = starts[own[0]]
        total = np.empty((len(own), len(points) - begin))
        step = max(1, CACHE_CELLS // 256)
        for j in range(begin, len(points), step):
            d = _distances(points[block], points[j : j + step])
            total[:, j - begin : j - begin + step] = _by_rows(d, weights[block], inner, method)
        if method == "average":
            total *= weights[begin:]
        sums = reduce_by.reduceat(total, starts[own[0] :] - begin, axis=1)
        for a, row in zip(own, sums):
            row = row[a - own[0] :]
            found[a] = reduce_by(found[a], row) if a in found else row.copy()
    return pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.list_(pa.float64()))], names=["a", "sums"]
    )


def _by_rows(d: np.ndarray, weights: np.ndarray, inner: np.ndarray, method: str) -> np.ndarray:
    """Weighted sums (or maxima) over the runs of rows that begin at `inner`."""
    if method == "average":
        if len(inner) <= FEW:
            which = np.repeat(np.arange(len(inner)), np.diff(inner, append=len(d)))
            return np.where(which == np.arange(len(inner))[:, None], weights, 0.0) @ d
        d *= weights[:, None]
    if len(inner) == len(d):
        return d
    return (np.maximum if method == "complete" else np.add).reduceat(d, inner, axis=0)


def _spanning_edges(spark: SparkSession, points: np.ndarray) -> tuple[list[tuple], int]:
    """Edges of the minimum spanning tree as (length, round, leaf, leaf).

    In every round each component but the largest takes its lightest outgoing edge. A leaf knows its nearest leaves; it
    looks again when none of them is outside of its component and a lighter edge than the component's best is possible.
    """
    n, blocks = len(points), _blocks(points)
    near, length = np.full((n, NEAREST), -1), np.full((n, NEAREST), np.inf)
    beyond = np.zeros(n)  # all other leaves outside of the component are at least that far
    component, edges, rounds = np.arange(n), [], 0
    shared = spark.sparkContext.broadcast((blocks, points[blocks.order]))
    try:
        while (count := component.max() + 1) > 1:
            rounds += 1
            small = component != np.bincount(component).argmax()
            out, d = _first_outside(component, near, length)
            best = np.full(count, np.inf)
            np.minimum.at(best, component, d)
            stale = small & (out < 0) & (beyond <= best[component])
            if stale.any():
                u, near[stale], length[stale] = _nearest_leaves(spark, shared, component, stale, points.shape[1])
                full = length[stale][:, -1]
                beyond[stale] = full / MARGIN
                out, d = _first_outside(component, near, length)
            chosen = np.flatnonzero(small & (out >= 0))
            low, high = np.minimum(chosen, out[chosen]), np.maximum(chosen, out[chosen])
            order = np.lexsort((high, low, d[chosen], component[chosen]))
            heads = order[np.flatnonzero(np.diff(component[chosen][order], prepend=-1))]
            parent = list(range(count))
            for e in heads[np.lexsort((high[heads], low[heads], d[chosen[heads]]))].tolist():
                if _join(parent, component[low[e]], component[high[e]]):
                    edges.append((float(d[chosen[e]]), rounds, int(low[e]), int(high[e])))
            component = np.unique([_root(parent, c) for c in range(count)], return_inverse=True)[1][component]
    finally:
        shared.destroy()
    return edges, rounds


def _first_outside(component: np.ndarray, near: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest known leaf outside of the own component (-1 for none) and its distance."""
    outside = (near >= 0) & (component[near] != component[:, None])
    first, known, rows = outside.argmax(axis=1), outside.any(axis=1), np.arange(len(near))
    return np.where(known, near[rows, first], -1), np.where(known, length[rows, first], np.inf)


def _nearest_leaves(spark: SparkSession, shared, component: np.ndarray, stale: np.ndarray, width: int):
    """Stale leaves in order, and the NEAREST leaves outside of the own component of each with their distances, nearest first."""
    order = shared.value[0].order
    state = spark.sparkContext.broadcast((component[order], stale[order]))
    blocks = len(shared.value[0].starts)
    tasks = _task_count(spark, int(stale.sum()) * len(stale) * width, blocks)

    def work(task: int) -> pa.RecordBatch:
        found = [_block_leaves(number, *shared.value, *state.value) for number in range(task, blocks, tasks)]
        leaves, near, length = (np.concatenate(f) for f in zip(*found))
        columns = [pa.array(leaves, pa.int64()), list_column(near), list_column(length)]
        return pa.RecordBatch.from_arrays(columns, names=["u", "near", "length"])

    try:
        found = _run_slices(spark, tasks, work, "u bigint, near array<bigint>, length array<double>").toArrow()
    finally:
        state.destroy()
    u = found["u"].to_numpy()
    sorted_ = np.argsort(u)
    near, length = (found[c].combine_chunks().flatten().to_numpy().reshape(-1, NEAREST) for c in ("near", "length"))
    return u[sorted_], near[sorted_], length[sorted_]


def _block_leaves(number: int, blocks: Blocks, points, component, stale) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = blocks.starts[number] + np.flatnonzero(stale[blocks.starts[number] : blocks.ends[number]])
    near, length = np.full((len(rows), NEAREST), -1), np.full((len(rows), NEAREST), np.inf)
    if not len(rows):
        return rows, near, length
    limit = np.full(len(rows), np.inf)  # squared distance of the last leaf kept
    i, other, d = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    for others in blocks.near(points[rows], lambda: np.sqrt(limit.max())):
        squared = _squared(points[rows], points[others])
        squared[component[rows, None] == component[others]] = np.inf
        fresh = np.flatnonzero(limit == np.inf)
        if len(fresh) and len(others) >= NEAREST:
            limit[fresh] = np.partition(squared[fresh], NEAREST - 1, axis=1)[:, NEAREST - 1]
        more, at = np.nonzero((squared <= limit[:, None]) & (squared < np.inf))
        if not len(more):
            continue
        i, other, d = np.append(i, more), np.append(other, others[at]), np.append(d, squared[more, at])
        order = np.lexsort((blocks.order[other], d, i))
        i, other, d = i[order], other[order], d[order]
        begins = np.searchsorted(i, np.arange(len(rows)))
        kept = np.arange(len(i)) - begins[i] < NEAREST
        i, other, d = i[kept], other[kept], d[kept]
        full = np.flatnonzero(np.bincount(i, minlength=len(rows)) == NEAREST)
        limit[full] = d[np.searchsorted(i, full, side="right") - 1]
    d = np.sqrt(((points[rows[i]] - points[other]) ** 2).sum(axis=1))  # the same from both ends
    order = np.lexsort((blocks.order[other], d, i))
    i, other, d = i[order], other[order], d[order]
    place = np.arange(len(i)) - np.searchsorted(i, np.arange(len(rows)))[i]
    near[i, place], length[i, place] = blocks.order[other], d
    return blocks.order[rows], near, length
