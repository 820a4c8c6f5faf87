"""Exact split search for trees: bin, bound, and open only the bins that can hold the best cut.

For every open node and feature, tasks sum statistics per bin of the feature's values; Spark adds up the bins. The gain of a cut at an
edge between bins is then known. Inside a bin it has an upper bound: gains are jointly convex in the sums on the left side, and
the sums of any part of a bin lie in a polygon that follows from the range of its targets and its sum of positive ones, so no cut inside gains
more than the best corner of that polygon. Bins whose bound reaches the best known gain are cut into smaller bins in the next pass; once they hold few
rows, their single values are counted. What no bin can beat is the best of all cuts, in any volume and for any distribution of values.

The search takes any additive statistic: sums of a target and a weight (squared error, or gradient and curvature), or class counts. Rows may
have a whole weight for each of several trees, which grow together in the same passes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.vectors import matrix

BIN_SLOTS = 32_768  # bins of one pass, over all nodes, features and trees
MOST_BINS = 256  # bins that one bin is cut into
VALUE_ROWS = 100_000  # rows of open bins whose values are counted one by one
TIE_DIGITS = 10
COUNT, WEIGHT, SUM, SQUARE, POSITIVE = range(5)  # columns of sums; the last over rows of positive target


@dataclass
class Node:
    """A node by its totals; `low` and `high` bound its features, `least` and `most` its ratios of target and curvature."""

    totals: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: float = 0.0
    most: float = 0.0
    centre: float = 0.0  # what its target is measured from
    feature: int = -1
    threshold: float = 0.0


@dataclass
class Tree:
    """Nodes by number: the root is 1, the children of i are 2i (at most the threshold) and 2i + 1."""

    depth: int
    nodes: dict[int, Node] = field(default_factory=dict)

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        feature, threshold = np.full(2 << self.depth, -1), np.zeros(2 << self.depth)
        for i, node in self.nodes.items():
            feature[i], threshold[i] = node.feature, node.threshold
        return feature, threshold


def descend(arrays: tuple[np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Number of the node where each row of x ends."""
    feature, threshold = arrays
    node, rows = np.ones(len(x), dtype=np.int64), np.arange(len(x))
    while True:
        f = feature[node]
        inner = f >= 0
        if not inner.any():
            return node
        right = x[rows, np.maximum(f, 0)] > threshold[node]
        node = np.where(inner, 2 * node + right, node)


class Sums:
    """Target and weight sums; the gain of a side is sum ** 2 / (weight + ridge). `centred` measures targets from the node's mean."""

    def __init__(self, ridge: float = 0.0, centred: bool = True):
        self.ridge, self.centred, self.columns = ridge, centred, 5

    def of_rows(self, weight: np.ndarray, target: np.ndarray, curvature: np.ndarray) -> np.ndarray:
        w, s = weight * curvature, weight * target
        return np.stack([weight, w, s, s * target, np.maximum(s, 0.0)], axis=1)

    def gain(self, side: np.ndarray) -> np.ndarray:
        weight = side[..., WEIGHT] + self.ridge
        return np.where(weight > 0, side[..., SUM] ** 2 / np.where(weight > 0, weight, 1.0), 0.0)

    def bound(self, before: np.ndarray, bins: Bins, totals: np.ndarray, centre: float) -> np.ndarray:
        """Upper bound of the gain of a cut inside each bin.

        A part of weight w and sum s has s at most `steepest * w` and at most the sum of positive targets, and the same holds for the rest of the
        bin and, with signs turned, for the sum of negative ones; corners of these limits are where the gain is largest.
        """
        weight, whole = bins.sums[:, WEIGHT], bins.sums[:, SUM]
        up, down = bins.sums[:, POSITIVE], bins.sums[:, POSITIVE] - whole
        steep_up, steep_down = np.maximum(bins.most - centre, 0.0), np.maximum(centre - bins.least, 0.0)
        rise = np.where(steep_up > 0, up / np.where(steep_up > 0, steep_up, 1.0), 0.0)
        fall = np.where(steep_down > 0, down / np.where(steep_down > 0, steep_down, 1.0), 0.0)
        options = [(0.0, 0.0), (weight, whole), (rise, up), (weight - fall, up), (fall, -down), (weight - rise, -down)]
        gains = []
        for w, s in options:
            left = before.copy()
            left[:, WEIGHT] += np.maximum(w, 0.0)
            left[:, SUM] += s
            gains.append(self.gain(left) + self.gain(totals - left))
        return np.max(gains, axis=0)

    def count(self, totals: np.ndarray) -> np.ndarray:
        return totals[..., COUNT]

    def spread(self, node: Node) -> float:
        return float(node.totals[SQUARE])

    def pure(self, node: Node) -> bool:
        return node.least == node.most


class Counts:
    """Class counts; the gain of a side is its sum of squared counts over its size, as for the Gini impurity."""

    def __init__(self, classes: int):
        self.columns = classes

    def of_rows(self, weight: np.ndarray, target: np.ndarray, curvature: np.ndarray) -> np.ndarray:
        return weight[:, None] * (target[:, None] == np.arange(self.columns))

    def gain(self, side: np.ndarray) -> np.ndarray:
        size = side.sum(axis=-1)
        return np.where(size > 0, (side**2).sum(axis=-1) / np.where(size > 0, size, 1.0), 0.0)

    def bound(self, before: np.ndarray, bins: Bins, totals: np.ndarray, centre: float) -> np.ndarray:
        """Upper bound of the gain of a cut inside each bin, each class taken for itself: all, none, or none but its rows to the left."""
        bins = bins.sums
        size, whole, at = bins.sum(axis=1)[:, None], totals.sum(), before.sum(axis=1)[:, None]
        sides = []
        for taken, weight in ((0.0, 0.0), (bins, size), (bins, bins), (0.0, size - bins)):
            left, n = before + taken, at + weight
            right, m = totals - left, whole - n
            part = np.where(n > 0, left**2 / np.where(n > 0, n, 1.0), 0.0)
            sides.append(part + np.where(m > 0, right**2 / np.where(m > 0, m, 1.0), 0.0))
        return np.max(sides, axis=0).sum(axis=1)

    def count(self, totals: np.ndarray) -> np.ndarray:
        return totals.sum(axis=-1)

    def spread(self, node: Node) -> float:
        return float(self.count(node.totals))

    def pure(self, node: Node) -> bool:
        return np.count_nonzero(node.totals) <= 1


@dataclass
class Bins:
    """Bins of one feature in one node, in order of value: their range, their sums, and the range of their target."""

    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray
    least: np.ndarray
    most: np.ndarray

    def replaced(self, opened: np.ndarray, parts: Bins) -> Bins:
        names = ("low", "high", "sums", "least", "most")
        joined = [np.concatenate([getattr(self, n)[~opened], getattr(parts, n)]) for n in names]
        order = np.argsort(joined[0], kind="stable")
        return Bins(*(a[order] for a in joined))

    def before(self) -> np.ndarray:
        return np.cumsum(self.sums, axis=0) - self.sums


def edges(low: float, high: float, parts: int) -> np.ndarray:
    """First values of up to `parts` bins of [low, high]: half of them at equal distances, half at equal numbers of floating-point
    values, so that a few passes also separate values that crowd at one end of a wide range."""
    even = low + (high - low) * np.arange(1, parts // 2 + 1) / (parts // 2 + 1)
    bits = np.array([low, high]).view(np.int64)
    ordered = [int(b) if b >= 0 else -(int(b) & 0x7FFFFFFFFFFFFFFF) for b in bits]
    rest = max(1, parts - len(even) - 1)
    steps = [ordered[0] + (ordered[1] - ordered[0]) * k // (rest + 1) for k in range(1, rest + 1)]
    back = np.array([s if s >= 0 else -0x8000000000000000 - s for s in steps], dtype=np.int64).view(np.float64)
    inner = np.concatenate([even, back])
    inner = inner[np.isfinite(inner) & (inner > low) & (inner <= high)]
    return np.unique(np.concatenate([[low], inner, [high]]))


RowTargets = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def grow(
    rows: DataFrame,
    width: int,
    statistic: Sums | Counts,
    depth: int,
    roots: list[Node],
    targets: RowTargets | None = None,
    allowed: Callable[[int, int], list[int]] | None = None,
) -> list[Tree]:
    """Grow one tree from each root, level by level, all of them in the same passes over `rows`.

    `rows` holds `x array<double>`, `y double` and `w array<int>` with a weight for each tree, without missing values. `targets`
    turns (x, y) into target and curvature, which is positive; by default y and 1. `allowed(tree, node)` names the features a node may use. Equal
    gains, as shares of the spread rounded to TIE_DIGITS digits, go to the first feature and its lowest threshold.
    """
    trees = [Tree(depth, {1: root}) for root in roots]
    level = [(t, 1) for t in range(len(trees))]
    for _ in range(depth):
        level = [(t, i) for t, i in level if not statistic.pure(trees[t].nodes[i])]
        if not level:
            break
        following = []
        # trees of one pass share its slots
        step = max(1, BIN_SLOTS // (4 * width))
        for at in range(0, len(level), step):
            following += _split(rows, width, statistic, trees, level[at : at + step], targets, allowed)
        level = following
    return trees


def _split(rows, width, statistic, trees, level, targets, allowed) -> list[tuple[int, int]]:
    state: dict[tuple[int, int, int], Bins] = {}
    for t, i in level:
        node = trees[t].nodes[i]
        for f in allowed(t, i) if allowed else range(width):
            if node.low[f] < node.high[f]:
                one = [np.array([node.low[f]]), np.array([node.high[f]]), node.totals[None, :]]
                state[t, i, f] = Bins(*one, np.array([node.least]), np.array([node.most]))
    while True:
        opened = _opened(statistic, trees, state)
        if not opened:
            break
        held = sum(float(statistic.count(state[k].sums[o]).sum()) for k, o in opened.items())
        number = sum(int(o.sum()) for o in opened.values())
        parts = 0 if held <= VALUE_ROWS else int(np.clip(BIN_SLOTS // number, 4, MOST_BINS))
        found = _pass(rows, statistic, trees, state, opened, parts, targets)
        for key, bins in found.items():
            state[key] = state[key].replaced(opened[key], bins)
    children = []
    for t, i in level:
        best = _best(statistic, trees[t].nodes[i], {f: b for (tt, ii, f), b in state.items() if (tt, ii) == (t, i)})
        if best:
            _divide(statistic, trees[t], i, *best)
            children += [(t, 2 * i), (t, 2 * i + 1)]
    return children


def _gains(statistic, node: Node, bins: Bins) -> np.ndarray:
    """Gain of the cut after each bin but the last."""
    left = np.cumsum(bins.sums, axis=0)[:-1]
    return statistic.gain(left) + statistic.gain(node.totals - left)


def _opened(statistic, trees, state) -> dict:
    """Bins of more than one value that could hold a cut as good as the best known one of their node."""
    best: dict[tuple[int, int], float] = {}
    for (t, i, f), bins in state.items():
        if len(bins.low) > 1:
            best[t, i] = max(best.get((t, i), -np.inf), float(_gains(statistic, trees[t].nodes[i], bins).max()))
    opened = {}
    for (t, i, f), bins in state.items():
        node = trees[t].nodes[i]
        wide = bins.low < bins.high
        if wide.any() and (t, i) in best:
            least = best[t, i] - 2 * 10.0**-TIE_DIGITS * max(statistic.spread(node), abs(best[t, i]))
            wide &= statistic.bound(bins.before(), bins, node.totals, node.centre) >= least
        if wide.any():
            opened[t, i, f] = wide
    return opened


def _pass(rows, statistic, trees, state, opened, parts: int, targets) -> dict[tuple[int, int, int], Bins]:
    """Sums of the rows in open bins: per smaller bin, or per value if `parts` is 0."""
    lookup, slot_keys = {}, []
    for key, wide in opened.items():
        bins, starts, slots = state[key], [], []
        for j in np.flatnonzero(wide):
            inner = edges(bins.low[j], bins.high[j], parts) if parts else bins.low[j : j + 1]
            starts += [inner, [np.nextafter(bins.high[j], np.inf)]]
            slots += [np.arange(len(slot_keys), len(slot_keys) + len(inner)), [-1]]
            slot_keys += [key] * len(inner)
        starts, slots = np.concatenate(starts), np.concatenate(slots)
        order = np.argsort(starts, kind="stable")
        lookup[key] = (starts[order], slots[order].astype(np.int64))
    by_tree: dict[int, dict[int, list]] = {}
    for t, i, f in lookup:
        by_tree.setdefault(t, {}).setdefault(i, []).append((f, *lookup[t, i, f]))
    arrays = {t: trees[t].arrays() for t in by_tree}
    centres = {(t, i): trees[t].nodes[i].centre for t, nodes in by_tree.items() for i in nodes}
    shared = rows.sparkSession.sparkContext.broadcast((by_tree, arrays, centres))  # at most BIN_SLOTS edges
    columns = [f"s{k}" for k in range(statistic.columns)]
    slot_count = len(slot_keys)

    def run(batches):
        by_tree, arrays, centres = shared.value
        sums = np.zeros((slot_count, statistic.columns))
        ranges = [np.full(slot_count, v) for v in (np.inf, -np.inf, np.inf, -np.inf)]
        for batch in batches:
            if not batch.num_rows:
                continue
            x, weights = matrix(batch.column("x")), matrix(batch.column("w"))
            y = batch.column("y").to_numpy(zero_copy_only=False)
            target, curvature = targets(x, y) if targets else (y, np.ones(len(y)))
            ratio = target / curvature
            met = []
            for t, nodes in by_tree.items():
                at = np.where(weights[:, t] > 0, descend(arrays[t], x), 0)
                for i, features in nodes.items():
                    mine = np.flatnonzero(at == i)
                    if not len(mine):
                        continue
                    values = statistic.of_rows(weights[mine, t], target[mine] - centres[t, i], curvature[mine])
                    for f, starts, slots in features:
                        place = np.searchsorted(starts, x[mine, f], "right") - 1
                        slot = np.where(place >= 0, slots[place], -1)
                        inside = np.flatnonzero(slot >= 0)
                        met.append((slot[inside], x[mine[inside], f], values[inside], ratio[mine[inside]]))
            if not met:
                continue
            slot, v, values, ratios = (np.concatenate(c) for c in zip(*met))
            if not parts:
                if len(slot):
                    yield _by_value(slot, v, values, ratios)
                continue
            for c in range(statistic.columns):
                sums[:, c] += np.bincount(slot, values[:, c], slot_count)
            for r, found, of in zip(ranges, (v, v, ratios, ratios), (np.minimum, np.maximum) * 2):
                of.at(r, slot, found)
        if parts:
            filled = np.flatnonzero(ranges[0] <= ranges[1])
            yield _record(filled, *(r[filled] for r in ranges), sums[filled])

    schema = "slot int, low double, high double, least double, most double, " + ", ".join(f"{c} double" for c in columns)
    keys = ["slot"] if parts else ["slot", "low"]
    kept = [F.min("low").alias("low")] if parts else []
    aggs = [*kept, F.max("high").alias("high"), F.min("least").alias("least"), F.max("most").alias("most"), *[F.sum(c).alias(c) for c in columns]]
    try:
        table = rows.mapInArrow(run, schema).groupBy(*keys).agg(*aggs).toArrow()  # at most BIN_SLOTS bins or VALUE_ROWS values
    finally:
        shared.destroy()
    slot = table.column("slot").to_numpy()
    low, high, least, most = (table.column(c).to_numpy() for c in ("low", "high", "least", "most"))
    sums = np.stack([table.column(c).to_numpy() for c in columns], axis=1) if len(slot) else np.zeros((0, len(columns)))
    number = {key: n for n, key in enumerate(opened)}
    owner = np.array([number[k] for k in slot_keys])[slot]
    found = {}
    for key, n in number.items():
        mine = np.flatnonzero(owner == n)
        mine = mine[np.argsort(low[mine], kind="stable")]
        found[key] = Bins(low[mine], high[mine], sums[mine], least[mine], most[mine])
    return found


def _by_value(slot, v, values, y) -> pa.RecordBatch:
    order = np.lexsort((v, slot))
    slot, v, values, y = slot[order], v[order], values[order], y[order]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(slot) != 0) | (np.diff(v) != 0)]))
    low, sums = v[first], np.add.reduceat(values, first, axis=0)
    return _record(slot[first], low, low, np.minimum.reduceat(y, first), np.maximum.reduceat(y, first), sums)


def _record(slot, low, high, least, most, sums) -> pa.RecordBatch:
    names = ["slot", "low", "high", "least", "most", *[f"s{k}" for k in range(sums.shape[1])]]
    return pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), *map(pa.array, (low, high, least, most)), *[pa.array(c) for c in sums.T.copy()]], names)


def _best(statistic, node: Node, by_feature: dict[int, Bins]) -> tuple[int, Bins, int] | None:
    """Feature, its bins, and the last bin left of the best cut."""
    found = None
    for f, bins in sorted(by_feature.items()):
        if len(bins.low) < 2:
            continue
        share = np.round(_gains(statistic, node, bins) / (statistic.spread(node) or 1.0), TIE_DIGITS)
        j = int(share.argmax())
        if found is None or share[j] > found[0]:
            found = (share[j], f, bins, j)
    return found[1:] if found else None


def _divide(statistic, tree: Tree, i: int, f: int, bins: Bins, j: int) -> None:
    node = tree.nodes[i]
    middle = bins.high[j] + (bins.low[j + 1] - bins.high[j]) / 2
    node.feature, node.threshold = f, float(middle if bins.high[j] <= middle < bins.low[j + 1] else bins.high[j])
    for child, part in ((2 * i, slice(0, j + 1)), (2 * i + 1, slice(j + 1, None))):
        low, high = node.low.copy(), node.high.copy()
        low[f], high[f] = bins.low[part][0], bins.high[part][-1]
        totals = bins.sums[part].sum(axis=0)
        new = Node(totals, low, high, float(bins.least[part].min()), float(bins.most[part].max()), node.centre)
        tree.nodes[child] = recentred(new) if getattr(statistic, "centred", False) else new


def recentred(node: Node) -> Node:
    """The node's sums measured from its own mean, which keeps small differences in the sums."""
    mean = node.totals[SUM] / node.totals[WEIGHT]
    node.centre += mean
    node.totals = node.totals.copy()
    node.totals[SQUARE] = max(0.0, node.totals[SQUARE] - mean * node.totals[SUM])
    node.totals[SUM] = 0.0
    return node
