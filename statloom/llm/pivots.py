"""Near-duplicate vectors by a pivot permutation index.

Every vector is described by its nearest reference points (pivots) in order of closeness. An inverted list per label and pivot holds
the vectors that have it among their nearest; vectors that share enough pivots are candidates, and their cosine decides.
A pair is compared in the list of the lowest pivot that it shares, so it counts once. Long lists are cut into
blocks, and each pair of blocks is a cell of its own with at most twice BLOCK vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.session import materialise

from .components import components

BLOCK = 4096  # vectors of a list compared in one cell with those of another block
STRIP = 512  # vectors whose products are held at a time


def choose_pivots(vectors: np.ndarray, count: int) -> np.ndarray:
    """Well spread unit vectors of a sample: each next one is the farthest from those chosen."""
    if not len(vectors):
        return vectors
    chosen = [0]
    closest = vectors @ vectors[0]
    while len(chosen) < min(count, len(vectors)):
        chosen.append(int(closest.argmin()))
        closest = np.maximum(closest, vectors @ vectors[chosen[-1]])
    return vectors[chosen]


def _normal(rows: list, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers with a direction, their unit vectors)."""
    at = [i for i, r in enumerate(rows) if r is not None and len(r) == width and None not in r]
    x = np.array([rows[i] for i in at], dtype=np.float64).reshape(len(at), width)
    with np.errstate(all="ignore"):
        x = x / np.abs(x).max(1, keepdims=True) if width and len(at) else x
        x = x / np.sqrt((x * x).sum(1, keepdims=True))
    good = np.isfinite(x).all(1)
    return np.array(at, dtype=np.int64)[good], x[good]


def reference_points(vectors: DataFrame, pivots: int, sample: int) -> tuple[np.ndarray, int]:
    """Pivots from at most `sample` rows, chosen by a hash of the id, and the commonest length of their vectors."""
    rows = vectors.where("vector IS NOT NULL AND label IS NOT NULL").orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(sample)
    lists = rows.select("vector").toPandas()["vector"].tolist()
    lengths = [len(r) for r in lists]
    width = max(sorted(set(lengths)), key=lengths.count, default=0)
    _, x = _normal([None if any(v is None for v in r) else list(r) for r in lists], width)
    return choose_pivots(np.unique(x, axis=0), pivots), width


def indexed(vectors: DataFrame, pivots: np.ndarray, width: int, nearest: int) -> DataFrame:
    """`vec_id, label, node, nearest, unit`: every row; without a label or direction the last three are NULL.

    `node` is a digest of label and components, `nearest` the pivots closest first, `unit` the unit vector as bytes.
    """

    def run(batches):
        for batch in batches:
            labels, rows = batch.column("label").to_pylist(), batch.column("vector").to_pylist()
            at, x = _normal([r if k is not None else None for k, r in zip(labels, rows)], width)
            node, near, unit = [None] * len(rows), [None] * len(rows), [None] * len(rows)
            if len(at):
                order = np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :nearest].astype(np.int32)
                for i, n, u in zip(at.tolist(), order, x):
                    node[i] = xxhash.xxh3_128_digest(np.array(rows[i], dtype=np.float64).tobytes() + str(labels[i]).encode())
                    near[i], unit[i] = n, u.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(node, pa.binary()), pa.array(near, pa.list_(pa.int32())), pa.array(unit, pa.binary())],
                ["vec_id", "label", "node", "nearest", "unit"],
            )

    return vectors.mapInArrow(run, "vec_id long, label string, node binary, nearest array<int>, unit binary")


def _marks(nearest: list, pivots: int) -> np.ndarray:
    """Pivots of each vector as bits."""
    marks = np.zeros((len(nearest), (pivots + 63) // 64), dtype=np.uint64)
    for column in np.array(nearest, dtype=np.int64).T:
        marks[np.arange(len(nearest)), column // 64] |= np.uint64(1) << (column % 64).astype(np.uint64)
    return marks


def _linked(left: np.ndarray, right: np.ndarray, marks: tuple, pivot: int, least: float, shared: int) -> np.ndarray:
    """Which pairs of two sets of unit vectors link, counting a pair only in the list of its lowest shared pivot."""
    out = left @ right.T >= least
    for i in np.flatnonzero(out.any(1)):
        at = np.flatnonzero(out[i])
        both = marks[0][i] & marks[1][at]
        below = np.zeros(len(at), dtype=bool)
        for word in range(pivot // 64):
            below |= both[:, word] != 0
        below |= both[:, pivot // 64] & np.uint64((1 << (pivot % 64)) - 1) != 0
        out[i, at] = ~below & (np.bitwise_count(both).sum(1) >= shared)
    return out


def links(nodes: DataFrame, pivots: int, least: float, shared: int) -> DataFrame:
    """`node, n, root`: per cell and linked node the number of vectors it links to there, and a node that it reaches there.

    `nodes` has one row per distinct vector and label, with its number of `copies`.
    """
    listed = nodes.select("label", "node", "copies", "nearest", "unit", F.explode("nearest").alias("pivot"))
    sizes = nodes.select("label", F.explode("nearest").alias("pivot")).groupBy("label", "pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    listed = listed.join(sizes, ["label", "pivot"])
    listed = listed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = listed.select("label", "pivot", "node", "copies", "nearest", "unit", "block", other.alias("other"))
    cells = cells.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other")

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        pivot, block = group.column("pivot")[0].as_py(), group.column("block").to_numpy()
        unit = np.frombuffer(b"".join(group.column("unit").to_pylist()), dtype=np.float64).reshape(group.num_rows, -1)
        marks, copies = _marks(group.column("nearest").to_pylist(), pivots), group.column("copies").to_numpy()
        one = block[0] == block[-1] and (block == block[0]).all() and group.column("low")[0] == group.column("high")[0]
        rows = np.arange(len(block)) if one else np.flatnonzero(block == group.column("low")[0].as_py())
        columns = rows if one else np.flatnonzero(block == group.column("high")[0].as_py())
        count, root = np.zeros(len(block), dtype=np.int64), np.arange(len(block))
        pairs = []
        for at in range(0, len(rows), STRIP):
            strip = rows[at : at + STRIP]
            hit = _linked(unit[strip], unit[columns], (marks[strip], marks[columns]), pivot, least, shared)
            if one:
                hit[np.arange(len(strip)), np.arange(at, at + len(strip))] = False
            count[strip] += hit @ copies[columns]
            if not one:
                np.add.at(count, columns, copies[strip] @ hit)
            pairs.append((strip, hit))
        changed = True
        while changed:  # smallest row reached inside the cell
            before = root.copy()
            for strip, hit in pairs:
                some = hit.any(1)
                if some.any():
                    here = np.where(hit[some], root[columns], len(root)).min(1)
                    root[strip[some]] = np.minimum(root[strip[some]], here)
                    back = np.where(hit[some], root[strip[some]][:, None], len(root)).min(0)
                    root[columns] = np.minimum(root[columns], back)
            root = root[root]
            changed = bool((root != before).any())
        told = np.flatnonzero(count > 0)
        node = group.column("node")
        return pa.table({"node": node.take(pa.array(told)), "n": pa.array(count[told]), "root": node.take(pa.array(root[told]))})

    return cells.groupBy("label", "pivot", "low", "high").applyInArrow(compare, "node binary, n long, root binary")


def near_vectors(
    vectors: DataFrame,
    least: float = 0.93,
    pivots: int = 128,
    nearest: int = 8,
    shared: int = 2,
    sample: int = 4096,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """`vec_id, n_links, component_id, kept` for every row.

    Rows with equal labels link when they share `shared` of their `nearest` pivots and their cosine, in double precision,
    is at least `least`. Equal vectors of a label are one node, whose copies count as links of each other, so no group of copies becomes pairs.
    `component_id` is the smallest id reachable, `kept` marks its row.

    Vectors that are NULL, zero, hold a NULL or non-finite component, have another length than most, or have no label link with nothing. A row
    with a NULL id takes no part: no links, component NULL, kept. Rows that repeat an id are vectors of their own with one
    name. Pivots come from at most `sample` rows; every row is indexed. Other columns are not looked at; an empty table gives an empty one.
    """
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    )
    points, width = reference_points(rows, pivots, sample)
    table = materialise(indexed(rows, points, width, nearest), "vectors")
    nodes = table.where("node IS NOT NULL AND vec_id IS NOT NULL").groupBy("node")
    nodes = nodes.agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("label", "nearest", "unit")))
    nodes = materialise(nodes, "vector-nodes")
    found = materialise(links(nodes, max(len(points), 1), least, shared), "vector-links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector-groups")
    nodes = nodes.select("node", "least_id", "copies").join(counts, "node", "left").join(groups, "node", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "node"))
    least_ids = nodes.groupBy("component").agg(F.min("least_id").alias("component_id"))
    nodes = nodes.join(least_ids, "component").select("node", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    known = F.col("vec_id").isNotNull()
    out = table.select("vec_id", "node").join(nodes, "node", "left").select(
        "vec_id",
        F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(known, F.coalesce("component_id", "vec_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
