"""Connected components of a table of links."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.session import materialise

LINKS = 200_000  # links that a task contracts at a time


def _contract(batches):
    """Links of a task, in blocks of bounded size, as links from every node to the smallest node of its block's component."""

    def stars(links):
        parent: dict = {}

        def root(x):
            parent.setdefault(x, x)
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for a, b in links:
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        rows = [(x, root(x)) for x in list(parent)]
        rows = [r for r in rows if r[0] != r[1]]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i in (0, 1)], ["a", "b"])

    kind, held = None, []
    for batch in batches:
        kind = batch.schema.field(0).type
        held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        if len(held) >= LINKS:
            yield stars(held)
            held = []
    if held:
        yield stars(held)


def _all_stars(links: DataFrame) -> bool:
    """Whether every larger end has one link and is no smaller end. Then each smaller end is the least node of its component."""
    ends = links.select(F.inline(F.array(*[F.struct(F.col(c).alias("node"), F.lit(up).alias("up"), F.lit(1 - up).alias("down")) for c, up in (("a", 1), ("b", 0))])))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 OR up > 0 AND down > 0").isEmpty()


def _packed(links: DataFrame) -> DataFrame:
    """A written table of links, contracted in tasks of about LINKS links each, so that a small table isn't spread over many tasks."""
    tasks = max(1, -(-links.count() // LINKS))
    return links.coalesce(tasks).mapInArrow(_contract, links.schema)


def components(links: DataFrame, name: str = "links", rounds: int = 40) -> DataFrame:
    """`node, component`: the smallest node that each node of the links `a, b` reaches. Nodes without a link are absent.

    Links are contracted inside tasks, then joined to stars: larger neighbours of a node move to the smallest, then smaller ones, in
    turns, until only stars are left (some log n turns). Each turn is one aggregate and one join by node, written to
    the shared folder and contracted again in full tasks; a node with very many links is a skewed join key, which Spark splits, and its
    minimum is summed before the shuffle.
    NULL ends, self links and repeated links change nothing; no links give an empty table.
    """
    links = links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    kind = links.schema["a"].dataType.simpleString()
    links = materialise(links.mapInArrow(_contract, f"a {kind}, b {kind}"), f"{name}-0")  # a > b in every link
    for turn in range(1, rounds + 1):
        links = materialise(_packed(links).distinct(), f"{name}-{turn}")
        if _all_stars(links):
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
        larger = links.select(F.col("b").alias("a"), F.col("a").alias("b")).join(least, "a")
        large = larger.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(smallest, "a")
        small = small.select(F.explode(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("l"))
        links = materialise(small.select("l.a", "l.b").where("a <> b").distinct(), f"{name}-{turn}-star")
    raise RuntimeError(f"components did not settle in {rounds} turns")
