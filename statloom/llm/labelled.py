"""Bounded labelled samples, and isotonic calibration of raw scores."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, texts_of


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, modulus: int, remainder: int) -> DataFrame:
    """`doc_id, text, label, fold`: at most `rows` labelled documents that learning may see, chosen by a hash of the id.

    `fold` is 0 to 9, also by hash. Repeated labels of an id count once, as the largest; NULL ids and labels don't count.
    The chosen ids, at most `rows` of them, are broadcast; a bound that the caller states as a parameter.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label")).dropna()
    seen = known.where(~held_out("doc_id", modulus, remainder)).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = seen.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(rows)
    chosen = chosen.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(10)).cast("int"))
    return texts_of(docs).join(F.broadcast(chosen), "doc_id")


def pooled(blocks: Iterable[list[float]]) -> list[list[float]]:
    """Adjacent violators of [label sum, size, sum of x * size] pooled until the rates rise."""
    out: list[list[float]] = []
    for block in blocks:
        out.append(block)
        while len(out) > 1 and out[-2][0] * out[-1][1] >= out[-1][0] * out[-2][1]:
            last = out.pop()
            out[-1] = [a + b for a, b in zip(out[-1], last)]
    return out


def knots_of(blocks: list[list[float]]) -> tuple[np.ndarray, np.ndarray]:
    """Mean x and rate of each block, with a half case of either class as prior."""
    if not blocks:
        return np.array([0.0]), np.array([0.5])
    rate = (sum(b[0] for b in blocks) + 0.5) / (sum(b[1] for b in blocks) + 1.0)
    values = np.array([(b[0] + rate) / (b[1] + 1.0) for b in blocks])
    return np.array([b[2] / b[1] for b in blocks]), np.maximum.accumulate(values)


def fit_isotonic(raw: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the best rising fit of the labels (pool adjacent violators), with a half case of either class as prior.

    Equal raw scores are one block from the start, so ties get one value.
    """
    if not len(raw):
        return knots_of([])
    order = np.argsort(raw, kind="stable")
    x, first = np.unique(raw[order], return_index=True)
    sums = np.add.reduceat(labels[order].astype(float), first)
    sizes = np.diff([*first, len(raw)]).astype(float)
    return knots_of(pooled([total, size, position * size] for position, total, size in zip(x, sums, sizes)))


def fit_isotonic_table(rows: DataFrame, raw: str, label: str, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The same knots from a table of any size: violators are pooled inside `parts` ranges of the score first, then what is left between them."""

    def inside(batches):
        blocks: list[list[float]] = []
        for batch in batches:
            new = zip(*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("total", "size", "x")))
            blocks = pooled([*blocks, *([total, size, x * size] for total, size, x in new)])
        if blocks:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in zip(*blocks)], ["total", "size", "weighted"])

    ties = rows.groupBy(F.col(raw).alias("x")).agg(F.sum(label).cast("double").alias("total"), F.count(F.lit(1)).cast("double").alias("size"))
    ranges = ties.repartitionByRange(parts, "x").sortWithinPartitions("x")
    blocks = ranges.mapInArrow(inside, "total double, size double, weighted double").collect()  # rising rates only
    return knots_of(pooled(list(b) for b in sorted(blocks, key=lambda b: b["weighted"] / b["size"])))


def calibrated(raw: np.ndarray, knots: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return np.clip(np.interp(raw, *knots), 0.0, 1.0)
