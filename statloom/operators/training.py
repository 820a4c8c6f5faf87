"""Sequential mini-batch training over partitioned rows.

Every step takes the gradient of one mini-batch at the weights that the step before left. Batches of up to SPREAD_ROWS rows are less work than a
job, so a task walks through a run of consecutive batches, and the weights and moments go on to the task of the next run. The gradient
of a larger batch is one aggregate: tasks sum it over their rows, the sums are averaged on the way. Both are the same descent; the
size of a batch alone decides which one is taken, and runs are of a fixed size, so no task holds more of a larger table.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import argmax
from ..plans.vectors import list_column, matrix
from .kmeans import features_column
from .layers import Layers, backward, count_parameters, flat, forward, initial, loss_and_gradient, unflat
from .metrics import accuracy
from .split import hash_rank

CHUNK = 4096  # gradients travel in pieces of this length, averaged in parallel
SCORE_ROWS = 256  # rows that go through the layers together
SPREAD_ROWS = 16 * SCORE_ROWS  # a batch of more rows is spread over the tasks
RUN_ROWS = 1 << 20  # rows of the batches that one task walks through, and the numbers in them
RUN_VALUES = 1 << 22
WEIGHT_SCHEMA = "layer int, kind string, row int, col int, value double"
HISTORY_SCHEMA = "epoch int, batches bigint, loss double"


@dataclass
class Network:
    layers: Layers
    params: list[np.ndarray]
    history: list[tuple[int, int, float]] = field(default_factory=list)

    def history_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.history, HISTORY_SCHEMA)

    def weight_table(self, spark: SparkSession) -> DataFrame:
        """One row per trainable number."""
        parts = []
        for layer, p in enumerate(self.params):
            rows, cols = np.indices(p.reshape(p.shape[0], -1).shape).reshape(2, -1)
            kind = "weight" if p.ndim == 2 else "bias"
            parts.append(pd.DataFrame({"layer": layer // 2, "kind": kind, "row": rows, "col": cols, "value": p.reshape(-1)}))
        return spark.createDataFrame(pd.concat(parts), WEIGHT_SCHEMA)

    def scores(self, spark: SparkSession, features: Column) -> Column:
        """Output array per row, without dropout."""
        shared = spark.sparkContext.broadcast((self.layers, self.params))

        @F.arrow_udf("array<double>")
        def score(x: pa.Array) -> pa.Array:
            layers, params = shared.value
            rows = matrix(x)
            if not rows.size:
                return list_column(np.zeros((len(x), 1)))
            parts = [  # bounded memory for unfolded images
                forward(layers, params, rows[i : i + SCORE_ROWS])[0] for i in range(0, len(rows), SCORE_ROWS)
            ]
            return list_column(np.concatenate(parts))

        whole = features.isNotNull() & F.forall(features, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")))
        return F.when(whole, score(features))


def from_weight_table(table: DataFrame, layers: Layers) -> Network:
    """Network from its stored weights."""
    values = table.orderBy("layer", F.col("kind").desc(), "row", "col").select("value").toPandas()["value"].to_numpy()
    return Network(layers, unflat(values, layers))


def train(
    df: DataFrame,
    id_col: str,
    features: list[str] | str,
    label: str,
    layers: Layers,
    loss: str = "cross_entropy",
    optimizer: str = "adam",
    rate: float = 0.001,
    epochs: int = 5,
    batch_size: int = 128,
    seed: int = 42,
    start: list[np.ndarray] | None = None,
) -> Network:
    """Train from `start` (or seeded initial weights), one step per mini-batch of `batch_size` rows; the last of an epoch may be short.

    An epoch's order is that of a hash of the id, so batches are the same on any partitioning. Rows are dealt to tasks in runs of
    batches, or in blocks of neighbours where a batch is spread. Rows with a missing feature or target take no part.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("id"), features_column(features).alias("x"), F.col(label).cast("double").alias("y"))
    rows = rows.where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)) & F.col("y").isNotNull() & ~F.isnan("y"))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    params = flat(start if start is not None else initial(layers, seed))
    state = np.concatenate([params, np.zeros(2 * len(params))]) if optimizer == "adam" else params.copy()
    history, steps = [], 0
    spread = batch_size > SPREAD_ROWS
    try:
        n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
        batches = -(-n // batch_size)
        length = 1 if spread else max(1, min(RUN_ROWS, RUN_VALUES // max(1, width or 1)) // batch_size)  # batches of a run
        runs = -(-batches // length)
        for epoch in range(1, epochs + 1):
            order = hash_rank(rows, "id", f"{seed}/{epoch}", "place").withColumn("place", F.col("place") - 1)
            order = order.select("place", F.floor(F.col("place") / (length * batch_size)).alias("run"), "x", "y")
            if spread:
                dealt = order.repartition(spark.sparkContext.defaultParallelism, F.floor(F.col("place") / SCORE_ROWS))
            else:
                dealt = order.repartition(max(runs, spark.sparkContext.defaultParallelism), "run")
            dealt = dealt.sortWithinPartitions("run", "place").persist(StorageLevel.MEMORY_AND_DISK)
            losses = 0.0
            try:
                for run in range(runs):
                    own = dealt.where(F.col("run") == run)
                    if spread:
                        value, grad = _gradient(own, layers, unflat(state[: len(params)], layers), loss, [seed, epoch])
                        _descend(state, len(params), grad, optimizer, rate, steps + 1)
                    else:
                        value, state = _walked(own, layers, state, len(params), batch_size, loss, optimizer, rate, steps, [seed, epoch])
                    steps += min(length, batches - run * length)
                    losses += value
            finally:
                dealt.unpersist()
            history.append((epoch, batches, losses / batches if batches else float("nan")))
        return Network(layers, unflat(state[: len(params)], layers), history)
    finally:
        rows.unpersist()


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return matrix(batch.column("x")), *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "place"))


def _sums(
    layers: Layers, params: list[np.ndarray], x: np.ndarray, y: np.ndarray, place: np.ndarray, loss: str, seed: list[int]
) -> tuple[float, np.ndarray]:
    """Loss and gradient summed over rows in order of their place, block by block; the place of a block's first row seeds its dropout."""
    cuts = [0, len(y)]
    if place[0] // SCORE_ROWS != place[-1] // SCORE_ROWS:
        cuts[1:1] = list(np.flatnonzero(np.diff(place // SCORE_ROWS)) + 1)
    drops = any(kind == "dropout" for kind, *_ in layers)
    losses, total = 0.0, 0.0
    for a, b in zip(cuts, cuts[1:]):
        rng = np.random.default_rng([*seed, int(place[a])]) if drops else None
        output, saved = forward(layers, params, x[a:b], rng)
        value, grad = loss_and_gradient(output, y[a:b], loss)
        total = total + flat(backward(layers, params, saved, grad)) * (b - a)
        losses += value * (b - a)
    return losses, total


def _walked(
    rows: DataFrame, layers: Layers, state: np.ndarray, size: int, batch_size: int, loss: str, optimizer: str, rate: float, steps: int, seed: list[int]
) -> tuple[float, np.ndarray]:
    """Sum of the batch losses and the state after all batches of a run, whose rows lie in one partition in their order."""
    shared = rows.sparkSession.sparkContext.broadcast(state)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, losses, step = shared.value.copy(), 0.0, steps
        params = unflat(state[:size], layers)  # views, which move with the state
        held: tuple | None = None  # rows of a batch that may go on in the next Arrow batch
        for batch in batches:
            if not batch.num_rows:
                continue
            new = _columns(batch)
            x, y, place = new if held is None else (np.concatenate(pair) for pair in zip(held, new))
            last = int(np.searchsorted(place, place[-1] // batch_size * batch_size))  # where the last batch begins
            for a in range(0, last, batch_size):
                b = a + batch_size
                value, grad = _sums(layers, params, x[a:b], y[a:b], place[a:b], loss, seed)
                step += 1
                _descend(state, size, grad / batch_size, optimizer, rate, step)
                losses += value / batch_size
            held = x[last:], y[last:], place[last:]
        if held is not None:
            value, grad = _sums(layers, params, *held, loss, seed)
            _descend(state, size, grad / len(held[1]), optimizer, rate, step + 1)
            losses += value / len(held[1])
            yield pa.RecordBatch.from_arrays([pa.array([losses]), pa.array([state.tobytes()], pa.binary())], names=["losses", "state"])

    try:
        found = rows.select("place", "x", "y").mapInArrow(task, "losses double, state binary").collect()[0]  # the run's one task gives a row
        return found["losses"], np.frombuffer(found["state"]).copy()
    finally:
        shared.destroy()


def _gradient(rows: DataFrame, layers: Layers, params: list[np.ndarray], loss: str, seed: list[int]) -> tuple[float, np.ndarray]:
    """Mean loss of the rows and its gradient. Each task returns its mean in chunks; a chunk of every task meets in one place."""
    shared = rows.sparkSession.sparkContext.broadcast(params)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, losses, seen = np.zeros(count_parameters(layers)), 0.0, 0
        for batch in batches:
            if batch.num_rows:
                value, grad = _sums(layers, shared.value, *_columns(batch), loss, seed)
                total += grad
                losses += value
                seen += batch.num_rows
        if seen:
            whole = np.append(losses, total) / seen
            pieces = [whole[i : i + CHUNK] for i in range(0, len(whole), CHUNK)]
            for chunk, piece in enumerate(pieces):
                columns = [pa.array([chunk], pa.int32()), pa.array([float(seen)]), list_column(piece[None, :])]
                yield pa.RecordBatch.from_arrays(columns, names=["chunk", "weight", "values"])

    try:
        parts = rows.select("place", "x", "y").mapInArrow(task, "chunk int, weight double, values array<double>")
        mean = Summarizer.mean(array_to_vector("values"), F.col("weight")).alias("mean")
        found = {r["chunk"]: r["mean"].toArray() for r in parts.groupBy("chunk").agg(mean).collect()}
    finally:
        shared.destroy()
    whole = np.concatenate([found[c] for c in sorted(found)])
    return float(whole[0]), whole[1:]


def _descend(state: np.ndarray, size: int, grad: np.ndarray, optimizer: str, rate: float, step: int) -> None:
    """One optimiser step in place; Adam keeps its two moments behind the parameters."""
    if optimizer == "sgd":
        state -= rate * grad
        return
    mean, square = state[size : 2 * size], state[2 * size :]
    mean += 0.1 * (grad - mean)
    square += 0.001 * (grad**2 - square)
    corrected = np.sqrt(square / (1.0 - 0.999**step)) + 1e-8
    state[:size] -= rate * (mean / (1.0 - 0.9**step)) / corrected


def evaluate(network: Network, df: DataFrame, features: list[str] | str, label: str) -> float:
    """Accuracy in percent of the class with the highest score."""
    scored = predict_class(network, df, features)
    return accuracy(scored, label, "prediction").first()["accuracy"]


def predict_class(network: Network, df: DataFrame, features: list[str] | str) -> DataFrame:
    scored = df.withColumn("scores", network.scores(df.sparkSession, features_column(features)))
    return scored.withColumn("prediction", argmax(F.col("scores")))


def train_and_evaluate(
    name: str, layers: Layers, train_df: DataFrame, test_df: DataFrame, id_col: str, features, label: str, **options
) -> tuple[Network, tuple]:
    """Same loop, loss and optimiser for every model: (network, comparison row)."""
    begin = time.perf_counter()
    network = train(train_df, id_col, features, label, layers, **options)
    seconds = time.perf_counter() - begin
    score = evaluate(network, test_df, features, label)
    return network, (name, count_parameters(layers), float(score), round(seconds, 2))


def comparison_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "model string, parameters bigint, accuracy double, seconds double")
