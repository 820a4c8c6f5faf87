"""Quality by Naive Bayes support vectors: n-gram indicators scaled by class log-count ratios, then a linear hinge-loss fit."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces_of, texts_of
from .labelled import calibrated, fit_isotonic, labelled_sample

BUCKETS = 1 << 16
GRAMS = (1, 2, 3)


def grams(text: str) -> np.ndarray:
    """Distinct hashed byte n-grams of the whole text, as bucket numbers."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8).astype(np.uint32)
    seen = np.zeros(BUCKETS, dtype=bool)
    value = np.zeros(len(raw), dtype=np.uint32)
    for n in range(1, max(GRAMS) + 1):
        value = value[: len(raw) - n + 1] * np.uint32(257) + raw[n - 1 :] + np.uint32(n) if len(raw) >= n else raw[:0]
        if n in GRAMS:
            seen[(value * np.uint32(2654435761)) >> np.uint32(16)] = True
    return np.flatnonzero(seen).astype(np.uint16)


def dual_coordinate_descent(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: float, passes: int, seed: int = 1) -> np.ndarray:
    """Weights of the L2-regularised linear hinge-loss fit; `x` holds (buckets, values), `y` is -1 or 1.

    Classes weigh alike: the cost of a row is `cost` times the other class's share, doubled.
    """
    w = np.zeros(BUCKETS + 1)  # the last weight is the intercept
    alpha = np.zeros(len(x))
    positive = float((y > 0).mean()) if len(y) else 0.5
    bound = np.where(y > 0, 1 - positive, positive) * 2 * cost
    length = np.array([v @ v + 1.0 for _, v in x])
    random = np.random.default_rng(seed)
    for _ in range(passes):
        for i in random.permutation(len(x)):
            at, v = x[i]
            slope = y[i] * (w[at] @ v + w[-1]) - 1.0
            new = min(max(alpha[i] - slope / length[i], 0.0), bound[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[at] += step * v
                w[-1] += step
                alpha[i] = new
    return w


def scaled(at: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Indicator values of one text: the log-count ratios of its n-grams, at unit length."""
    v = ratios[at]
    length = np.sqrt(v @ v)
    return v / length if length > 0 else v


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = 6000, cost: float = 1.0, passes: int = 12, modulus: int = 4, remainder: int = 2
) -> dict:
    """Model from at most `rows` labelled documents: seven tenths for the fit, the rest for the isotonic calibration."""
    sample = labelled_sample(docs, labels, label, rows, modulus, remainder)

    def run(batches):
        for batch in batches:
            for part in pieces_of(batch):
                found = [grams(t or "").tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "label", "fold")), pa.array(found, pa.binary())], ["doc_id", "label", "fold", "x"])

    table = sample.select("doc_id", "label", "fold", "text").mapInArrow(run, "doc_id long, label int, fold int, x binary")
    table = table.toPandas().sort_values(["doc_id", "x"])  # at most `rows` rows of 128 KB, some KB as a rule
    x = [np.frombuffer(b, dtype=np.uint16).astype(np.int64) for b in table["x"]]
    y, fold = np.where(table["label"].to_numpy() > 0, 1, -1), table["fold"].to_numpy()
    counts = {1: np.ones(BUCKETS), -1: np.ones(BUCKETS)}
    for at, side in ((a, s) for a, s, f in zip(x, y, fold) if f < 7):
        counts[side][at] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[-1] / counts[-1].sum())
    vectors = [(at, scaled(at, ratios)) for at in x]
    train = [i for i in range(len(x)) if fold[i] < 7]
    w = dual_coordinate_descent([vectors[i] for i in train], y[train], cost, passes)
    rest = [i for i in range(len(x)) if fold[i] >= 7]
    raw = np.array([w[vectors[i][0]] @ vectors[i][1] + w[-1] for i in rest])
    return {"ratios": ratios, "w": w, "knots": fit_isotonic(raw, (y[rest] > 0).astype(float))}


def score(docs: DataFrame, model: dict, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, score, predicted` for every row, from its whole text alone.

    A NULL text scores as an empty one, which has no n-grams and so the intercept's score. Rows are scored one by one:
    NULL or repeated ids and repeated rows each get their row; an empty table gives an empty one. The model has a fixed size.
    """

    def run(batches):
        ratios, w = model["ratios"], model["w"]
        weight, square = w[:-1] * ratios, ratios**2
        for batch in batches:
            for part in pieces_of(batch):
                raw = []
                for text in part.column("text").to_pylist():
                    at = grams(text or "")
                    length = np.sqrt(square[at].sum())
                    raw.append(w[-1] + (weight[at].sum() / length if length > 0 else 0.0))
                p = calibrated(np.array(raw), model["knots"])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"]
                )

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, predicted int")
