"""Toxicity by gradient-boosted trees over dense text features, with isotonic calibration."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, lean, pieces_of, text_slices, texts_of
from .labelled import calibrated, fit_isotonic, labelled_sample

# Pronouns of the second person in five languages. The lexicon of insults has no fixed words; labels make it.
SECOND_PERSON = frozenset("you your yours yourself tu te toi vous votre du dich dir dein ihr euch usted ustedes vosotros".split())
PLAIN = str.maketrans("01345@$!", "oieasasi")  # signs that stand for letters

STEMS = (4, 5, 6)
NEAR = 5  # words between an insult and a second-person word
WORD = re.compile(r"[^\W\d_]+")
MIXED = re.compile(r"[^\W\d_]+[0-9@$!*.\-]{1,2}[^\W\d_][\w@$!*.\-]*")
FEATURES = 24

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCTUATION = np.array([33 <= c < 127 and not chr(c).isalnum() for c in range(256)])


def terms(word: str) -> list[str]:
    """What a lexicon may hold of a word: itself, and its beginnings, which insults with many endings share."""
    return [word, *(f"{word[:n]}*" for n in STEMS if n < len(word))]


class Weights(dict):
    """Lexicon weight of a word: the largest among its terms, 0 if there is none. Words seen lately are kept."""

    def __init__(self, lexicon: dict[str, float], limit: int = 100_000):
        super().__init__()
        self.lexicon, self.limit = lexicon, limit

    def __missing__(self, word: str) -> float:
        if len(self) > self.limit:
            self.clear()
        found = self[word] = max((self.lexicon.get(t, 0.0) for t in terms(word)), default=0.0)
        return found


def features(text: str, weights: Weights) -> list[float]:
    """Dense features of a whole text."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    n = max(len(raw), 1)
    counts = np.bincount(raw, minlength=256)
    upper = _UPPER[raw]
    runs = float((upper[1:] & upper[:-1]).sum())
    triples = float(((raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2])).sum())
    words = WORD.findall(text.lower())
    m = max(len(words), 1)
    each = [weights[w] for w in words]
    at = [i for i, w in enumerate(each) if w]
    found = [each[i] for i in at]
    strong = sum(w >= 2.0 for w in found)
    persons = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if at and persons:
        people = np.array(persons)
        near = sum(bool((np.abs(people - i) <= NEAR).any()) for i in at)
    mixed = MIXED.findall(text.lower())
    plain = ["".join(WORD.findall(w.translate(PLAIN))) for w in mixed]
    hidden = sum(weights[w] > 0 for w in plain)
    return [
        float(len(found)),
        len(found) / m,
        float(strong),
        strong / m,
        float(sum(found)),
        sum(found) / m,
        max(found, default=0.0),
        float(len({words[i] for i in at})),
        float(near),
        near / m,
        len(persons) / m,
        upper.sum() / n,
        runs / n,
        counts[33] / n,
        counts[63] / n,
        counts[_PUNCTUATION].sum() / n,
        counts[[35, 36, 37, 38, 42, 64]].sum() / n,
        counts[_DIGIT].sum() / n,
        triples / n,
        len(mixed) / m,
        float(hidden),
        hidden / m,
        float(np.log1p(len(words))),
        n / m,
    ]


class Trees:
    """Boosted trees of fixed depth for the logistic loss; splits are looked for between quantiles."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, least: float = 5.0):
        self.depth, self.rate = depth, rate
        self.start = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))) if len(y) else 0.0
        self.feature: list[np.ndarray] = []
        self.cut: list[np.ndarray] = []
        self.value: list[np.ndarray] = []
        if not len(y) or y.min() == y.max():
            return
        cuts = [np.unique(np.quantile(np.unique(c), np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        cell = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)])
        total = np.full(len(y), self.start)
        for _ in range(trees):
            p = 1.0 / (1.0 + np.exp(-total))
            slope, curve = p - y, p * (1 - p)
            node = np.zeros(len(y), dtype=np.int64)
            feature, cut = np.zeros(2**depth - 1, dtype=np.int64), np.full(2**depth - 1, np.inf)
            for level in range(depth):
                wide = 1 << level
                best = np.full(wide, 1e-6)
                chosen = [(0, bins)] * wide
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    k = len(c) + 1
                    g = np.bincount(node * k + cell[f], slope, wide * k).reshape(wide, k).cumsum(1)
                    h = np.bincount(node * k + cell[f], curve, wide * k).reshape(wide, k).cumsum(1)
                    left, right = h[:, :-1], h[:, -1:] - h[:, :-1]
                    gain = g[:, :-1] ** 2 / (left + 1) + (g[:, -1:] - g[:, :-1]) ** 2 / (right + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                    gain[(left < least / 4) | (right < least / 4)] = 0
                    at = gain.argmax(1)
                    for i in np.flatnonzero(gain[np.arange(wide), at] > best):
                        best[i], chosen[i] = gain[i, at[i]], (f, at[i])
                for i, (f, b) in enumerate(chosen):
                    feature[wide - 1 + i] = f
                    cut[wide - 1 + i] = cuts[f][b] if b < len(cuts[f]) else np.inf
                node = 2 * node + (x[np.arange(len(y)), feature[wide - 1 + node]] > cut[wide - 1 + node])
            value = -np.bincount(node, slope, 2**depth) / (np.bincount(node, curve, 2**depth) + 1) * rate
            total += value[node]
            self.feature.append(feature)
            self.cut.append(cut)
            self.value.append(value)

    def raw(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            for level in range(self.depth):
                at = (1 << level) - 1 + node
                node = 2 * node + (x[rows, feature[at]] > cut[at])
            total += value[node]
        return total


def learn_lexicons(sample: DataFrame, words: int = 4000, least: int = 3) -> list[dict[str, float]]:
    """Lexicons of the even folds, the odd folds and all: log odds of the terms that mark the positive documents most,
    by document frequency; `words` at most in each."""

    def distinct(batches):
        for batch in batches:
            for part in pieces_of(batch):
                found = [list({x for w in set(WORD.findall((t or "").lower())) for x in terms(w)}) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("label"), part.column("fold"), pa.array(found, pa.list_(pa.string()))], ["label", "fold", "terms"])

    side = {"even": F.col("fold") % 2 == 0, "odd": F.col("fold") % 2 == 1, "all": F.lit(True)}
    counts = [c for k, v in side.items() for c in (F.sum(F.when(v, F.col("label"))).alias(f"hit_{k}"), F.count(F.when(v, 1)).alias(f"n_{k}"))]
    totals = sample.agg(*counts).first()
    counted = sample.select("label", "fold", "text").mapInArrow(lean(distinct), "label int, fold int, terms array<string>")
    counted = counted.select("label", "fold", F.explode("terms").alias("term")).groupBy("term").agg(*counts)
    counted = counted.where((F.col("hit_all") >= least) & (F.length("term") > 2)).persist(StorageLevel.DISK_ONLY)
    lexicons = []
    for k in side:
        hit, n = F.coalesce(F.col(f"hit_{k}"), F.lit(0)), F.col(f"n_{k}")
        positive, negative = (totals[f"hit_{k}"] or 0) + 1.0, totals[f"n_{k}"] - (totals[f"hit_{k}"] or 0) + 1.0
        score = F.log((hit + 0.5) / positive) - F.log((n - hit + 0.5) / negative)
        spread = F.sqrt(1 / (hit + 0.5) + 1 / (n - hit + 0.5))
        best = counted.where(hit >= least).select("term", score.alias("score"), (score / spread).alias("z")).where("score > 1 and z > 2.5")
        rows = best.orderBy(F.desc("z"), "term").limit(words).collect()
        lexicons.append({r["term"]: float(r["score"]) for r in rows})
    counted.unpersist()
    return lexicons


def featured(batches, lexicon: dict[str, float], kept: list[str]):
    weights = Weights(lexicon)
    for batch in batches:
        for part in pieces_of(batch):
            rows = [features(t or "", weights) for t in part.column("text").to_pylist()]
            yield [part.column(c) for c in kept], np.array(rows, dtype=float).reshape(-1, FEATURES)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = 16_000, modulus: int = 4, remainder: int = 2) -> dict:
    """Model from at most `rows` labelled documents, fitted across two halves.

    The trees see features by the lexicon of the other half, and calibration sees scores by trees of the other half, so neither
    meets a value that its own labels made. Without labels, or with one class only, the score is the share of that class.
    """
    sample = labelled_sample(docs, labels, label, rows, modulus, remainder)
    even, odd, lexicon = learn_lexicons(sample)

    def run(batches):
        other = {0: Weights(odd), 1: Weights(even)}
        for batch in batches:
            for part in pieces_of(batch):
                x = [features(t or "", other[f % 2]) for t, f in zip(part.column("text").to_pylist(), part.column("fold").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("label"), part.column("fold"), pa.array(x, pa.list_(pa.float64()))], ["label", "fold", "x"])

    table = sample.select("label", "fold", "text").mapInArrow(lean(run), "label int, fold int, x array<double>")
    table = table.orderBy(F.xxhash64("x"), "label").toPandas()  # at most `rows` rows of FEATURES numbers
    x = np.array(table["x"].tolist(), dtype=float).reshape(-1, FEATURES)
    y, half = table["label"].to_numpy(dtype=float), table["fold"].to_numpy() % 2
    raw = np.zeros(len(y))
    for h in (0, 1):
        raw[half == h] = Trees(x[half != h], y[half != h]).raw(x[half == h])
    return {"weights": lexicon, "trees": Trees(x, y), "knots": fit_isotonic(raw, y)}


def score(docs: DataFrame, model: dict, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, score, predicted` for every row, from its whole text alone.

    A NULL text scores as an empty one. Rows are scored one by one, so NULL or repeated ids and repeated rows each get their
    row; an empty table gives an empty one.
    """

    def run(batches):
        for (doc_id,), x in featured(batches, model["weights"], ["doc_id"]):
            p = calibrated(model["trees"].raw(x), model["knots"])
            yield pa.RecordBatch.from_arrays([doc_id, pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return texts_of(docs, id_col, text_col).mapInArrow(lean(run), "doc_id long, score double, predicted int")


def keep_clean(docs: DataFrame, model: dict, threshold: float = 0.3) -> DataFrame:
    """The rows of `docs` that are not predicted toxic, with all their columns. Scored in place: no join, no shuffle.

    Every row is decided by its own text: a NULL or empty one scores as one without words, repeated rows stay or go together, and an
    empty table gives an empty one.
    """

    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = Weights(model["weights"])
        for texts in batches:
            found = [np.zeros(0, dtype=bool)]
            for part in text_slices(texts) if len(texts) else ():
                x = np.array([features(t or "", weights) for t in part], dtype=float).reshape(-1, FEATURES)
                found.append(calibrated(model["trees"].raw(x), model["knots"]) >= threshold)
            yield pd.Series(np.concatenate(found))
        give_back()

    return docs.where(~F.pandas_udf(predicted, "boolean")(F.col("text")))
