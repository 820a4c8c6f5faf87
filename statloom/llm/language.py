"""Language of a text by unigram models over a public vocabulary, summed over all segmentations.

A text is its runs of letters in lower case, each with a word mark before it. For every language the vocabulary's pieces have
probabilities, learned by expectation maximisation over all segmentations of the words; a word's probability is the
forward sum over its segmentations, and a text's is the product over its words.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, pieces_of, texts_of
from .tables import IntTable

WORD = re.compile(r"[^\W\d_]+")
MARK = "▁"
UNKNOWN = 1e-7  # probability of a character that is no piece
RESCALED = 8  # positions between two scalings of the running sums, which else leave the range of floating-point numbers
SIDE_BY_SIDE, CELLS = 8192, 1 << 18  # words of one length that are summed together, and their letters
STEP = np.uint64(0x100000001B3)


def vocabulary(path: str) -> list[str]:
    """Pieces of a sentencepiece file that words of letters can hold."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i)))
    return sorted({p for p in pieces if p == p.lower() and all(c == MARK or c.isalpha() for c in p) and MARK not in p[1:]})


def _hash(text: str) -> int:
    value = 0
    for c in text:
        value = (value * int(STEP) + ord(c)) & (1 << 64) - 1
    return value & (1 << 63) - 1


class Lattice:
    """All segmentations of words into pieces. Built once on the driver and broadcast: a few MB, set by the vocabulary alone."""

    def __init__(self, pieces: list[str]):
        self.index = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces))
        keys = np.array([_hash(p) for p in pieces], dtype=np.int64)
        starts = np.array(sorted({_hash(p[:n]) for p in pieces for n in range(1, len(p) + 1)}), dtype=np.int64)
        self.table = IntTable(keys, np.arange(len(pieces)), -1)
        self.starts = IntTable(starts, np.ones(len(starts)), 0)

    def arcs(self, codes: np.ndarray):
        """(start, length, rows, piece) of every piece found; `codes` has one marked word of equal length per row. Piece -1
        is a single character outside the vocabulary."""
        n = codes.shape[1]
        for start in range(n):
            rows, value = np.arange(len(codes)), np.zeros(len(codes), dtype=np.uint64)
            for length in range(1, min(self.longest, n - start) + 1):
                value = value * STEP + codes[rows, start + length - 1]
                key = (value & np.uint64((1 << 63) - 1)).astype(np.int64)
                piece = self.table.get(key)
                if length == 1:
                    yield start, 1, rows, piece
                else:
                    hit = piece >= 0
                    if hit.any():
                        yield start, length, rows[hit], piece[hit]
                going = self.starts.get(key) > 0
                if not going.all():
                    rows, value = rows[going], value[going]
                if not len(rows):
                    break

    @staticmethod
    def by_length(words: list[str]) -> dict[int, list[int]]:
        groups: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            groups.setdefault(len(w), []).append(i)
        return groups

    @staticmethod
    def codes(words: list[str]) -> np.ndarray:
        flat = np.frombuffer("".join(MARK + w for w in words).encode("utf-32-le"), dtype=np.uint32)
        return flat.reshape(len(words), -1).astype(np.uint64)

    @classmethod
    def parts(cls, words: list[str]):
        """(length, numbers of words of that length) in parts of bounded size."""
        for length, which in cls.by_length(words).items():
            step = max(1, min(SIDE_BY_SIDE, CELLS // length))
            for at in range(0, len(which), step):
                yield length, which[at : at + step]

    def log_probabilities(self, words: list[str], p: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language; `p` has a row per piece, and a last row for unknown characters."""
        out = np.zeros((len(words), p.shape[1]))
        for length, part in self.parts(words):
            total = {0: np.ones((len(part), p.shape[1]))}
            scale, scaled = np.zeros_like(total[0]), 0
            for start, size, rows, piece in self.arcs(self.codes([words[i] for i in part])):
                if start >= scaled + RESCALED:
                    scaled = start
                    total = {at: t for at, t in total.items() if at >= start}
                    top = np.maximum.reduce(list(total.values()))
                    scale += np.log(top)
                    for t in total.values():
                        t /= top
                if start + size not in total:
                    total[start + size] = np.zeros_like(scale)
                if len(rows) == len(part):
                    total[start + size] += total[start] * p[piece]
                else:
                    total[start + size][rows] += total[start][rows] * p[piece]
            out[part] = np.log(total[length + 1]) + scale
        return out

    def expected(self, words: list[str], weights: np.ndarray, which: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected counts of (piece, language) over all segmentations; word i counts `weights[i]` times in language `which[i]`."""
        counts = np.zeros(p.size)
        for length, part in self.parts(words):
            part = np.array(part)
            lang, weight = which[part], weights[part]
            arcs = [(s, k, r, q, p[q, lang[r]]) for s, k, r, q in self.arcs(self.codes([words[i] for i in part]))]
            # sums over the beginnings and over the ends of words, each with the log of what it was divided by
            ahead, back = np.zeros((length + 2, len(part))), np.zeros((length + 2, len(part)))
            ahead_log, back_log = np.zeros_like(ahead), np.zeros_like(back)
            ahead[0] = back[-1] = 1.0
            scaled = 0
            for s, k, r, _, v in arcs:
                if s >= scaled + RESCALED:
                    scaled, open_ = s, slice(s, s + self.longest)
                    top = ahead[open_].max(0)
                    ahead[open_] /= top
                    ahead_log[s:] += np.log(top)
                ahead[s + k, r] += ahead[s, r] * v
            scaled = length + 1
            for s, k, r, _, v in reversed(arcs):
                if s <= scaled - RESCALED:
                    scaled, open_ = s, slice(s + 1, s + 1 + self.longest)
                    top = back[open_].max(0)
                    back[open_] /= top
                    back_log[: s + 1 + self.longest] += np.log(top)
                back[s, r] += back[s + k, r] * v
            for s, k, r, q, v in arcs:
                scale = np.exp(ahead_log[s, r] + back_log[s + k, r] - ahead_log[-1, r])
                share = ahead[s, r] * v * back[s + k, r] / ahead[-1, r] * scale * weight[r]
                known = q >= 0
                counts += np.bincount(q[known] * p.shape[1] + lang[r[known]], share[known], p.size)
        return counts.reshape(p.shape)


def fit(
    docs: DataFrame, path: str, lang_col: str = "lang", per_language: int = 2000, rounds: int = 4, modulus: int = 3, remainder: int = 1
) -> dict:
    """Piece probabilities per language, from about `per_language` documents of each, chosen by a hash of the id.

    Only rows with a language and outside the held-out part are read. Each round is a Spark job over the distinct words of
    the sample; what returns to the driver is one number per piece and language.
    """
    seen = docs.where(F.col(lang_col).isNotNull() & ~held_out("doc_id", modulus, remainder))
    sizes = {r[0]: r[1] for r in seen.groupBy(lang_col).count().collect()}  # one row per language
    languages = sorted(sizes)
    pieces = vocabulary(path)
    uniform = np.full((len(pieces) + 1, max(len(languages), 1)), 1.0 / len(pieces))
    uniform[-1] = UNKNOWN
    if not languages:
        return {"pieces": pieces, "languages": [], "p": uniform}
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, per_language / sizes[k]))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) / float(1 << 20)
    sample = seen.where(draw < share[F.col(lang_col)]).select(F.col(lang_col).alias("lang"), F.col("text").cast("string").alias("text"))

    def counted(batches):
        for batch in batches:
            for part in pieces_of(batch):
                found = Counter((k, w) for k, t in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()) for w in WORD.findall((t or "").lower()))
                rows = list(found)
                yield pa.RecordBatch.from_pydict({"lang": [k for k, _ in rows], "word": [w for _, w in rows], "n": list(found.values())})

    words = sample.mapInArrow(counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = words.persist(StorageLevel.DISK_ONLY)
    p, shared = uniform, words.sparkSession.sparkContext.broadcast(Lattice(pieces))
    for _ in range(rounds):
        current = words.sparkSession.sparkContext.broadcast(p)  # pieces by languages

        def expected(batches, current=current):
            lattice, number = shared.value, {k: i for i, k in enumerate(languages)}
            total = np.zeros_like(current.value)
            for batch in batches:
                which = np.array([number[k] for k in batch.column("lang").to_pylist()], dtype=np.int64)
                total += lattice.expected(batch.column("word").to_pylist(), batch.column("n").to_numpy().astype(float), which, current.value)
            at, lang = np.nonzero(total)
            yield pa.RecordBatch.from_pydict({"piece": at, "lang": lang, "n": total[at, lang]})

        sums = words.mapInArrow(expected, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        counts = np.zeros_like(p)
        counts[sums["piece"], sums["lang"]] = sums["n"].round(6)
        p = (counts + 0.01) / (counts[:-1].sum(0) + 0.01 * len(pieces))
        p[-1] = UNKNOWN
    words.unpersist()
    return {"pieces": pieces, "languages": languages, "p": p}


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", kept: int = 300_000) -> DataFrame:
    """`doc_id, lang_pred, score` for every row: the language under which the whole text is likeliest, and its share among all.

    `und` with score 0 for a NULL text, one without letters, or a model without languages. Ties go to the first
    language in alphabetical order. Rows are scored one by one, so NULL or repeated ids get their rows; an empty table
    gives an empty one. At most about `kept` words are remembered per task.
    """
    shared = docs.sparkSession.sparkContext.broadcast((Lattice(model["pieces"]), model["p"]))
    languages = model["languages"]

    def run(batches):
        lattice, p = shared.value
        place: dict[str, int] = {}
        logs = np.zeros((0, p.shape[1]))
        for batch in batches:
            for part in pieces_of(batch):
                if len(place) > kept:
                    place, logs = {}, logs[:0]
                texts = [WORD.findall((t or "").lower()) for t in part.column("text").to_pylist()]
                new = list(set().union(*texts) - place.keys())
                place.update(zip(new, range(len(place), len(place) + len(new))))
                logs = np.concatenate([logs, lattice.log_probabilities(new, p)])
                get = place.__getitem__
                total = np.array([logs[list(map(get, words))].sum(0) for words in texts])
                best = total.argmax(1)
                share = 1.0 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                known = [bool(words and languages) for words in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([languages[b] if k else "und" for b, k in zip(best, known)]),
                        pa.array(np.where(known, share, 0.0)),
                    ],
                    ["doc_id", "lang_pred", "score"],
                )

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")
