"""Packing of token streams into windows of bounded length by order-preserving dynamic programming.

Documents follow each other in order of their ids, and windows are cut out of that stream, so nothing but the cuts is to be chosen. The
cost of a window is the padding it needs, a little for the window itself, and a penalty for a cut inside a document: small at the end of a
sentence, larger elsewhere. `cost[j]` is the least cost of cutting the stream up to candidate j:

    cost[j] = penalty[j] + least over i within `window` ids of (cost[i] + padding(j - i)) + window cost

Padding to the full window makes the inner term `cost[i] + position[i]` up to what depends on j alone, so a monotone queue
yields its minimum over the sliding window in constant time a candidate. A window whose length is a power of two needs no
padding; its one possible start is looked up for each power.
"""

from __future__ import annotations

import json
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statloom.session import materialise

from .common import pieces_of
from .library import byte_letters
from .ordered import encoded, flat_ids, id_width

WINDOW = 1024
SENTENCE, ANYWHERE, EACH = 1, 8, 1  # penalties of cuts inside documents, and the cost of a window, in ids of padding
STRETCH = 1 << 20  # ids whose cuts are chosen together
SHORTEST = 16  # a window may be as short as this part of the full one, if its length is a power of two
GAP = 32  # where candidates are farther apart, cuts anywhere are offered at this distance
CLOSING, ENDING = "\"')]}»”’", (".", "!", "?", "…", "。", "！", "？")
PIECES = "part int, local_sequence long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, offset long"


def sentence_marks(path: str) -> tuple[np.ndarray, np.ndarray]:
    """By id: whether a sentence can end with it, and whether a word can start with it (a space or a line break first)."""
    if path.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        texts = {i: model.id_to_piece(i).replace("▁", " ") for i in range(model.vocab_size())}
    else:
        stated = json.loads(Path(path).read_text())["model"]["vocab"]
        letters = {c: b for b, c in byte_letters().items()}
        texts = {i: bytes(letters.get(c, 63) for c in t).decode("utf-8", "replace") for t, i in stated.items()}
    ends, starts = np.zeros(max(texts) + 2, bool), np.zeros(max(texts) + 2, bool)
    for i, t in texts.items():
        ends[i] = "\n" in t or t.rstrip(CLOSING).endswith(ENDING)
        starts[i] = t[:1].isspace()
    return ends, starts


def candidates(flat: np.ndarray, doc_ends: np.ndarray, marks: tuple[np.ndarray, np.ndarray], gap: int = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Positions between ids where a cut is offered, and the penalty of each: ends of documents and sentences, and cuts elsewhere wherever
    two of these are farther apart than `gap`. Position 0 and the end are among them."""
    ends, starts = (m[np.minimum(flat, len(m) - 1)] for m in marks)
    sentence = np.flatnonzero(ends[:-1] & starts[1:]) + 1
    good = np.unique(np.concatenate([[0], sentence, doc_ends]))
    wide = np.flatnonzero(np.diff(good) > gap)
    between = [np.arange(good[i] + gap, good[i + 1], gap) for i in wide]
    free = np.concatenate([np.zeros(0, np.int64), *between])
    position = np.concatenate([good, free])
    penalty = np.concatenate([np.full(len(good), SENTENCE), np.full(len(free), ANYWHERE)])
    penalty[np.isin(position, doc_ends) | (position == 0)] = 0
    order = np.argsort(position)
    return position[order], penalty[order]


def best_cuts(position: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Least cost of cutting the stream up to each candidate, and the candidate where its last window starts."""
    n, pairs = len(position), []
    for p in (1 << k for k in range(window.bit_length() - 1)):
        if p >= window // SHORTEST:
            at = np.searchsorted(position, position - p)
            hit = np.flatnonzero(position[at] == position - p)
            pairs.append(np.stack([hit, at[hit]]))
    exact = np.concatenate([*pairs, [[n], [0]]], axis=1)
    exact = exact[:, np.argsort(exact[0], kind="stable")]
    ends, starts, k = exact[0].tolist(), exact[1].tolist(), 0
    extra = (penalty + EACH).tolist()
    cost, before = [0] * n, [0] * n
    where, reach, who, first = [0], [0], [0], 0  # candidates in reach: their positions, cost + position rising, and numbers
    for j, here in enumerate(position.tolist()):
        if not j:
            continue
        while where[first] < here - window:
            first += 1
        best, i = reach[first] + window - here, who[first]
        while ends[k] == j:
            if cost[starts[k]] < best:
                i = starts[k]
                best = cost[i]
            k += 1
        cost[j], before[j] = best + extra[j], i
        value = cost[j] + here
        while len(reach) > first and reach[-1] > value:
            reach.pop()
            where.pop()
            who.pop()
        reach.append(value)
        where.append(here)
        who.append(j)
    return np.array(cost), np.array(before)


def windows(flat: np.ndarray, doc_ends: np.ndarray, marks, final: bool, window: int = WINDOW) -> np.ndarray:
    """Bounds of the windows chosen for a stretch. Unless it is `final`, they stop at the cheapest candidate among those within a
    window of its end, and the rest is to be looked at again with what follows."""
    position, penalty = candidates(flat, doc_ends, marks)
    cost, before = best_cuts(position, penalty, window)
    last = len(position) - 1
    if not final:
        near = np.flatnonzero(position > position[-1] - window)
        last = int(near[np.lexsort((-position[near], cost[near]))[0]])
    chosen = [last]
    while chosen[-1]:
        chosen.append(int(before[chosen[-1]]))
    return position[chosen[::-1]]


class Stream:
    """Documents of a part in order, from which whole windows are taken as soon as a stretch is full."""

    def __init__(self, part: int, marks, window: int, stretch: int):
        self.part, self.marks, self.window, self.stretch = part, marks, window, stretch
        self.flat: list[np.ndarray] = []
        self.docs: list[tuple] = []  # id, ids in all, ids of it before what is held, ids held
        self.held = self.sequences = 0

    def add(self, doc_id, ids: np.ndarray):
        self.flat.append(ids)
        self.docs.append((doc_id, len(ids), 0, len(ids)))
        self.held += len(ids)
        if self.held >= self.stretch:
            yield self.take(False)

    def take(self, final: bool) -> pa.RecordBatch:
        flat = np.concatenate(self.flat)
        held = np.array([d[3] for d in self.docs])
        ends = np.cumsum(held)
        bounds = windows(flat, ends, self.marks, final, self.window)
        stop = bounds[-1]
        cuts = np.unique(np.concatenate([bounds, ends[ends < stop]]))
        start, length = cuts[:-1], np.diff(cuts)
        sequence = np.searchsorted(bounds, start, "right") - 1
        doc = np.searchsorted(ends, start, "right")
        skipped, whole = (np.array([d[k] for d in self.docs], dtype=np.int64) for k in (2, 1))
        bytes_ = memoryview(flat[:stop].astype("<u4").view(np.uint8))
        crc = [zlib.crc32(bytes_[4 * a : 4 * b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        columns = [
            pa.array(np.full(len(start), self.part, np.int32)),
            pa.array(sequence + self.sequences),
            pa.array([self.docs[i][0] for i in doc.tolist()], pa.int64()),
            pa.array(start - (ends - held)[doc] + skipped[doc]),
            pa.array(length),
            pa.array(crc, pa.int64()),
            pa.array(whole[doc]),
            pa.array(start - bounds[sequence]),
        ]
        self.sequences += len(bounds) - 1
        kept = int(np.searchsorted(ends, stop, "right"))
        self.docs = [
            (i, n, before + max(0, stop - (end - some)), some - max(0, stop - (end - some)))
            for (i, n, before, some), end in zip(self.docs[kept:], ends[kept:].tolist())
        ]
        self.flat, self.held = [flat[stop:].copy()], len(flat) - int(stop)
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PIECES.split(", ")])


def packed_parts(
    df: DataFrame, path: str, end_id: int = 0, window: int = WINDOW, stretch: int = STRETCH, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """Pieces of all documents, sequences numbered within their part (see `encoded`)."""
    shared = df.sparkSession.sparkContext.broadcast(sentence_marks(path))  # two flags for each id of the vocabulary
    width = id_width(path)

    def run(batches):
        stream = None
        for batch in batches:
            for rows in pieces_of(batch, "ids"):
                flat, sizes = flat_ids(rows.column("ids"), width)
                ends = np.cumsum(sizes)
                for part, doc_id, a, b in zip(rows.column("part").to_pylist(), rows.column("doc_id").to_pylist(), (ends - sizes).tolist(), ends.tolist()):
                    if stream is None or part != stream.part:
                        if stream and stream.held:
                            yield stream.take(True)
                        stream = Stream(part, shared.value, window, stretch)
                    yield from stream.add(doc_id, flat[a:b])
        if stream and stream.held:
            yield stream.take(True)

    return encoded(df, path, end_id, id_col, text_col, **options).mapInArrow(run, PIECES)


def pack(df: DataFrame, path: str, end_id: int = 0, window: int = WINDOW, **options) -> DataFrame:
    """`doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`: one row for each piece of a document in a sequence.

    Every id, `end_id` behind each document included, lies in exactly one piece. Documents keep the order of their ids, NULL ids first, rows
    that share an id in the order of their ids' bytes; a NULL or empty text is its end id alone. Sequences do not cross the parts of
    `encoded`, ranges of some thousand documents that depend on the table alone, and their numbers run on from part to part. A task holds
    a stretch of about `STRETCH` ids and the document that ends it. An empty table gives an empty one.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    pieces = materialise(packed_parts(df, path, end_id, window, **options), "pieces")
    totals = pieces.groupBy("part").agg((F.max("local_sequence") + 1).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    joined = pieces.join(F.broadcast(bases), "part")  # a row for each part, at most ordered.MOST
    return joined.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("local_sequence")).alias("sequence_id"), "offset")


def padding(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """`sequences, ids, padding`: what the sequences of `pieces` need to reach the window, powers of two excepted."""
    filled = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    needs = F.when(F.expr("n & (n - 1)") == 0, 0).otherwise(F.lit(window) - F.col("n"))
    return filled.agg(F.count(F.lit(1)).alias("sequences"), F.sum("n").alias("ids"), F.sum(needs).alias("padding"))
