"""Documents that hold a benchmark item up to a budget of edits.

An item with an error budget of k edits is cut into k + 1 pieces; any occurrence with at most k edits leaves one piece untouched
(pigeonhole). All pieces are searched at once, and around each hit Myers' bit-parallel algorithm gives the exact edit
distance of the item to the nearest substring.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, pieces_of, texts_of

ERROR_RATE = 0.08
BLOCK_CHARS = 4 << 20  # item text searched in one pass

_OTHER = re.compile(r"[\W_]+")


def normal(text: str | None) -> str:
    """Lower case; what lies between letters and digits is one space."""
    return _OTHER.sub(" ", (text or "").lower()).strip()


def budget(item: str, rate: float) -> int:
    """Edits allowed for a normalised item; with them, its pieces have 1 / rate characters or so."""
    return int(len(item) * rate)


def cut(item: str, pieces: int) -> list[tuple[int, str]]:
    """(offset, text) of consecutive pieces that differ by one character in length at most."""
    ends = [len(item) * i // pieces for i in range(pieces + 1)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:])]


def nearest(item: str, text: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the substring of `text` with the fewest edits to `item`, the first of equals; None above `most`.

    One column of the edit matrix is two integers of as many bits as the item has characters.
    """
    where: dict[str, int] = {}
    for i, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    plus, minus, distance = full, 0, len(item)
    best = None
    for j, c in enumerate(text):
        match = where.get(c, 0)
        diagonal = (((match & plus) + plus) ^ plus) | match | minus
        up, down = minus | (full & ~(diagonal | plus)), plus & diagonal
        distance += bool(up & top) - bool(down & top)
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | (full & ~(diagonal | up)), up & diagonal
        if distance <= most and (best is None or distance < best[0]):
            best = distance, j + 1
    return best


class Items:
    """A block of items with one automaton over all their pieces."""

    def __init__(self, items: list[tuple[list[int], str]], rate: float):
        self.items = items
        self.budgets = [budget(text, rate) for _, text in items]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text) in enumerate(items):
            for offset, piece in cut(text, self.budgets[i] + 1):
                pieces.setdefault(piece, []).append((i, offset))
        self.pieces = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.pieces.add_word(piece, (len(piece), places))
        if pieces:
            self.pieces.make_automaton()

    def found(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(item, distance, end in the text) of the best occurrence of every item in a normalised text."""
        if not self.items or not text:
            return
        starts: dict[int, set[int]] = {}
        for last, (length, places) in self.pieces.iter(text):
            for i, offset in places:
                starts.setdefault(i, set()).add(last - length + 1 - offset)
        for i, found in sorted(starts.items()):
            item, most = self.items[i][1], self.budgets[i]
            best, reach = None, -1
            for start, end in self._windows(sorted(found), len(item), most):
                start, end = max(start, 0), min(end, len(text))
                hit = nearest(item, text[start:end], most if best is None else best[0] - 1)
                if hit is not None:
                    best, reach = hit, start + hit[1]
                    if hit[0] == 0:
                        break
            if best is not None:
                yield i, best[0], reach

    @staticmethod
    def _windows(starts: list[int], size: int, most: int) -> Iterator[tuple[int, int]]:
        """Stretches of text that hold every occurrence whose untouched piece puts it at one of the starts."""
        low = high = starts[0]
        for s in starts[1:]:
            if s - high > size:
                yield low - most, high + size + most
                low = s
            high = s
        yield low - most, high + size + most


def blocks(benchmark: DataFrame, rate: float, chars: int, id_col: str, text_col: str) -> Iterator[Items]:
    """The items in blocks of about `chars` characters; items of equal text are searched once. Reads one block at a time."""
    items: dict[str, list[int]] = {}
    size = 0
    for row in texts_of(benchmark, id_col, text_col).orderBy("doc_id").toLocalIterator():
        text = normal(row["text"])
        if not text or row["doc_id"] is None:
            continue
        if text not in items and size + len(text) > chars and items:
            yield Items([(sorted(set(ids)), t) for t, ids in items.items()], rate)
            items, size = {}, 0
        size += 0 if text in items else len(text)
        items.setdefault(text, []).append(row["doc_id"])
    yield Items([(sorted(set(ids)), t) for t, ids in items.items()], rate)


def _stated(block: Items, rate: float):
    """What tasks need to build the block again: an automaton doesn't travel."""
    return block.items, rate


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """`doc_id, item_id, distance, end`: every pair of a document and an item that it holds within the item's budget.

    An item's budget is `rate` of its normalised length, rounded down. `distance` is the least over the whole text, `end` the place
    behind the first such occurrence, both in normalised characters. Items without a letter or digit, NULL
    texts and NULL item ids match nothing; items of equal text all match; a row with a NULL or repeated id is searched
    like any other, equal result rows appear once. The items are a stated query set: each block of them is one pass over the documents.
    """

    def run_for(stated):
        def run(batches):
            block = Items(*stated)
            for batch in batches:
                for part in pieces_of(batch):
                    rows = [
                        (d, item_id, distance, end)
                        for d, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist())
                        for i, distance, end in block.found(normal(t))
                        for item_id in block.items[i][0]
                    ]
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)

        return run

    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("end", pa.int64())])
    found = None
    for block in blocks(benchmark, rate, block_chars, item_id_col, item_text_col):
        part = texts_of(docs, id_col, text_col).mapInArrow(run_for(_stated(block, rate)), "doc_id long, item_id long, distance int, end long")
        found = part if found is None else found.unionByName(part)
    return found.distinct()


def keep_clean(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of `docs` that hold no item, with all their columns. Decided in place: no join, no shuffle.

    Every row is decided by its own text: a NULL or empty one holds nothing and stays, repeated rows stay or go together. An empty
    table, or an empty benchmark, changes nothing.
    """

    def held_for(stated):
        def held(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            block = Items(*stated)
            for texts in batches:
                yield pd.Series([any(True for _ in block.found(normal(t))) for t in texts], dtype=bool)
            give_back()

        return F.pandas_udf(held, "boolean")

    for block in blocks(benchmark, rate, block_chars, "item_id", "text"):
        docs = docs.where(~held_for(_stated(block, rate))(F.col("text").cast("string")))
    return docs
