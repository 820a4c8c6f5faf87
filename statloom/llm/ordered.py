"""Token ids of documents, dealt to tasks in document order without encoding anything twice."""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from statloom.plans.order_stats import order_statistics

from .common import pieces_of, texts_of
from .library import shared_vocabulary
from .unit_ids import UnitIds

ROWS = 4096  # documents of a part
ENCODED_BYTES = 4 << 20  # text encoded at a time
MOST = 20_000  # parts at most; beyond, they hold more documents, which are streamed
SCHEMA = "part int, doc_id long, ids binary"


@dataclass(frozen=True)
class Parts:
    """Ranges of ids of about equal numbers of rows. NULL ids come first; the rows of an id that fills several parts are dealt among
    these by a digest of their ids."""

    nulls: int
    cuts: np.ndarray

    @property
    def number(self) -> int:
        return self.nulls + len(self.cuts) + 1

    def of(self, ids: np.ndarray, missing: np.ndarray, digest) -> np.ndarray:
        low, high = np.searchsorted(self.cuts, ids, "left"), np.searchsorted(self.cuts, ids, "right")
        part = high + self.nulls
        for i in np.flatnonzero((high - low > 1) & ~missing):
            part[i] = self.nulls + low[i] + 1 + digest(i) % (high[i] - low[i])
        for i in np.flatnonzero(missing):
            part[i] = digest(i) % self.nulls
        return part.astype(np.int32)


def parts_of(texts: DataFrame, rows: int = ROWS, most: int = MOST) -> Parts:
    """Cuts between parts as exact order statistics of the id alone, so the same table gives the same parts however it is partitioned."""
    n, known = texts.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    parts = min(most, max(1, math.ceil(known / rows)))
    ranks = sorted({i * known // parts + 1 for i in range(1, parts)})
    _, found = order_statistics(texts, F.col("doc_id"), lambda _g, _n: ranks)
    cuts = [found[0][r].value for r in ranks] if ranks else []
    return Parts(min(most, math.ceil((n - known) / rows)), np.array(cuts, dtype=np.int64))


def id_width(path: str) -> int:
    """Bytes that hold any id of the vocabulary: 2 or 4."""
    if path.endswith(".model"):
        size = sentencepiece.SentencePieceProcessor(model_file=path).vocab_size()
    else:
        size = Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
    return 2 if size <= 1 << 16 else 4


def encoded(df: DataFrame, path: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text", rows: int = ROWS) -> DataFrame:
    """`part, doc_id, ids`: each document's ids and `end_id`, little-endian in `id_width(path)` bytes, part by part in ascending order of
    id (NULL first), then of the ids' bytes.

    Texts are encoded where they are read and only ids are shuffled. A NULL or empty text has only the end id.
    """
    texts = texts_of(df, id_col, text_col)
    parts, width, shared = parts_of(texts, rows), id_width(path), shared_vocabulary(df, path)

    def run(batches):
        dtype = np.dtype(f"<u{width}")
        encoder = UnitIds(shared.value, dtype)
        tail = np.zeros(0, dtype) if end_id is None else np.array([end_id], dtype)
        for batch in batches:
            for piece in pieces_of(batch, limit=ENCODED_BYTES):
                flat, counts = encoder.encode(piece.column("text"))
                flat = np.insert(flat, np.repeat(np.cumsum(counts), len(tail)), np.tile(tail, len(counts)))
                ends = np.cumsum(counts + len(tail)) * width
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                found = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])
                ids = piece.column("doc_id")
                missing = ids.is_null().to_numpy(zero_copy_only=False)
                part = parts.of(ids.fill_null(0).to_numpy(zero_copy_only=False), missing, lambda i, found=found: zlib.crc32(found[i].as_buffer()))
                yield pa.RecordBatch.from_arrays([pa.array(part), ids, found], ["part", "doc_id", "ids"])

    dealt = texts.mapInArrow(run, SCHEMA).repartitionById(parts.number, "part")
    return dealt.sortWithinPartitions("part", "doc_id", "ids")


def flat_ids(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of `encoded` one after another, and the number of each row."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return whole.view(f"<u{width}"), np.diff(offsets).astype(np.int64) // width
