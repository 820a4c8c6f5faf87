"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 8 << 20


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the id and the text under fixed names, so that other columns can't clash."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def pieces_of(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts have about `limit` bytes, at least one row each."""
    if not batch.num_rows:
        return
    sizes = pa.compute.binary_length(batch.column(batch.schema.get_field_index(column))).fill_null(0).to_numpy(zero_copy_only=False)
    blocks = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = np.flatnonzero(np.diff(blocks)) + 1
    for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(int(start), int(end - start))


def text_slices(texts: pd.Series, limit: int = SLICE_BYTES) -> Iterator[list[str | None]]:
    """The texts of a pandas function's batch in lists of about `limit` characters, at least one text each."""
    ends = texts.str.len().fillna(0).cumsum().to_numpy() // limit
    cuts = np.flatnonzero(np.diff(ends)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(texts)]):
        yield texts.iloc[start:end].tolist()


def give_back() -> None:
    """Return memory that is no longer used to the system: a worker process outlives its task and shares the machine with the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim:
        trim(0)


def lean(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The task, giving memory back when it has ended."""

    def run(batches: Iterator) -> Iterator:
        yield from task(batches)
        give_back()

    return run


def held_out(id_col: str, modulus: int, remainder: int):
    """Rows that learning must not see: crc32 of the id as text, modulo `modulus`, is `remainder`. A NULL id is held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % modulus == remainder, F.lit(True))


def with_held_out(scored: DataFrame, modulus: int, remainder: int) -> DataFrame:
    first, *rest = scored.columns
    return scored.select(first, held_out(first, modulus, remainder).alias("held_out"), *rest)
