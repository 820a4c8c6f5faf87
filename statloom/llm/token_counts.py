"""Token counts of whole texts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces_of, texts_of
from .library import Library, shared_vocabulary

BATCH_BYTES = 4 << 20


def count_tokens(
    df: DataFrame, path: str, limit: int = 512, batch_bytes: int = BATCH_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id, n_bytes, n_tokens, over_limit` for every row.

    Rows are encoded in batches of about `batch_bytes` of text; long texts are cut where the tokenizer starts a new match
    anyway, so the sum of the parts is the count of the whole. Without begin, end or added special tokens, truncation or padding;
    special strings inside texts count as the library counts them. A NULL or empty text has 0 tokens. Ids may be NULL or
    repeat; other columns are not looked at; an empty table gives an empty one.
    """
    shared = shared_vocabulary(df, path)

    def run(batches):
        library = Library(shared.value)
        for batch in batches:
            for part in pieces_of(batch, limit=batch_bytes):
                counts = library.lengths([t or "" for t in part.column("text").to_pylist()])
                sizes = pa.compute.binary_length(part.column("text")).fill_null(0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), sizes, pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    counted = texts_of(df, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
