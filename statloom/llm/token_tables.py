"""Token ids as Parquet files that can be read in parts.

One row per document, in ascending id order over the files: `part` (number of the file), `doc_id`, `local_start` (ids of the
file's earlier documents), `n_tokens`, `ids`. Integers that grow are delta-encoded, token ids dictionary-encoded where the pages
stay small. Row groups and pages have stated sizes, and their indexes hold the range of ids, so that a reader of some
documents, or of lengths alone, fetches only their pages.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import pieces_of
from .ordered import encoded, flat_ids, id_width

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2000

SCHEMA = T.StructType(
    [
        T.StructField("part", T.IntegerType(), False),
        T.StructField("doc_id", T.LongType()),
        T.StructField("local_start", T.LongType(), False),
        T.StructField("n_tokens", T.LongType(), False),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False), False),
    ]
)


def write_tokens(
    df: DataFrame, target: str, path: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text", dictionary: bool = True
) -> None:
    """Encode every whole text with the vocabulary file `path`, append `end_id`, and write the files to the folder `target`.

    Documents go to files by ranges of their id, a NULL id first; rows that share an id are ordered by their ids. A NULL or empty
    text has only the end id. Other columns are not read. An empty table gives a readable folder without rows. Texts are encoded where
    they are read; ids, not texts, are shuffled, and each task keeps one batch in memory.
    """
    width = id_width(path)

    def run(batches):
        part, start = None, 0
        for batch in batches:
            for rows in pieces_of(batch, "ids"):
                flat, sizes = flat_ids(rows.column("ids"), width)
                ends, parts = np.cumsum(sizes), rows.column("part").to_numpy(zero_copy_only=False)
                before = ends - sizes + start
                for at in np.flatnonzero(np.diff(parts, prepend=-1 if part is None else part)):
                    before[at:] -= before[at]  # a file starts
                part, start = parts[-1], int(before[-1] + sizes[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("part"),
                        rows.column("doc_id"),
                        pa.array(before),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat.astype(np.int32))),
                    ],
                    SCHEMA.names,
                )

    (
        encoded(df, path, end_id, id_col, text_col)
        .mapInArrow(run, SCHEMA)
        .write.option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.enable.dictionary", str(dictionary).lower())
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#local_start", "false")
        .option("parquet.enable.dictionary#n_tokens", "false")
        .option("compression", "zstd")
        .parquet(target)
    )


def read_tokens(spark: SparkSession, target: str, columns: list[str] | None = None, first: int | None = None, last: int | None = None) -> DataFrame:
    """Rows of the files, only the named columns and only ids from `first` to `last`; both choices reach the scan."""
    df = spark.read.schema(SCHEMA).parquet(target)
    if first is not None:
        df = df.where(F.col("doc_id") >= first)
    if last is not None:
        df = df.where(F.col("doc_id") <= last)
    return df.select(*columns) if columns else df


def file_starts(spark: SparkSession, target: str) -> DataFrame:
    """`part, base`: ids in all earlier files. Reads lengths only; one row per file, so the running sum is small."""
    totals = read_tokens(spark, target, ["part", "n_tokens"]).groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))


def token_digests(spark: SparkSession, target: str) -> DataFrame:
    """`doc_id, start, n_tokens, ids_crc32` as read back from the files; ids count as little-endian unsigned 32-bit integers."""

    def run(batches):
        for batch in batches:
            lists = batch.column("ids")
            flat = np.asarray(lists.values).astype("<u4", copy=False)
            ends = np.asarray(lists.offsets)
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("part", "doc_id", "local_start", "n_tokens")), pa.array(crc, pa.int64())],
                ["part", "doc_id", "local_start", "n_tokens", "ids_crc32"],
            )

    digests = read_tokens(spark, target).mapInArrow(run, "part int, doc_id long, local_start long, n_tokens long, ids_crc32 long")
    # one row per file
    joined = digests.join(F.broadcast(file_starts(spark, target)), "part")
    return joined.select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
