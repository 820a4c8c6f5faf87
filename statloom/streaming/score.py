"""Scoring streams with fitted models.

Fitted models, scalers and cluster centres become column expressions, so the same functions that
score a table score a stream; nothing is kept between batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def read_stream(spark: SparkSession, directory: str, schema) -> DataFrame:
    """Files that arrive in a folder, as a streaming table of a declared schema."""
    return spark.readStream.schema(schema).parquet(directory)


def score_stream(
    stream: DataFrame, score: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, all_at_once: bool = True
) -> StreamingQuery:
    """Append scored rows to `target`, each input row once, resuming from `checkpoint`."""
    writer = score(stream).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if all_at_once else writer).outputMode("append").start()
