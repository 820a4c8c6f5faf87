"""Documents to token ids in five stages; each stage works on all rows that the one before kept.

`toxicity` drops documents predicted toxic, `near_duplicates` keeps one document of each group (five-word shingles, similarity
0.8), `decontamination` drops documents that hold a benchmark item, `secrets` replaces secrets in the texts, and `byte_bpe`
encodes and decodes what is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm import bpe, decontamination, minhash, secret_scan, toxicity
from statloom.session import materialise
from statloom.sources.tables import load


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated toxicity is under 0.3; an empty or NULL text scores as one without words."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")), threshold=0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; empty texts and rows without an id all stay."""
    return minhash.keep_first(docs, words=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item up to its budget of edits."""
    return decontamination.keep_clean(docs, load(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced; n_chars follows the new text."""
    redacted = secret_scan.redact(docs, secret_scan.fit(docs))
    if "n_chars" in redacted.columns:
        redacted = redacted.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))
    return redacted


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id, n_tokens, ids_sha256, decoded_sha256` of every document."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("secrets", redact_secrets),
    ("byte_bpe", encode_bytes),
]

ORACLE_SQL = None  # SQL can state neither the fitted models nor the signatures


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
