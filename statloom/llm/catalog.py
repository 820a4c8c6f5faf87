"""Named queries of the text operators, with SQL texts where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from statloom.session import new_shared_path
from statloom.sources.tables import load

from . import bpe, decontamination, dialogue, language, minhash, packing, pivots, quality, secret_scan, spelling, token_counts, token_tables, toxicity
from .common import with_held_out

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op7_byte_bpe(spark: SparkSession, directory: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(load(spark, directory, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op8_token_files(spark: SparkSession, directory: str) -> DataFrame:
    target = new_shared_path(spark, "tokens")
    token_tables.write_tokens(load(spark, directory, "documents"), target, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_tables.token_digests(spark, target)


@query
def op10_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    return token_counts.count_tokens(load(spark, directory, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@query
def op1_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    documents = load(spark, directory, "documents")
    model = toxicity.fit(documents, load(spark, directory, "labels"), "toxic", modulus=4, remainder=2)
    return with_held_out(toxicity.score(documents, model, threshold=0.3), 4, 2)


@query
def op2_quality(spark: SparkSession, directory: str) -> DataFrame:
    documents = load(spark, directory, "documents")
    model = quality.fit(documents, load(spark, directory, "labels"), "quality", modulus=4, remainder=2)
    return with_held_out(quality.score(documents, model, threshold=0.7), 4, 2)


@query
def op6_language(spark: SparkSession, directory: str) -> DataFrame:
    documents = load(spark, directory, "documents")
    model = language.fit(documents, public_tokenizers.path("piece_bpe_32k.model"), modulus=3, remainder=1)
    return with_held_out(language.predict(documents, model), 3, 1)


@query
def op4_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    return decontamination.leaks(load(spark, directory, "documents"), load(spark, directory, "benchmark"))


@query
def op3_secrets(spark: SparkSession, directory: str) -> DataFrame:
    documents = load(spark, directory, "documents")
    return secret_scan.scan(documents, secret_scan.fit(documents))


@query
def op5_minhash_forest(spark: SparkSession, directory: str) -> DataFrame:
    return minhash.near_duplicates(load(spark, directory, "documents"), words=2, percent=80)


@query
def op9_pivot_index(spark: SparkSession, directory: str) -> DataFrame:
    return pivots.near_vectors(load(spark, directory, "embeddings"), least=0.93)


@query
def op13_conversation_repair(spark: SparkSession, directory: str) -> DataFrame:
    return dialogue.repair_digests(dialogue.damaged(load(spark, directory, "conversations")))


@query
def op11_spelling_variants(spark: SparkSession, directory: str) -> DataFrame:
    words = spelling.vocabulary(spelling.runs_of(load(spark, directory, "documents"), modulus=97), least_letters=5, least_count=3)
    return spelling.spelling_groups(words, ratio=2)


@query
def op12_packing(spark: SparkSession, directory: str) -> DataFrame:
    return packing.pack(load(spark, directory, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, window=1024)
