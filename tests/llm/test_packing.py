"""Packing against the library's ids, and cuts against the plain quadratic recursion."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from statloom.llm import ordered, packing
from statloom.llm.catalog import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(texts, end):
    return [e.ids + [end] for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(pieces, documents, window=1024):
    """Every id in exactly one piece, sequences gapless and in order; returns the share of padding."""
    pieces = [r.asDict() for r in pieces.collect()]
    left = defaultdict(list)
    for (doc, _), ids in zip(documents, ids_of([t for _, t in documents], 0)):
        left[doc].append(ids)
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append(p)
    assert sorted(sequences) == list(range(len(sequences)))
    padding, stream = 0, []
    for number in sorted(sequences):
        rows = sorted(sequences[number], key=lambda p: p["offset"])
        filled = 0
        for p in rows:
            assert p["offset"] == filled and p["length"] > 0
            filled += p["length"]
        assert filled <= window
        padding += 0 if filled & (filled - 1) == 0 else window - filled
        stream += rows
    whole, order = [], []
    for p in stream:
        if p["start"] == 0:
            whole.append([])
            order.append(p["doc_id"])
        whole[-1].append(p)
    assert len(whole) == len(documents)
    assert order == sorted(order, key=lambda i: (i is not None, i))
    for parts in whole:
        found = [ids for ids in left[parts[0]["doc_id"]] if len(ids) == parts[0]["doc_tokens"]]
        for ids in found:
            at = 0
            for p in parts:
                same = p["start"] == at and p["ids_crc32"] == zlib.crc32(np.array(ids[at : at + p["length"]], "<u4").tobytes())
                if not same:
                    break
                at += p["length"]
            else:
                if at == len(ids):
                    left[parts[0]["doc_id"]].remove(ids)
                    break
        else:
            raise AssertionError(parts)
    return padding / (sum(p["length"] for p in pieces) or 1)


def test_query_over_the_whole_table(spark, data):
    documents = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    assert check(QUERIES["op12_packing"](spark, data), documents) < 0.01


@pytest.mark.parametrize("options", [{}, {"rows": 2}, {"rows": 3, "stretch": 3000}])
def test_odd_rows_and_layouts(spark, odd, options):
    documents = [(r["doc_id"], r["text"]) for r in odd.collect()]
    results = []
    for parts in (1, 4):
        pieces = packing.pack(odd.repartition(parts), PATH, **options)
        check(pieces, documents)
        results.append(sorted(pieces.collect(), key=lambda r: (r["sequence_id"], r["offset"])))
    assert results[0] == results[1]


def test_one_id_and_null_hold_most_rows(spark):
    documents = [(7, f"text number {i} " * (i % 9)) for i in range(60)] + [(None, f"none {i}") for i in range(40)] + [(i, "a b c") for i in range(20)]
    df = spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    texts = df.select("doc_id", "text")
    parts = ordered.parts_of(texts, rows=8)
    assert parts.nulls == 5 and parts.number == 15
    check(packing.pack(df, PATH, rows=8), documents)


def test_empty_table(spark, none):
    assert packing.pack(none, PATH).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_cuts_equal_the_plain_recursion(seed):
    rng = np.random.default_rng(seed)
    window = 16
    position = np.unique(np.concatenate([[0], np.cumsum(rng.integers(1, 12, 80))]))
    penalty = rng.choice([0, packing.SENTENCE, packing.ANYWHERE], len(position))
    cost, before = packing.best_cuts(position, penalty, window)
    least = [0] * len(position)
    for j in range(1, len(position)):
        options = []
        for i in range(j):
            n = int(position[j] - position[i])
            if n <= window:
                options.append(least[i] + (0 if n & (n - 1) == 0 else window - n))
        least[j] = min(options) + int(penalty[j]) + packing.EACH
    assert cost.tolist()[1:] == least[1:]
    for j in range(1, len(position)):
        n = int(position[j] - position[before[j]])
        assert least[j] == least[before[j]] + (0 if n & (n - 1) == 0 else window - n) + int(penalty[j]) + packing.EACH


def test_cuts_prefer_documents_then_sentences():
    marks = np.zeros(100, bool), np.zeros(100, bool)
    marks[0][1], marks[1][2] = True, True  # 1 ends a sentence, 2 starts a word
    flat = np.full(2040, 5)
    flat[1022], flat[1023] = 1, 2
    assert packing.windows(flat, np.array([2040]), marks, True)[1] == 1023
    assert packing.windows(flat, np.array([1022, 2040]), marks, True)[1] == 1022
