"""Token operators against the libraries."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from statloom.llm import bpe, catalog, token_counts, token_tables, unit_ids
from statloom.llm.library import Library, vocabulary_file
from statloom.llm.unit_ids import UnitIds
from statloom.llm.units import units
from statloom.session import new_shared_path

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
PARTS = [" ", "  ", "\n", "\t", "a", "the", "Ü", "😀", "\x1c", "\x85", "　", "'s", "'", "1", "23", "...", "%", "ñ", "x" * 40, "\r\n", "\xa0", "a b", "<|endoftext|>", "word.", "東京"]


def texts(n: int = 2000) -> list[str]:
    draw = random.Random(5)
    out = ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 25))) for _ in range(n)]
    return [*out, "", "ab" * 700, "".join(draw.choice("abcdefgh%$é") for _ in range(9000))]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_segment_tree_merges_as_the_library(reference):
    model = bpe.ByteBPE(bpe.merge_tables(RANKS, P.PATTERN))
    for text, ids in zip(texts(), model.encode(texts())):
        assert ids.tolist() == reference.encode_ordinary(text)
        assert model.decode(ids.tolist()) == text.encode()


def test_long_and_short_pieces_agree():
    model = bpe.ByteBPE(bpe.merge_tables(RANKS, P.PATTERN))
    draw = random.Random(1)
    pieces = [bytes(draw.choice(b"abcdeinst \xc3\xa9") for _ in range(draw.randint(2, 120))) for _ in range(500)]
    pieces = [p for p in pieces if p not in model.ranks]
    short = [np.frombuffer(b, dtype="<u4").tolist() for b in model.encode_pieces(pieces)]
    assert short == [model.encode_long(p) for p in pieces]


def test_encoder_works_on_small_parts_and_forgets_units(reference):
    model = bpe.ByteBPE(bpe.merge_tables(RANKS, P.PATTERN) | {"digest": "of this test"})
    rows = [" ".join(f"{k:x}g{i:x}" for k in range(2000)) for i in range(250)]  # 500,000 distinct units in 4 MB
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(rows))), "text": rows})
    some, at = [], 0
    for doc_ids, encoded in bpe._encoded(iter([batch]), model):
        some.append(sum(len(rows[i]) for i in doc_ids.to_pylist()))
        assert encoded[0].tolist() == reference.encode_ordinary(rows[at])
        assert sum(map(len, model.kept.values())) < 400_000
        at += len(encoded)
    assert at == len(rows) and max(some) < 1.1 * (1 << 20)


def test_units_put_together_give_the_text():
    for text in texts():
        assert " ".join(units(text)) == text


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_library_ids_and_lengths(name):
    path = P.path(name)
    library = Library(vocabulary_file(path))
    if name.endswith(".json"):
        expected = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts(), add_special_tokens=False)]
    else:
        import sentencepiece

        expected = sentencepiece.SentencePieceProcessor(model_file=path).encode(texts())
    assert library.lengths(texts()) == list(map(len, expected))
    for dtype in ("<u2", "<u4"):
        flat, counts = UnitIds(vocabulary_file(path), np.dtype(dtype)).encode(pa.array([None, *texts()]).slice(1))
        assert [part.tolist() for part in np.split(flat, np.cumsum(counts)[:-1])] == expected


def test_units_are_forgotten_and_found_again(monkeypatch):
    monkeypatch.setattr(unit_ids, "UNITS", 50)
    library, encoder = Tokenizer.from_file(JSON), UnitIds(vocabulary_file(JSON), np.dtype("<u2"))
    draw = random.Random(9)
    for _ in range(30):
        some = [" ".join("".join(draw.choice("abcé ") for _ in range(draw.randint(0, 7))) for _ in range(draw.randint(0, 30))) for _ in range(9)] + ["", None]
        flat, counts = encoder.encode(pa.array(some, pa.string()))
        assert flat.tolist() == [i for t in some for i in library.encode(t or "", add_special_tokens=False).ids]
        assert counts.sum() == len(flat) and len(counts) == len(some) and not counts[-2:].any()


def test_units_of_bytes_put_together_give_the_text():
    some = [*texts(), "", " a", "a ", "  ", " ", "a　b", "a  b", "é ü", "one.\nTwo", "a\n\nb", "a\n", "\nb", "x,.", "...", "é, ×, 7."]
    column = pa.array(some)
    data, offsets = np.frombuffer(column.buffers()[2], np.uint8), np.frombuffer(column.buffers()[1], np.int32).astype(np.int64)
    start, end, spaced, heads = unit_ids.unit_bounds(data, offsets)
    pieces = [(" " if s else "") + data[a:b].tobytes().decode() for a, b, s in zip(start, end, spaced)]
    assert ["".join(pieces[a:b]) for a, b in zip(heads, [*heads[1:], len(pieces)])] == some
    last = pieces[heads[some.index("one.\nTwo")] : heads[some.index("a\n\nb")]]
    assert last == ["one", ".", "\n", "Two"]


def test_odd_rows_round_trip(odd, none, reference):
    rows = bpe.round_trip(odd, RANKS, P.PATTERN).collect()
    expected = {(r["doc_id"], len(reference.encode_ordinary(r["text"] or "")), hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in odd.collect()}
    assert len(rows) == odd.count() and {(r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in rows} == expected
    assert bpe.round_trip(none, RANKS, P.PATTERN).count() == 0


def test_encode_and_decode_tables(odd):
    encoded = bpe.encode(odd, RANKS, P.PATTERN)
    decoded = bpe.decode(encoded, RANKS, P.PATTERN)
    assert sorted(bytes(r["decoded"]) for r in decoded.collect()) == sorted((r["text"] or "").encode() for r in odd.collect())


def test_odd_rows_counted(odd, none):
    library = Tokenizer.from_file(JSON)
    rows = token_counts.count_tokens(odd, JSON, limit=20).collect()
    expected = sorted((r["doc_id"] or 0, len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in odd.collect())
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in rows) == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 20) for r in rows)
    assert token_counts.count_tokens(none, JSON).count() == 0


def test_token_files(spark, odd, none):
    target = new_shared_path(spark, "test-tokens")
    token_tables.write_tokens(odd, target, JSON)
    rows = token_tables.token_digests(spark, target).collect()
    library, start = Tokenizer.from_file(JSON), 0
    given = sorted(odd.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or ""))
    got = sorted(rows, key=lambda r: r["start"])
    for row, source in zip(got, given, strict=True):
        ids = [*library.encode(source["text"] or "", add_special_tokens=False).ids, 2]
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (source["doc_id"], start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)
    some = token_tables.read_tokens(spark, target, ["doc_id", "n_tokens"], first=3, last=5)
    assert sorted(r["doc_id"] for r in some.collect()) == [3, 4, 5]
    plan = some._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,3)" in plan and "ids" not in plan.split("ReadSchema")[-1]
    empty = new_shared_path(spark, "test-tokens")
    token_tables.write_tokens(none, empty, JSON)
    assert token_tables.token_digests(spark, empty).count() == 0


def test_query_over_the_table(spark, data, reference):
    documents = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    rows = catalog.QUERIES["op7_byte_bpe"](spark, data).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {i: len(reference.encode_ordinary(t)) for i, t in documents.items()}


def whole_table(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    encoded = library.encode_batch([r["text"] or "" for r in rows], add_special_tokens=False)
    return [(r["doc_id"], r["text"] or "", e.ids) for r, e in zip(rows, encoded)]


def test_token_files_query_over_the_whole_table(spark, data):
    expected, start = [], 0
    for doc, _, ids in whole_table(spark, data):
        ids = [*ids, 2]
        expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = catalog.QUERIES["op8_token_files"](spark, data).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, found)) == expected


def test_token_counts_query_over_the_whole_table(spark, data):
    expected = [(doc, len(text.encode()), len(ids), len(ids) > 512) for doc, text, ids in whole_table(spark, data)]
    found = catalog.QUERIES["op10_token_counts"](spark, data).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    assert sorted(map(tuple, found)) == expected


def test_byte_bpe_query_over_the_whole_table(spark, data, reference):
    expected = []
    for doc, text, _ in whole_table(spark, data):
        ids = reference.encode_ordinary(text)
        expected.append((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    found = catalog.QUERIES["op7_byte_bpe"](spark, data).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, found)) == expected
