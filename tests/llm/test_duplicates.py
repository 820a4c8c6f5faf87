"""Near-duplicate operators against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from statloom.llm import catalog, minhash, pivots
from statloom.llm.components import components
from statloom.llm.shingles import WordHashes, shingle_set


def smallest(ids, linked) -> dict:
    """Smallest id that each id reaches."""
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def by_pairs(documents: dict, words: int) -> dict:
    sets = {i: frozenset(shingle_set(t or "", words, WordHashes()).tolist()) for i, t in documents.items()}
    ids = sorted(sets)
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return smallest(ids, linked)


def test_components(spark):
    draw = random.Random(2)
    links = [(draw.randint(0, 400), draw.randint(0, 400)) for _ in range(300)] + [(i, i + 1) for i in range(500, 700)] + [(7, None), (900, 900)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    whole = [(a, b) for a, b in links if b is not None and a != b]
    expected = smallest({x for p in whole for x in p}, whole)
    assert {r["node"]: r["component"] for r in rows if r["node"] != r["component"]} == {k: v for k, v in expected.items() if k != v}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    chain = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(7, 7), (None, 3)]
    dealt = spark.createDataFrame(chain, "a long, b long").repartition(17)
    found = {r["node"]: r["component"] for r in components(dealt).collect()}
    assert found == {i: 0 for i in range(1, 301)} | {i: 1000 for i in range(1001, 1200)}


def test_components_over_many_full_tasks(spark, monkeypatch):
    monkeypatch.setattr("statloom.llm.components.LINKS", 20)  # of the dealing alone: 15 tasks and several turns
    chain = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)]
    dealt = spark.createDataFrame(chain, "a long, b long").repartition(17)
    found = {r["node"]: r["component"] for r in components(dealt).collect()}
    assert found == {i: 0 for i in range(1, 301)} | {i: 1000 for i in range(1001, 1200)}


def test_shingles_by_the_stated_rule():
    def count(text, words):
        return len(shingle_set(text, words, WordHashes()))

    assert count("A b\x0ba B", 2) == 2 and count("a", 2) == 1 and count(" \t\n", 2) == 0 and count("", 5) == 0
    assert (shingle_set("É a", 2, WordHashes()) != shingle_set("é a", 2, WordHashes())).all()  # only A-Z change
    assert count("a\xa0b c", 2) == 1


@pytest.mark.parametrize("words", [2, 5])
def test_documents_against_all_pairs(spark, words):
    draw = random.Random(words)
    vocabulary = [f"w{i}" for i in range(400)]
    documents, number = {}, 0
    for _ in range(12):
        base = [draw.choice(vocabulary) for _ in range(draw.randint(5, 120))]
        for _ in range(draw.randint(1, 14)):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 8))):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            documents[number] = " ".join(copy)
            number += 1
    rows = minhash.near_duplicates(spark.createDataFrame(list(documents.items()), "doc_id long, text string"), words=words).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == by_pairs(documents, words)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_outsiders_of_a_crowded_group(spark):
    """3,000 near copies of each other, and texts whose only link is one to a single copy."""
    draw = random.Random(5)
    base = [f"b{i}" for i in range(97)]
    copies = [base + [f"u{i}x{k}" for k in range(3)] for i in range(3000)]
    outsiders = []
    for i in range(0, 3000, 150):
        gone = set(draw.sample(base, 10))
        outsiders.append([w for w in copies[i] if w not in gone] + [f"o{i}x{k}" for k in range(12)])
    for i, o in enumerate(outsiders):
        near = [k for k, c in enumerate(copies) if 100 * len(set(o) & set(c)) >= 80 * len(set(o) | set(c))]
        assert near == [150 * i]
    rows = [(i, " ".join(t)) for i, t in enumerate(copies + outsiders)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=1).collect()
    assert {r["component_id"] for r in found} == {0}


def test_cells_hold_every_pair_of_different_groups(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CELL", 7)
    draw = random.Random(6)
    group = {i: draw.choice([0, 0, 0, 1, 2, 30 + i]) for i in range(60)}
    signature = bytes(2 * minhash.VALUES)
    rows = [(bytes([i]), bytes([g]), signature, bytes(minhash.VALUES // 2), 9) for i, g in group.items()]
    dealt = minhash.cells(spark.createDataFrame(rows, "node binary, group binary, signature binary, few binary, length long"), ["node", "group", "few", "length"])
    frame = pa.Table.from_pandas(dealt.toPandas().sort_values("cell"), preserve_index=False).to_batches()[0]
    node = frame.column("node").to_pylist()
    found = [frozenset((node[a][0], node[b][0])) for i, j, *_ in minhash._hits(frame, 0.8) for a, b in zip(i, j)]
    expected = {frozenset((a, b)) for a in group for b in group if group[a] != group[b]}
    assert set(found) == expected and len(found) == minhash.ORDERS * len(expected)


def test_pairs_belong_to_the_order_of_their_longest_prefix():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 2, (40, minhash.VALUES)).astype(np.uint16)
    a, b = np.triu_indices(40, 1)
    shared = minhash.prefixes(values, a, b)
    for k in range(0, len(a), 37):
        for t in range(minhash.ORDERS):
            n = 0
            while n < minhash.DEPTH and values[a[k], (t * minhash.STEP + n) % minhash.VALUES] == values[b[k], (t * minhash.STEP + n) % minhash.VALUES]:
                n += 1
            assert shared[k, t] == n


def test_texts_of_one_template_make_no_pairs(spark):
    """Many texts of similarity 0.75 to each other: all are candidates, none are linked, and a true copy among them is found."""
    base = [f"b{i}" for i in range(120)]
    texts = [base + [f"u{i}x{k}" for k in range(20)] for i in range(400)]
    texts += [texts[7][:-4] + ["z"] * 1]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=1).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: 7 if i == 400 else i for i in range(401)}


def test_repeated_ids_are_kept_row_by_row(spark):
    draw = random.Random(8)
    one, two, three, four = (" ".join(f"{k}w{draw.randrange(10**6)}" for _ in range(60)) for k in "abcd")
    rows = [(1, one, 0), (2, one + " x", 1), (2, two, 2), (3, three, 3), (3, three, 4), (3, three + " x", 5), (4, four, 6), (4, "", 7), (4, None, 8), (4, "", 9), (None, one, 10), (5, four.upper(), 11)]
    found = minhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string, row int")).collect()
    kept = {r["row"] for r in found}
    assert len(found) == len(kept) and kept - {3, 4, 5} == {0, 2, 6, 7, 8, 9, 10} and len(kept & {3, 4, 5}) == 1


def test_query_over_the_table(spark, data):
    documents = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    rows = catalog.QUERIES["op5_minhash_forest"](spark, data).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == by_pairs(documents, 2)


def test_odd_documents(odd, none):
    rows = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(odd).collect())
    kept = {(i, c, k) for i, _, c, k in rows}
    assert len(rows) == odd.count()
    assert {("1", 1, True), ("2", 1, False), ("3", 3, True), ("4", 4, True), ("5", 5, True), ("None", None, True)} <= kept
    assert sorted(r["doc_id"] or 0 for r in minhash.keep_first(odd).collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 8]
    assert minhash.keep_first(odd).columns == odd.columns
    assert minhash.near_duplicates(none).count() == 0


def test_vectors_against_all_pairs(spark):
    draw = np.random.default_rng(3)
    rows, number = [], 0
    for label in (0, 1):
        for _ in range(25):
            base = draw.normal(size=16)
            for _ in range(int(draw.integers(1, 8))):
                rows.append((number, [float(v) for v in (base + draw.normal(size=16) * 0.2).astype(np.float32)], label))
                number += 1
    rows += [(number, rows[0][1], 0), (number + 1, rows[0][1], 1), (number + 2, rows[0][1], None), (number + 3, None, 0), (number + 4, [0.0] * 16, 0)]
    rows += [(number + 5, [float("nan")] * 16, 0), (number + 6, [None] * 16, 0), (number + 7, [1.0], 0), (number + 8, [float("inf")] * 16, 1), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = {r["vec_id"]: r for r in pivots.near_vectors(df, pivots=32, nearest=8, shared=1).collect()}
    valid = [(i, np.array(v) / np.linalg.norm(v), k) for i, v, k in rows if i is not None and k is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    linked = [(a[0], b[0]) for n, a in enumerate(valid) for b in valid[n + 1 :] if a[2] == b[2] and a[1] @ b[1] >= 0.93]
    found = sum(out[i]["n_links"] for i in out) / 2
    assert 0.97 * len(linked) <= found <= len(linked)
    root = smallest([r[0] for r in rows if r[0] is not None], linked)
    assert np.mean([out[i]["component_id"] == c for i, c in root.items()]) > 0.97
    assert (out[None]["n_links"], out[None]["component_id"], out[None]["kept"]) == (0, None, True)
    assert pivots.near_vectors(df.where("false")).count() == 0


def test_vector_recall_over_the_table(spark, data):
    rows = spark.read.parquet(f"{data}/embeddings.parquet").collect()
    out = {r["vec_id"]: r["n_links"] for r in catalog.QUERIES["op9_pivot_index"](spark, data).collect()}
    x = np.array([r["embedding"] for r in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([r["label"] for r in rows])
    links = ((x @ x.T >= 0.93) & (label[:, None] == label)).sum(1) - 1
    assert len(out) == len(rows) and sum(out.values()) >= 0.9 * links.sum()
    assert all(out[r["vec_id"]] <= n for r, n in zip(rows, links))
