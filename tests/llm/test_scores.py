"""Classifiers by held-out accuracy, scans and decontamination against plain versions, and the pipeline."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from statloom.llm import catalog, decontamination, language, quality, secret_scan, toxicity
from statloom.llm.labelled import calibrated, fit_isotonic, fit_isotonic_table

TABLE = "/root/testdata/sf0.01"


def ranked(labels, scores) -> float:
    """Share of (1, 0) pairs in the right order."""
    one, zero = scores[labels == 1], scores[labels == 0]
    return float(((one[:, None] > zero) + 0.5 * (one[:, None] == zero)).mean())


@pytest.mark.parametrize(("name", "label", "least"), [("op1_toxicity", "toxic", 0.85), ("op2_quality", "quality", 0.95)])
def test_held_out_order(spark, name, label, least):
    scored = catalog.QUERIES[name](spark, TABLE).toPandas()
    known = scored.merge(spark.read.parquet(f"{TABLE}/labels.parquet").toPandas(), on="doc_id")
    aside = known[known["held_out"]]
    assert len(scored) == spark.read.parquet(f"{TABLE}/documents.parquet").count() and scored["score"].between(0, 1).all()
    assert ranked(aside[label].to_numpy(), aside["score"].to_numpy()) > least


def test_held_out_languages(spark):
    found = catalog.QUERIES["op6_language"](spark, TABLE).toPandas()
    both = found.merge(spark.read.parquet(f"{TABLE}/documents.parquet").select("doc_id", "lang").toPandas(), on="doc_id")
    assert (both["lang"] == both["lang_pred"])[both["held_out"]].mean() > 0.97


def test_segmentations_are_all_summed():
    lattice = language.Lattice(["▁", "a", "b", "ab", "▁a", "▁ab", "ba"])
    p = np.vstack([np.random.default_rng(1).uniform(0.01, 0.2, (7, 2)), np.full((1, 2), 1e-7)])

    def total(word):
        return np.ones(2) if not word else sum(p[lattice.index[word[:n]]] * total(word[n:]) for n in range(1, len(word) + 1) if word[:n] in lattice.index)

    words = ["a", "ab", "abba", "bab", "abab"]
    expected = np.log([total("▁" + w) for w in words])
    assert np.allclose(lattice.log_probabilities(words, p), expected)
    q = p[:, [0]]
    counts = lattice.expected(["abba"], np.array([1.0]), np.array([0]), q)
    assert np.isclose(sum(n * len(w) for w, n in zip(lattice.index, counts[:, 0])), 5)  # each character is in one piece


def test_lattice_sums_words_of_any_length():
    """Forward sums and expected counts against the plain recursions in log space."""
    lattice = language.Lattice(["▁", "a", "b", "ab", "▁a", "bab", "ba", "aaaa"])
    p = np.vstack([np.random.default_rng(1).uniform(1e-9, 1e-3, (8, 2)), np.full((1, 2), 1e-7)])
    draw = random.Random(2)
    words = ["".join(draw.choice("abz") for _ in range(n)) for n in (*range(1, 61), 100, 199, 200)] + ["界" * n for n in (38, 40, 41)]

    def arcs(text):
        for start in range(len(text)):
            for size in range(1, min(4, len(text) - start) + 1):
                piece = lattice.index.get(text[start : start + size], -1)
                if piece >= 0 or size == 1:
                    yield start, start + size, piece

    found = lattice.log_probabilities(words, p)
    for number, word in enumerate(words):
        text = "▁" + word
        ahead, back = np.full((len(text) + 1, 2), -np.inf), np.full((len(text) + 1, 2), -np.inf)
        ahead[0] = back[-1] = 0.0
        for s, e, q in arcs(text):
            ahead[e] = np.logaddexp(ahead[e], ahead[s] + np.log(p[q]))
        for s, e, q in reversed(list(arcs(text))):
            back[s] = np.logaddexp(back[s], back[e] + np.log(p[q]))
        assert np.allclose(found[number], ahead[-1], rtol=1e-12)
        counts = np.zeros_like(p)
        for s, e, q in arcs(text):
            if q >= 0:
                counts[q] += np.exp(ahead[s] + np.log(p[q]) + back[e] - ahead[-1])
        for lang in (0, 1):
            learned = lattice.expected([word], np.array([1.0]), np.array([lang]), p)
            assert np.allclose(learned[:, lang], counts[:, lang], atol=1e-9) and not learned[:, 1 - lang].any()


def test_isotonic_rises():
    draw = np.random.default_rng(2)
    raw = draw.normal(size=500)
    knots = fit_isotonic(raw, (draw.uniform(size=500) < 1 / (1 + np.exp(-2 * raw))).astype(float))
    values = calibrated(np.sort(raw), knots)
    assert (np.diff(values) >= 0).all() and 0 <= values[0] < 0.3 and 0.7 < values[-1] <= 1


def test_dual_coordinate_descent_separates():
    draw = np.random.default_rng(3)
    y = draw.choice([-1, 1], 200)
    x = [(np.array([5 if s > 0 else 9, 20]), np.array([1.0, 0.1])) for s in y]
    w = quality.dual_coordinate_descent(x, y, 1.0, 10)
    assert all((w[at] @ v + w[-1]) * s > 0 for (at, v), s in zip(x, y))


def test_odd_rows_are_scored(odd, none):
    labels = odd.sparkSession.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 1), (None, 1, 1), (8, None, 0)], "doc_id long, quality int, toxic int")
    for module, label in ((toxicity, "toxic"), (quality, "quality")):
        model = module.fit(odd, labels, label)
        rows = module.score(odd, model).collect()
        assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert module.score(none, module.fit(none, labels.where("false"), label)).count() == 0
    assert toxicity.keep_clean(odd, toxicity.fit(odd, labels)).columns == odd.columns
    model = language.fit(odd, P.path("piece_bpe_32k.model"))
    rows = language.predict(odd, model).collect()
    assert len(rows) == odd.count() and sum(r["lang_pred"] == "und" for r in rows) == 4
    assert language.predict(none, language.fit(none, P.path("piece_bpe_32k.model"))).count() == 0


def edits(item: str, text: str) -> int:
    before = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        now = [i + 1]
        for j, b in enumerate(text):
            now.append(min(before[j] + (a != b), before[j + 1] + 1, now[j] + 1))
        before = now
    return min(before)


def test_leaks_against_the_edit_matrix(spark, odd, none):
    draw = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa"]
    items = [(i, " ".join(draw.choice(words) for _ in range(12))) for i in range(6)] + [(90, None), (None, "beta beta beta"), (91, "...")]
    documents = []
    for n in range(60):
        text = list(draw.choice(items[:6])[1])
        for _ in range(draw.randint(0, 9)):
            at = draw.randrange(len(text))
            text[at : at + 1] = draw.choice([[], ["z"], [text[at], "q"]])
        documents.append((n, "Before, " + "".join(text).upper() + " -- after"))
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontamination.leaks(docs, benchmark, block_chars=150).collect()}
    expected = {}
    for n, text in documents:
        for i, item in items[:6]:
            least = edits(decontamination.normal(item), decontamination.normal(text))
            if least <= decontamination.budget(decontamination.normal(item), decontamination.ERROR_RATE):
                expected[n, i] = least
    assert found == expected and found
    kept = decontamination.keep_clean(docs, benchmark).collect()
    assert {r["doc_id"] for r in kept} == {n for n, _ in documents} - {n for n, _ in expected}
    assert decontamination.leaks(odd, benchmark).count() == 0 and decontamination.keep_clean(odd, benchmark).count() == odd.count()
    assert decontamination.leaks(none, benchmark.where("false")).count() == 0


def plain_spans(text: str) -> list:
    letters = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
    names = "|".join(map(letters, ("password", "passwd", "secret", "token"))) + "|" + letters("api") + "_?" + letters("key")
    rules = [("assign", rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+")]
    least = {"access": 20, "hex": 24}
    out = [(m.start(), k, m.end()) for k, (kind, rule) in enumerate(rules) for m in re.finditer(rule, text) if (len(m[2]) >= 6 if kind == "assign" else len(m[0]) >= least[kind])]
    return [f"{rules[k][0]}:{a}:{b}" for a, k, b in sorted(out)]


def test_base_spans_against_plain_patterns(spark, odd, none):
    draw = random.Random(6)
    parts = ["token", "Token=", "PASSWD : '", "api_key", "ApiKey=\"", " ", "=", ":", "abcdef", "0123456789abcdef" * 2, "AKIA" + "A1B2C3D4" * 2, "AKIA12", "Key", "ſecret=abcdefg", "é", "\n", "x1y2z3"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 12))) for _ in range(3000)]
    for text in texts:
        assert [f"{k}:{a}:{b}" for a, b, k in secret_scan.base_spans(text)] == plain_spans(text)
    documents = spark.read.parquet(f"{TABLE}/documents.parquet")
    model = secret_scan.fit(documents)
    rows = secret_scan.scan(odd, model).collect()
    assert len(rows) == odd.count() and sum(r["n_assign"] for r in rows) == 1 and sum(r["n_hex"] for r in rows) == 1
    assert sum(r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in rows) == odd.count() - 1
    redacted = secret_scan.redact(odd, model)
    assert redacted.columns == odd.columns and "[SECRET] and more" in redacted.where("doc_id = 8").first()["text"]
    assert secret_scan.scan(none, secret_scan.fit(none)).count() == 0
    formats = secret_scan.public_formats(60, seed=77)
    x = np.array([next(secret_scan.windows(f"see {r} and", 4, 4 + len(r))) for r, _ in formats])
    p, y = calibrated(model["network"].scores(x), model["knots"]) >= model["threshold"], np.array([v for _, v in formats])
    assert p[y == 1].mean() > 0.85 and p[y == 0].mean() < 0.05


def test_keys_in_documents_that_the_fit_sees(spark):
    keys = [r for r, y in secret_scan.public_formats(500, seed=91) if y and r.startswith(("ghp_", "sk_live_", "eyJ"))]
    planted = spark.createDataFrame([(10_000_000 + i, f"see {k} and more") for i, k in enumerate(keys)], "doc_id long, text string")
    model = secret_scan.fit(spark.read.parquet(f"{TABLE}/documents.parquet").select("doc_id", "text").unionByName(planted))
    found = {r["doc_id"]: r["spans"] for r in secret_scan.scan(planted, model).collect()}
    for start in ("ghp_", "sk_live_", "eyJ"):
        hit = [f"network:4:{4 + len(k)}" in found[10_000_000 + i] for i, k in enumerate(keys) if k.startswith(start)]
        assert np.mean(hit) > 0.9, start


def test_only_everyday_runs_are_harmless():
    formats = secret_scan.public_formats(200, seed=92)
    assert not any(secret_scan.everyday(r) for r, y in formats if y) and np.mean([secret_scan.everyday(r) for r, y in formats if not y]) > 0.95


def test_rest_of_a_run_beside_a_base_span(spark):
    access, hexes, key = "AKIA" + "IOSFODNN7EXAMPLE", "0123456789abcdef" * 2, "wJalrXUtnFEMIK7MDENGbPxRfiCY"
    texts = [f"see {access}/{key} and", f"see {hexes}-{key} and", f"see {key}/token={key}x and", f"see {key}-{hexes}-{key} and", f"see {hexes}/short1 and"]
    found = [[t[a:b] for a, b in secret_scan.candidates(t, secret_scan.base_spans(t))] for t in texts]
    assert found == [[key], [key], [key], [key, key], []]
    model = secret_scan.fit(spark.read.parquet(f"{TABLE}/documents.parquet"))
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert not any(key in r["text"] for r in secret_scan.redact(rows, model).collect())


def test_candidates_against_plain_search():
    draw = random.Random(9)
    parts = ["AKIA" + "A1B2C3D4" * 3, "0123456789abcdef" * 2, "token=", "wJalrXUtnFEMIK7MDENG", "abc", "12", "/", "-", ".", "=", " ", "_", "é"]
    for _ in range(2000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 10)))
        taken = secret_scan.base_spans(text)
        masked = "".join(" " if any(a <= i < b for a, b, _ in taken) else c for i, c in enumerate(text))
        # a rest of fewer than 16 characters may be part of a run of 16 or more, so all rests are looked at
        expected = []
        for m in re.finditer(r"[A-Za-z0-9+/_.=-]+", masked):
            start, end = m.start() + len(m[0]) - len(m[0].lstrip("=.-/")), m.start() + len(m[0].rstrip(".-/"))
            run = masked[start:end]
            if end - start >= 16 and re.search("[0-9]", run) and re.search("[A-Za-z]", run):
                expected.append((start, end))
        assert secret_scan.candidates(text, taken) == expected


def test_network_gradient():
    network = secret_scan.Network(seed=5, size=3, filters=4)
    draw = np.random.default_rng(6)
    x, y = draw.integers(32, 127, (4, secret_scan.WIDTH)), np.array([0.0, 1.0, 1.0, 0.0])

    def loss():
        raw = network.forward(x)[0]
        return float(np.mean(np.logaddexp(0, raw) - y * raw))

    found = network.gradient(x, y)
    for name, at in (("last", (2,)), ("filters", (3, 1)), ("shift", (2,)), ("embedding", (x[0, 20], 1)), ("bias", (0,))):
        part, step = network.parts[name], 1e-6
        part[at] += step
        high = loss()
        part[at] -= 2 * step
        low = loss()
        part[at] += step
        assert np.isclose(found[name][at], (high - low) / (2 * step), atol=1e-6)


def test_findings_beyond_3000_documents_count(spark):
    """Only documents that a sample of 3,000 by the hash of the id would leave out hold findings."""
    ids = spark.range(3400).select(F.col("id").alias("doc_id")).orderBy(F.xxhash64("doc_id", F.lit(4)), "doc_id").collect()
    texts = [(r["doc_id"], f"case {i}: token={i:024x} and more" if i >= 3000 else "nothing here") for i, r in enumerate(ids)]
    documents = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    with_findings, without = secret_scan.fit(documents), secret_scan.fit(documents.where("text = 'nothing here'"))
    assert np.abs(with_findings["network"].parts["filters"] - without["network"].parts["filters"]).max() > 0.01
    assert sorted((r["run"], r["label"]) for r in secret_scan.findings_of(documents).collect()) == [(f"{i:024x}", 1) for i in range(3000, 3400)]


def test_fit_over_parts_against_plain_averages(spark, monkeypatch):
    draw = random.Random(8)
    texts = [(i, f"{draw.choice(['token=', 'see '])}{draw.randbytes(14).hex()} and {draw.choice(['a', 'b'])}-report-{draw.randrange(2000)}-of-2024 {i}") for i in range(300)]
    documents = spark.createDataFrame(texts, "doc_id long, text string")
    n = secret_scan.findings_of(documents).count()
    monkeypatch.setattr(secret_scan, "PART", -(-n // 3))
    model = secret_scan.fit(documents)
    rows = secret_scan.examples(secret_scan.findings_of(documents), 3, 4).orderBy("part").collect()
    parts = [[np.frombuffer(r[c], dtype=np.uint8) for c in ("x", "y", "aside")] for r in rows]
    assert sum(len(y) for _, y, _ in parts) == 3 * n + sum(len(secret_scan.public_formats(150, seed=3 + 10 * p)) for p in range(3))
    parts = [(x.reshape(-1, secret_scan.WIDTH), y.astype(float), out > 0) for x, y, out in parts]
    network = secret_scan.Network()
    zeros = {k: np.zeros_like(v) for k, v in network.parts.items()}
    state, step, randoms = network.packed([zeros, zeros]), 0, [np.random.default_rng(2 + 10 * p) for p in range(3)]
    for _ in range(8):
        ends, total, size = [], 0, 0
        for (x, y, out), order in zip(parts, randoms):
            local = secret_scan.Network()
            moments = local.unpacked(state)
            ends.append(local.walk(x[~out], y[~out], moments, step, order.permutation((~out).sum())))
            total, size = total + (~out).sum() * local.packed(moments), size + (~out).sum()
        state, step = total / size, max(ends)
    network.unpacked(state)
    assert all(np.allclose(v, network.parts[k], atol=1e-9) for k, v in model["network"].parts.items())
    raw = np.concatenate([model["network"].scores(x[out]) for x, _, out in parts])
    label = np.concatenate([y[out] for _, y, out in parts])
    knots = fit_isotonic(raw, label)
    assert all(np.allclose(a, b) for a, b in zip(model["knots"], knots))
    assert np.isclose(model["threshold"], np.quantile(calibrated(raw, knots)[label > 0], 0.05, method="lower"))


def test_isotonic_over_ranges(spark):
    draw = np.random.default_rng(3)
    raw = np.round(draw.normal(0, 2, 3000), 2)
    label = (draw.random(3000) < 1 / (1 + np.exp(-raw))).astype(int)
    table = spark.createDataFrame(list(zip(raw.tolist(), label.tolist())), "raw double, label int")
    for some, expected in ((table, fit_isotonic(raw, label)), (table.where("false"), fit_isotonic(np.zeros(0), np.zeros(0)))):
        for parts in (1, 5):
            found = fit_isotonic_table(some, "raw", "label", parts)
            assert len(found[0]) == len(expected[0]) and all(np.allclose(a, b) for a, b in zip(found, expected))


def test_pipeline(spark, odd):
    documents = spark.read.parquet(f"{TABLE}/documents.parquet")
    sizes, docs = [], documents.where("doc_id < 300")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, before, TABLE).persist()
        assert docs.columns == documents.columns
        sizes.append((name, before.count(), docs.count()))
    assert all(0 < after <= before for _, before, after in sizes) and sizes[3][1] == sizes[3][2]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, TABLE).count() == docs.count()
