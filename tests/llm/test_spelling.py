"""Spelling variants against plain code: counts by hand, near words by single edits, and by the full edit matrix."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.llm import spelling
from statloom.llm.catalog import QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    words = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            words[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def neighbours(words):
    """Near words by what is left when one letter goes."""
    holes = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :]), []).append(w)
    near = {w: set() for w in words}
    for same in holes.values():
        for a in same:
            near[a].update(b for b in same if b != a)
    for w in words:
        for i in range(len(w)):
            cut = w[:i] + w[i + 1 :]
            if cut in near:
                near[w].add(cut)
                near[cut].add(w)
    return near


def expected(words):
    near, out = neighbours(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        out[w] = {"word": w, "form": form, "n": n, "n_near": len(near[w]), "form_n": words[form] if form else None}
    for w in out:
        root = w
        while out[root]["form"]:
            root = out[root]["form"]
        out[w]["root"] = root
    return out


def check(found, words):
    found = [r.asDict() for r in found.collect()]
    assert len(found) == len(words)
    assert {r["word"]: r for r in found} == expected(words)


def vocabulary(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


def test_query_over_the_whole_table(spark, data):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    words = counted(rows)
    assert len(words) > 1000
    check(QUERIES["op11_spelling_variants"](spark, data), words)


def test_nulls_long_runs_capitals_and_clashing_columns(spark):
    rows = [(None, "Thing thing THING Étude étude Étude"), (1, None), (2, ""), (3, "thong " * 3 + "things " * 9), (4, "Kelvin İstanbul " * 4)]
    rows += [(i, "x" * 5000 + " " + "x" * 4999 + "y") for i in range(5, 9)] + [(9, "thing×thing ÷÷÷÷÷ " * 3)] * 2
    df = spark.createDataFrame([(*r, "w", 1, 2) for r in rows], "doc_id long, text string, word string, n int, id int")
    for parts in (1, 5):
        words = spelling.vocabulary(spelling.runs_of(df.repartition(parts), 97))
        check(spelling.spelling_groups(words), counted(rows))


def test_empty_vocabulary(spark, none):
    words = spelling.vocabulary(spelling.runs_of(none, 97))
    assert spelling.spelling_groups(words).collect() == []


@pytest.mark.parametrize("limit", [2, 20, 10_000])
def test_lists_are_halved_without_loss(spark, limit):
    """A third of the words share a long beginning, and many lists must be dealt again."""
    rng = random.Random(limit)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(5, 7))): rng.randint(3, 90) for _ in range(500)}
    words |= {"overlongbeginning" + "".join(rng.choice("abü") for _ in range(rng.randint(0, 5))): rng.randint(3, 90) for _ in range(250)}
    check(spelling.spelling_groups(vocabulary(spark, words), limit=limit), words)


def test_chains_and_ties(spark):
    words = {"abcde": 3, "abcdf": 6, "abcdg": 6, "abcxg": 12, "abyxg": 24, "azyxg": 48, "qzyxg": 96, "qzyxgh": 192, "lonely": 5}
    check(spelling.spelling_groups(vocabulary(spark, words)), words)


def test_pairs_equal_the_full_matrix():
    rng = np.random.default_rng(3)
    words = sorted({"".join(rng.choice(list("abÿ"), rng.integers(1, 7))) for _ in range(300)})
    sizes = np.array([len(w) for w in words])
    width = int(sizes.max()) + 2
    codes = np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(len(words), width)
    a, b = spelling.near_pairs(codes, sizes, np.zeros(len(words), int))
    assert sorted(zip(a.tolist(), b.tolist())) == [(i, j) for i in range(len(words)) for j in range(len(words)) if distance(words[i], words[j]) == 1]
