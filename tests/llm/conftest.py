from __future__ import annotations

import pytest

LONG = "lorem ipsum dolor " * 4000


@pytest.fixture(scope="session")
def odd(spark):
    """Missing ids and texts, empty, blank and very long texts, repeated rows, and columns whose names the operators use."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog near the river bank today"),
        (2, "the quick brown fox jumps over the lazy dog near the river bank today"),
        (2, "the quick brown fox jumps over the lazy dog near the river bank today"),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (6, LONG),
        (7, "x" * 50_000),
        (None, "the quick brown fox jumps over the lazy dog near the river bank today"),
        (None, None),
        (8, "token = abcdef0123456789abcdef0123456789 and more ÄÖ 東京 😀"),
    ]
    schema = "doc_id long, text string, score string, node int, component_id string, label string, part int, lang string, source string, n_chars long"
    return spark.createDataFrame([(i, t, "s", 0, "c", "l", 9, "en", "src", len(t or "")) for i, t in rows], schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
