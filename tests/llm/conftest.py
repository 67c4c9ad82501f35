from __future__ import annotations

import pytest

LONG = " ".join(f"word{i % 977} other{i % 31}" for i in range(20_000))
PASSAGE = " ".join(f"passage{i}" for i in range(80))
DOCUMENTS = (
    "doc_id long, text string, lang string, source string, n_chars long, k1 string, found int, size string, "
    "key int, head string, row int, target string, n int, words string, component string"
)


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty, long and repeated texts, ties, repeated rows and clashing columns."""
    texts = [
        (1, "Licensed under the Apache License, Version 2.0.", "a"), (2, None, "a"), (3, "", None), (4, " \n\t ", "b"),
        (5, LONG, "b"), (5, LONG, "b"), (6, LONG + " tail", "b"), (None, "no id " * 30, "b"), (None, None, None),
        (7, "one two three", "c"), (8, "ONE two  three", "c"), (9, PASSAGE + " end", "c"), (10, "start " + PASSAGE, None),
        (10, "same id, other text", "a"), (11, "\u00e9t\u00e9 \u4f60\u597d CC BY Gnu General Public License gnu general public license", "a"),
        (12, "a" * 500, "a"), (13, "b " * 300, "a"),
    ]
    rows = [(d, t, "en", s, len(t or ""), "x", 1, "y", 2, "z", 3, "t", 4, "w", "c") for d, t, s in texts]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
