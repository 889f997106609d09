from __future__ import annotations

import pytest

AWKWARD = [None, "", "   \n", "one", "one two", "ONE two", "a b c d e f", "A b C d e f", "a b c d e f", "ß É é ñ 漢字 🙂", "word " * 3000]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names clash with our own."""
    rows = [(i, text, "src" if i % 3 else None, i, "x", b"", 1) for i, text in enumerate(AWKWARD)]
    rows += [rows[4], rows[4], (None, "a b c d e f", None, None, None, None, None)]
    schema = "doc_id long, text string, source string, key long, ids string, decoded binary, part int"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")
