from __future__ import annotations

import pytest

#: Names that the operators use inside, as extra columns of another type.
CLASHING = "id string, row string, key string, digest string, node string, text_hash string, range string, taken string, epoch string"


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, source), with extra columns of clashing names."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or ""), *["x"] * 9) for r in rows]
        schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
        return spark.createDataFrame(full, schema)

    return make


ODD = [
    (1, ""),
    (2, None),
    (3, " \t\n"),
    (None, "one two three"),
    (None, None),
    (4, "one two three"),
    (4, "one two three"),
    (5, "one  two\nthree "),
    (6, "solo"),
    (7, "solo"),
    (8, "Über äöü 漢字 🙂 end"),
    (9, "x" * 5000),
    (10, "word " * 3000),
]


@pytest.fixture
def odd(documents):
    """Nulls, empty and long texts, ties and repeated rows."""
    return documents(ODD)
