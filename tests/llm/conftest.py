from __future__ import annotations

import pytest

LONG = "long text of words " * 20_000


@pytest.fixture
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and clashing further columns."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog today.", "en", "a", 50),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (4, "   \n\t ", "de", "b", 6),
        (5, LONG, "en", "a", len(LONG)),
        (6, "The quick brown fox jumps over the lazy dog today.", "fr", None, 50),
        (7, "word", None, "c", 4),
        (None, "no id here at all", "en", None, None),
        (8, "Grüße aus Köln 😀 é", "de", "b", 19),
        (8, "Grüße aus Köln 😀 é", "de", "b", 19),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame([(*r, "x", -1.0, "y", 0) for r in rows], schema + ", `_bucket` string, score double, block string, component_id int")
    return docs.repartition(3)


@pytest.fixture
def no_documents(odd_documents):
    return odd_documents.limit(0)
