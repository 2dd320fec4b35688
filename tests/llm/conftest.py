"""Inputs shared by the tests of the corpus operators."""

from __future__ import annotations

import pytest

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents out of ``(doc_id, text)`` or full rows."""

    def build(*rows):
        full = [r if len(r) == 5 else (*r, "en", "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return build


@pytest.fixture
def odd_documents(documents):
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    return documents(
        (1, None),
        (2, ""),
        (3, "one two three four five six seven"),
        (3, "one two three four five six seven"),
        (4, "one two three four five six seven"),
        (5, "word " * 20_000),
        (None, "lost and found", None, None, None),
        (6, "tab\tand\nline é ü \U0001f600", None, "src1", 3),
    )


@pytest.fixture
def large_ids(documents):
    """Ids that no floating-point number holds, beside a null one."""
    texts = ["alpha beta gamma delta epsilon zeta", None, "token = abcdef123456 one two three four"]
    rows = [(2**53 + 1, texts[0]), (None, texts[0]), (2**53 + 3, texts[1]), (2**53 + 5, texts[2])]
    return documents(*rows).coalesce(1)
