from __future__ import annotations

import pytest

from llm.invented import prose

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, size int, toxicity string, ids int, copies int, label int, drop int, print string, kept int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, one doc_id for two texts, and clashing columns."""
    more = (1, "x", 2, 3, 4, 5, "y", 6)
    texts = [
        (1, prose(1, 300)), (2, prose(2, 80)), (3, None), (4, ""), (5, " \t\n  "), (6, "word"), (7, "two words"), (8, prose(8, 40_000)), (9, "x" * 30_000),
        (None, prose(10, 90)), (None, None), (11, prose(11, 120)), (11, prose(11, 120)), (12, prose(12, 60)), (12, prose(13, 60)), (14, "é à ü\n漢字 🙂 \x00 a"), (-15, prose(1, 300) + " end"),
    ]
    rows = [(i, t, "en", None if n % 5 == 4 else f"s{n % 3}", len(t or ""), "row", *more[:1], "x", *more[2:6], "y", 6) for n, (i, t) in enumerate(texts)]
    rows.append((None,) * 14)
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
