from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, size int"


@pytest.fixture
def table(spark):
    """Documents from (doc_id, text, source, lang) rows, with columns of clashing names."""

    def make(rows):
        full = [
            (i, text, lang, source, len(text or ""), "own", 7) for i, text, source, lang in rows
        ]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture
def odd(table):
    """Nulls everywhere, empty and long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977} Über" for i in range(60_000))
    return table(
        [
            (1, "The same text.", "a", "en"),
            (2, "the SAME text.", "a", "en"),
            (2, "the SAME text.", "a", "en"),
            (3, None, None, None),
            (4, "", "b", "de"),
            (None, "The same text.", "b", None),
            (None, None, "c", "fr"),
            (5, long, "a", "en"),
            (6, long, None, "en"),
            (7, "  \t\n ", "c", "es"),
            (8, "one", "c", "es"),
            (9, "The Same Tëxt. <|endoftext|> 'll", "c", "es"),
        ]
    )
