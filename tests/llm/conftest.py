from __future__ import annotations

import pytest

# Columns a table may bring along, named as the operators name theirs.
EXTRA = ("n_words", "kept", "size", "copies", "component_id", "fp", "row", "content", "line", "target", "score",
         "key", "chunk", "site", "total", "digest", "prefix", "source_size", "n_lines", "place", "record", "ids")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text, source) with extra columns of clashing names."""

    def build(*rows):
        full = [(d, t, None, s, None) + ("extra",) * len(EXTRA) for d, t, s in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture
def edges(docs):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    long_text = " ".join(f"word{i % 977} the of" for i in range(60_000))
    return docs((1, "one two three four", "a"), (2, None, "a"), (3, "", None), (None, "one two three four", None),
                (5, long_text, "b"), (5, long_text, "b"), (6, " \t\n ", "a"), (7, "the the\nthe the\n\nx", "b"),
                (8, "é ß 日本 \x00 <|endoftext|>", "a"), (None, None, None), (5, "other text", "b"))
