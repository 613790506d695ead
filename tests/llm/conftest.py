from __future__ import annotations

import pytest

from salesloom.llm import common

CLASHING = (
    "n_words", "spans", "items", "base", "added", "digest", "block", "key", "stretch", "extra",
    "slot", "shard", "signatures", "held_out", "number", "found", "blob", "bucket", "fold",
)
PROSE = "the quick brown fox jumps over the lazy dog and runs into the dark wood before night falls"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    common.ship(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of documents from (doc_id, text) or (doc_id, text, lang) tuples."""

    def make(rows, clash=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
        if clash:
            df = df.selectExpr("*", *[f"'x' AS {c}" for c in CLASHING])
        return df

    return make


EDGE_ROWS = [
    (1, None, None), (2, "", "en"), (3, " \t\n ", "en"), (4, "x", None), (5, "12 34 !!", "de"),
    (6, PROSE, "en"), (6, PROSE, "en"), (7, PROSE, "en"), (8, PROSE + " again", "en"),
    (None, PROSE, "en"), (None, None, None), (9, "é ß ñ \U0001f600 日本語 mail a.b@c.de", "fr"),
    (10, "word " * 30_000, "en"), (11, "ab" * 60_000, "en"), (12, PROSE.upper() + "!", "en"),
    (13, "a\x00b \x1f c d", "en"), (6, "another text of id six", "en"),
]


@pytest.fixture(scope="session")
def edge(documents):
    """Nulls, empty and long texts, copies, repeated rows and ids, clashing columns."""
    return documents(EDGE_ROWS, clash=True)


@pytest.fixture(scope="session")
def empty(documents):
    return documents([], clash=True)
