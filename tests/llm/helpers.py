"""Small documents, pages and labels with the awkward rows that every operator must stand."""

from __future__ import annotations

import pytest


def numbered(first: int, n: int) -> str:
    """A text of n words that no other range of numbers shares."""
    return " ".join(f"w{i}" for i in range(first, first + n))


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) or (id, text, source) rows."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def awkward():
    """Rows with nulls, empty, blank, short, very long, repeated and tied texts and ids."""
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, numbered(0, 30_000)), (7, numbered(50_000, 80)),
        (7, numbered(50_000, 80)), (8, "x" * 50_000), (None, numbered(60_000, 60)), (9, "é ü 日本語 \x00 <|endoftext|>", None),
    ]
