"""Rows that every operator must take: nulls, empty and long texts, ties, repeats."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, kept string, score string"


def edge_rows():
    long_text = "wordy " * 30_000
    return [
        (1, None, None, None, None, "x", "x", "x"),
        (2, "", "en", "a", 0, None, None, None),
        (3, " \t\n\r\x0b\x0c ", "en", "a", 7, "x", None, None),
        (4, long_text, "en", "a", len(long_text), "x", None, None),
        (5, "ein Wort und noch ein Wort", "de", "b", 26, "x", None, None),
        (6, "ein Wort und noch ein Wort", "de", "b", 26, "x", None, None),
        (6, "ein Wort und noch ein Wort", "de", "b", 26, "x", None, None),
        (7, "é" * 50_000, "fr", "\U0001F600", 50_000, "x", None, None),
        (8, "no-space" * 20_000, None, "", 160_000, "x", None, None),
    ]


@pytest.fixture
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
