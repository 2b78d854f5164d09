"""Odd rows that every operator has to take."""

from __future__ import annotations

import pytest

LONG = "word " * 30_000 + "end"
ODD_TEXTS = [
    None,
    "",
    " ",
    "\n\t\r\n",
    "a",
    "Same text, twice over.",
    "Same text, twice over.",
    "é́ß ▁ \x1c \x85 　 𝔘 İ ﬁ",
    "x" * 5_000,
    LONG,
]


@pytest.fixture
def odd_docs(spark):
    """Null ids and texts, empty and long texts, repeated rows, and columns with clashing names."""
    rows = [(i, t, "en", "s", 1, i, "pii", 2.0) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], (None, "no id", None, None, None, None, None, None)]
    names = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
    return spark.createDataFrame(rows, f"{names}, row LONG, pii STRING, toxicity DOUBLE")


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.where("doc_id < 0")
