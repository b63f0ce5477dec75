"""Fixtures and helpers of the tests in this folder; the session comes from the folder above."""

import random
from collections import Counter

import pytest

WORD = r"[^\x20\x09-\x0D]+"
TEXT_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents out of texts, or of (doc_id, text, source)."""
    def build(rows, repeat=1):
        filled = []
        for place, row in enumerate(rows):
            doc_id, text, source = row if isinstance(row, tuple) else (place, row, f"s{place % 3}")
            filled.append((doc_id, text, "en", source, None if text is None else len(text)))
        return spark.createDataFrame(filled * repeat, TEXT_SCHEMA)

    return build


@pytest.fixture(scope="session")
def words():
    """Deterministic plain words of a given number."""
    def build(count, seed=0):
        pick = random.Random(seed)
        return " ".join("".join(pick.choice("abcdefghijklmnop") for _ in range(pick.randint(2, 9))) for _ in range(count))

    return build


# Nulls in every column, empty and blank texts, ties, repeated rows, one very long text.
def awkward_rows(words):
    return [
        (None, None, None), (None, "", "s"), (1, None, "s"), (2, "", None), (3, " \n\t ", "s"), (4, "one", "s"),
        (5, words(30, 1), "s"), (5, words(30, 1), "s"), (6, words(30, 1), None), (7, words(4000, 2), "t"),
        (8, words(4000, 2) + " end", "t"), (9, "a b " * 40, "u"), (10, words(25, 3) + " mail joe@x.example.org now", "u"),
    ]


@pytest.fixture
def awkward(docs_of, words):
    return docs_of(awkward_rows(words))


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], TEXT_SCHEMA)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda place: columns[place])
    return Counter(tuple(str(row[place]) for place in order) for row in rows)
