import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, n_tokens string, score string, words string"


def rows_of(*docs):
    """Full rows with clashing extra columns from (doc_id, text[, lang, source])."""
    out = []
    for d in docs:
        doc_id, text, lang, source = (*d, *[None] * (4 - len(d)))
        out.append((doc_id, text, lang, source, len(text or ""), "x", "y", "z", None))
    return out


@pytest.fixture(scope="session")
def frame(spark):
    """A table of documents written to files and read back, as operators meet it."""
    from tickloom.llm.common import stored

    return lambda *docs: stored(spark.createDataFrame(rows_of(*docs), SCHEMA).coalesce(2), "fixture")


@pytest.fixture(scope="session")
def edge(frame):
    """Nulls in every column, empty and blank texts, repeated rows, equal texts, a very long text."""
    long_text = " ".join(f"word{i % 977} and{i}." for i in range(30_000))
    return frame(
        (1, "The quick brown fox jumps over the lazy dog. It was not amused.", "en", "b"),
        (2, None, None, None),
        (3, "", "en", "a"),
        (4, " \n\t ", "en", "a"),
        (5, "The quick brown fox jumps over the lazy dog. It was not amused.", "en", None),
        (5, "The quick brown fox jumps over the lazy dog. It was not amused.", "en", None),
        (6, long_text, "en", "c"),
        (None, "a text without an id, café \U0001f600 <|endoftext|> it's", None, "b"),
    )


@pytest.fixture(scope="session")
def nothing(spark):
    from tickloom.llm.common import stored

    return stored(spark.createDataFrame([], SCHEMA), "nothing")
