import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from tests_llm_tools import TEXT  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, found string"


def make(spark, rows):
    """A table of documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame(
        [(i, t, lang, src, len(t or ""), 7, "x") for i, t, lang, src in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, null ids."""
    rows = [(1, TEXT, "en", "a"), (2, TEXT, "en", "b"), (2, TEXT, "en", "b"),
            (3, TEXT.replace("seven", "nine"), "en", None), (4, None, None, "a"), (5, "", "fr", "c"),
            (6, " \n\t ", "fr", "c"), (7, "one two", "en", "a"), (8, "one two", "en", "a"),
            (9, "..., 123 !!", "de", "a"), (10, "mot " * 3000 + "fin", "fr", "d"),
            (None, TEXT + " and more words", "en", "a"), (None, None, None, None),
            (11, "été à Paris, c'est l'été : <|endoftext|> ok", "fr", "d")]
    return make(spark, rows).repartition(3, "text")


@pytest.fixture(scope="session")
def none(spark):
    return make(spark, [])
