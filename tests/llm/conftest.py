"""Small frames for the operators of the subpackage."""

import pytest

ODD_DOCS = [
    # id, text, lang, source, n_chars: nulls, empty, blank, repeated rows, one very long text
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "b", 59),
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "b", 59),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (None, "a text without an id +1 (212) 555-0100", "en", None, 38),
    (4, " \t\n\x0b ", "fr", "a", 5),
    (5, "word " * 30_000, "en", "a", 150_000),
    (6, "The quick brown fox jumps over the lazy dog again and again", None, "b", 59),
    (7, "éà ü €uro <|endoftext|> ÀB c", "fr", "c", 28),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(ODD_DOCS, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
