"""Documents that every operator has to cope with."""

import pytest

LONG = "lorem ipsum dolor sit amet " * 4000
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, n_words string, score string, `row` string, key string"


def document(doc_id, text, lang="en", source="a"):
    """With columns named like those the operators compute."""
    return (doc_id, text, lang, source, 0, "s", "w", "x", "r", "k")


ODD = [
    document(1, None),
    document(2, ""),
    document(3, " \n\t "),
    document(4, "one"),
    document(5, "one two"),
    document(None, "no id at all but some words in it"),
    document(6, LONG, "la"),
    document(7, "The same words twice over and over again.", None, None),
    document(7, "The same words twice over and over again.", None, None),
    document(8, "!!! 123 ??? ...", "en", ""),
    document(9, "naïve Ünïcode 中文 😀   end", "fr", "b"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def make(spark):
    """Documents of texts, numbered from 0."""
    return lambda texts: spark.createDataFrame([document(i, t) for i, t in enumerate(texts)], DOCS)
