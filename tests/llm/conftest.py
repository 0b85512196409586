import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, found string, row int, fp string"


def long_text(words=40_000):
    return " ".join(f"word{i % 977} of{i % 31}" for i in range(words // 2))


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, one id twice, and columns whose names operators use inside."""
    tail = (None, None, 1.0, "x", 7, "y")
    rows = [
        (1, "The first line of this document is quite long.\nAnd a second one follows it here.", "en", *tail[1:]),
        (1, "The first line of this document is quite long.\nAnd a second one follows it here.", "en", *tail[1:]),
        (1, "Another text under the same id, with other words in it.", "en", *tail[1:]),
        (2, None, None, *tail[1:]),
        (None, "A text without an id that should be handled all the same.", "en", *tail[1:]),
        (3, "", "en", *tail[1:]),
        (4, " \n\t\n ", None, *tail[1:]),
        (5, long_text(), "de", *tail[1:]),
        (6, "x" * 50_000, "de", *tail[1:]),
        (7, "1234 !!! ... 99", "fr", *tail[1:]),
        (8, "日本語の文章です。これはテストです。 \U0001f600 ▁ ퟿", "ja", *tail[1:]),
        (None, None, None, *tail[1:]),
    ]
    return spark.createDataFrame([(r[0], r[1], r[2], None, None, 1.0, "x", 7, "y") for r in rows], SCHEMA)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def ids(rows):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in rows)


@pytest.fixture
def odd_ids(odd_docs):
    return ids(odd_docs.collect())
