import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, spans string, row int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, an empty and a very long text, repeated rows, and columns whose
    names clash with those the operators add."""
    long = "the quick brown fox jumps over the lazy dog again and again. " * 4000
    rows = [
        (1, "Hello there, general words of a clean text.", "en", "s", 5, 0.5, "x", 1),
        (1, "Hello there, general words of a clean text.", "en", "s", 5, 0.5, "x", 1),
        (2, None, None, None, None, None, None, None),
        (3, "", "en", "s", 0, 0.1, "y", 2),
        (None, " \t\n ", "en", "s", 3, 0.1, "y", 2),
        (None, "A text without any id, of its own.", "en", "s", 3, 0.1, "y", 2),
        (4, long, "en", "s", len(long), 0.1, "z", 3),
        (5, long + "once more", "en", "s", len(long), 0.1, "z", 3),
        (6, "漢字 🙂 é e\u0301 \x1c\x85 \u3000 İΣ <|endoftext|>", "ja", "s", 9, 0.1, "z", 3),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def own_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 0, 1), (3, 0, 1), (3, 1, 0)], "doc_id bigint, quality int, toxic int")
