import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls anywhere, empty, blank and very long texts, repeats and clashing column names."""
    long = "wort " * 30_000 + "ende"
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 1, "x", 0.5),
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 1, "x", 0.5),
        (2, None, "en", "a", None, None, None),
        (3, "", None, "b", 0, "k", 1.0),
        (4, " \n\t ", "de", None, 4, "k", 1.0),
        (5, long, "de", "b", len(long), "k", None),
        (None, "no id here at all", "en", None, None, None, None),
        (7, "123 456 .", None, None, 3, "z", 0.0),
        (8, "THE quick brown fox jumps over the lazy dog", "en", "a", 1, "y", 0.1),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, score double")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
