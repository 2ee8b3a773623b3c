import pytest

NASTY = [
    (1, "the cat sat on the mat", "en", "a", 1), (2, "The Cat sat on the mat", "en", "a", 2),
    (3, None, None, None, None), (4, "", "fr", "b", 0), (5, " \n\t ", None, "b", 3), (6, "été à la plage", "fr", "c", 4),
    (6, "été à la plage", "fr", "c", 4), (None, "orphan text", "en", "a", 5), (None, None, None, None, None),
    (7, "word " * 30000, "en", "a", 6), (8, "x" * 200000, "de", "c", 7), (9, "12 34 !!", "en", None, 8),
    (10, "日本語 <|endoftext|> don't 'RE   end  ", "en", "b", 9), (11, "ab", "en", "a", 1),
]


@pytest.fixture(scope="session")
def nasty(spark):
    """Nulls, empty and very long texts, repeated rows, and extra columns whose names operators use inside."""
    return spark.createDataFrame(
        [(*r, i, "z", 1.0) for i, r in enumerate(NASTY)],
        "doc_id long, text string, lang string, source string, n_chars int, "
        "fp long, row string, suspect double").repartition(3)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
