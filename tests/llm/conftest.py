import pytest

#: Columns with names that operators use themselves.
CLASHING = "doc_id long, text string, fp long, key string, __id long, rid long, component_id long, keep_id string, `group_size` int, word string, lang string, __key string, __nth int, score double, __row int, `row` string, hit boolean, n int, kept string, sha string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and white texts, ties, repeated rows, a very long text, columns with clashing names."""
    texts = [
        (0, "the cat sat on the mat and looked out of the window for a while"), (1, None), (2, ""), (3, "  \n\t "), (4, "one"), (4, "one"), (5, "ONE"), (None, "one"), (None, None),
        (6, "the cat sat on the mat and looked out of the window for a while"), (7, "the  cat sat\non the mat and looked out of the window for a while"), (8, "é ü 日本語 \u2581 <|endoftext|> x" * 3),
        (9, "word " * 30_000), (10, "x" * 20_000), (11, "line one.\nline two.\n\nline four!!"),
    ]
    return spark.createDataFrame([(i, t, 1, "k", 2, 3, 4, "5", 6, "w", None, "a", 7, 0.5, 8, "b", True, 9, "c", "d") for i, t in texts], CLASHING)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], CLASHING)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
