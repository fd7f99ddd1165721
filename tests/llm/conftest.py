import pytest

DOCS = "doc_id bigint, text string, source string, doc string, row bigint, n bigint"


@pytest.fixture(scope="session")
def store(tmp_path_factory, spark):
    """Write rows as a stored table and read it back."""

    def make(rows, schema, parts=3):
        path = str(tmp_path_factory.mktemp("table") / "t.parquet")
        spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture(scope="session")
def odd_docs(store):
    """Nulls in any column, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    prose = "The quick brown fox, and the slow one, ran over a hill to see what was there. " * 3
    long = " ".join(f"Word{i % 977} and" for i in range(6000))
    rows = [
        (1, prose, "a", "x", 7, 1),
        (2, prose.upper(), "a", "x", 7, None),
        (3, prose + "End.", "b", None, None, 1),
        (3, prose + "End.", "b", None, None, 1),
        (3, prose + "End.", "b", None, None, 1),
        (3, "other text under a used id", None, None, 2, 1),
        (4, None, "a", None, None, None),
        (5, "", "a", None, None, None),
        (6, " \t\n ", None, None, None, None),
        (None, prose, "c", None, None, None),
        (None, None, None, None, None, None),
        (7, long, "a", None, None, None),
        (8, long + " tail", "a", None, None, None),
        (9, "one", "é", None, None, None),
        (10, "two words", "Z", None, None, None),
    ]
    return store(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(store):
    return store([], DOCS, 1)
