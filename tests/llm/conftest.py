import pytest

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, blank, very long, tied and repeated rows, and columns whose names clash."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
    rows = [(1, None, "en", "a"), (2, "", None, None), (3, "   \n\t ", "en", "a"), (4, long, "de", "b"),
            (5, "one two", "en", "a"), (5, "one two", "en", "a"), (6, "one two", "en", "b"),
            (None, "no identifier here", "fr", "c"), (7, "x" * 200_000, "en", None), (8, "ünï çødé \U0001F600 text", "fr", "c")]
    rows = [(*r, len(r[1]) if r[1] is not None else None, 1.0, "k", 3, 4, "z", True, 9, "b") for r in rows]
    return spark.createDataFrame(rows, SCHEMA + ", _score double, key string, fp long, row long, _spans string, "
                                                "_row boolean, _tokens int, _base string")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
