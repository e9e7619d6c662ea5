import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, _id string"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from doctriage.session import ship_package

    ship_package(spark)


@pytest.fixture
def frame(spark):
    """Documents with further columns whose names clash with those that operators give."""
    def make(rows, partitions=3):
        full = [(*r, *(None,) * (4 - len(r)), 7, -1, "x", "y") for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)
    return make


@pytest.fixture
def odd_rows():
    """Null and empty texts, a null id, repeated rows, ties, a very long text."""
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(30000))
    return [
        (1, None, "en", "a"), (2, "", "en", None), (3, " \t\n\v\f\r ", None, "b"), (4, "One two three four", "en", "a"),
        (5, "one  two three\nfour", "de", "b"), (6, "One two three four ", "en", "a"), (6, "One two three four ", "en", "a"),
        (None, "Onetwothreefour", "fr", "c"), (8, long, "en", "a"), (9, long + " ", "en", None), (10, "ünï čode 字 😀", "fr", "é"),
        (-3, "x", "es", "Z"), (11, "a b", "en", "a"),
    ]
