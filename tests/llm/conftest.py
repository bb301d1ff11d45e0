import pytest

from clickloom.sources.shipping import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def texts(spark):
    """Rows (doc_id, text) with nulls, blanks, repeated rows, odd characters and a long word."""
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (5, "Ünï çödé İΣ ΑΣ <|endoftext|> it's 'LL x" + "!" * 300),
        (6, "a" * 5000), (None, "no id at all"), (7, "the quick brown fox " * 60), (8, "the quick brown fox " * 60), (9, "\x00 日本語 🙂 ½"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string")
