import pytest

from suturestar.llm.frames import importable


@pytest.fixture(scope="session", autouse=True)
def _workers_find_the_package(spark):
    importable(spark)


@pytest.fixture
def odd_documents(spark):
    """Null and empty texts, null and repeated ids, ties, a long text, and columns named like outputs."""
    long = "one two three four five six seven eight nine ten " * 3000
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta", "x", 1),
        (2, "alpha beta gamma delta epsilon zeta eta theta", "x", 2),
        (2, "alpha beta gamma delta epsilon zeta eta theta", "x", 2),
        (3, None, "y", 3),
        (4, "", None, 4),
        (5, long, "z", 5),
        (None, "no id here at all but words", "x", 6),
        (7, "   \t\n ", "x", None),
        (8, "tie é 中文 🤗 <|endoftext|> a@b.com", "x", 8),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, score int")
