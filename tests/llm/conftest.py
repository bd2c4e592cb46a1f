import pytest

from kerbline.llm.stage import let_workers_import

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, rep string, digest long, size string, packed int, h int"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    let_workers_import(spark)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank, short and long texts, repeated rows and ids, columns with clashing names."""
    words = [f"word{i % 97}x{i % 13}" for i in range(30_000)]
    rows = [
        (1, "one two three four five six seven eight nine ten " * 4, "en", "a"),
        (2, "one two three four five six seven eight nine ten " * 4, "en", "b"),
        (2, "one two three four five six seven eight nine ten " * 4, "en", "b"),
        (3, None, None, None),
        (4, "", "en", "a"),
        (5, " \n\t ", "en", None),
        (None, "a text without an id, which still counts as a text of its own in every way", "en", "a"),
        (None, None, None, None),
        (6, "x", "de", "c"),
        (7, " ".join(words), "fr", "c"),
        (8, "Grüße aus Köln 😀 " * 30, "de", "c"),
        (9, "one two three four five six seven eight nine ten " * 3 + "and something else follows here", "en", "a"),
    ]
    filled = [(doc, text, lang, source, len(text or ""), "rep", 7, None, doc, 1) for doc, text, lang, source in rows]
    return spark.createDataFrame(filled, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def small(spark):
    """The supplied documents of the smallest size."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
