import pytest
from pyspark.sql import types as T

COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, shard string, part int, "
           "`_draw` int, hash string, print int, size string, s int, `_key_id` int, spans string, label int")


def words(n, stem="w"):
    return " ".join(f"{stem}{i}" for i in range(n))


ODD = [
    (1, "Alpha beta gamma delta.", "en", "a"),
    (1, "Alpha beta gamma delta.", "en", "a"),  # repeated row
    (2, "alpha beta gamma delta.", "en", "b"),
    (3, None, None, None),
    (4, "", "en", "a"),
    (5, " \n\t ", "en", "b"),
    (6, words(9_000), "en", "a"),  # very long
    (7, "É" * 3_000, "fr", None),
    (None, "No id here at all", "en", "a"),
    (None, None, None, "b"),
    (8, "one", None, "b"),
    (8, "same id other text", "en", "a"),
    (9, words(40, "x"), "en", "c"),
    (10, words(40, "x") + " y", "en", "c"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    rows = [(*r, len(r[1] or ""), "own", 5, 6, "own", 7, "own", 8, 9, "own", 1) for r in ODD]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def none(spark):
    """The same columns without rows."""
    return spark.createDataFrame([], T._parse_datatype_string(COLUMNS))
