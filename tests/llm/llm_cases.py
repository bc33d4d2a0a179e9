"""Fixtures of the operators' tests, imported by each of them."""

import pytest

SF_SMALL = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977}" for i in range(120_000)) + "."


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """These tables are tiny; the operators run many small jobs."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


ROWS = [
    (1, "one two three four five six seven. Eight nine ten eleven twelve thirteen. Fourteen fifteen sixteen seventeen.", "a"),
    (2, "One two  three four five six\nseven. eight nine ten eleven twelve thirteen. fourteen fifteen sixteen seventeen.", "a"),
    (3, None, "a"), (4, "", None), (5, " \t\n", "b"), (6, "two words", "b"), (7, "two words", None),
    (None, "a row that has no id at all, but some text in it.", "b"), (8, LONG, "c"), (9, "password=b7db7aa4a5fcc78305 and more text here", None),
    (10, "ein kürzerer Satz mit Ümläuten — und Zeichen \U0001F600 auch.", "c"), (10, "ein kürzerer Satz mit Ümläuten — und Zeichen \U0001F600 auch.", "c"),
]


@pytest.fixture()
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns that clash with
    names that operators use, also by case alone."""
    rows = [(i, t, "x", s, 1, 0.5, 7, "k", i, "other") for i, t, s in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, h int, key string, _0 long, TEXT string")


@pytest.fixture()
def empty(odd):
    return odd.limit(0)

