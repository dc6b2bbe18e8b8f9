import pytest

LONG = "lorem " * 30000


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows, extra columns and clashing names."""
    rows = [(1, "the cat sat on the mat and the dog sat on the log with a frog", "en", "a", 3, "x"),
            (2, "the cat sat on the mat and the dog sat on the log with a frog", "en", "a", 3, "y"),
            (2, "the cat sat on the mat and the dog sat on the log with a frog", "en", "a", 3, "y"),
            (3, None, "en", None, None, None), (4, "", None, "b", 0, None), (5, " \t\n", "de", "b", 3, "k"),
            (None, "der hund und die katze und das haus", "de", None, 5, "k"), (6, LONG, None, "c", len(LONG), "z"),
            (7, "12345 67890 !!!", "fr", "c", 15, "z"), (8, "token = \"abcdef0123456789abcdef0123\" é AKIA" + "A" * 16, "en", "c", 9, "z"),
            (9, "one", "en", "c", 3, "z"), (10, "<|endoftext|> naïve Ünïcode 漢字 \U0001f600", "en", "d", 3, "z"), (11, "Привет мир", None, "d", 3, "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, k string")


@pytest.fixture(scope="session")
def empty(messy):
    return messy.where("false")
