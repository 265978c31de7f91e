import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    long = "word " * 30_000 + "http://x " + "ß" * 20_000
    rows = [
        (1, "the cat sat on the mat and looked at the dog by the door", "en", "a", 5, 0.1, 1), (1, "the cat sat on the mat and looked at the dog by the door", "en", "a", 5, 0.1, 1),
        (2, None, "en", "a", None, None, None), (3, "", None, None, 0, 0.0, 0), (None, "der Hund und die Katze sind nicht hier", "de", "b", 1, 1.0, 2), (None, None, None, None, None, None, None),
        (4, long, "en", "b", 9, 0.2, 3), (5, "der Hund und die Katze sind im Haus und schlafen", "de", "b", 1, 0.3, 4), (6, " \n\t ", "de", "", 1, 0.3, 4), (7, "!!! 123 +1 (974) 555-3436 x@y.zz", None, "c", 1, 0.3, 4),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
