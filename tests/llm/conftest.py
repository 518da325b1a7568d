import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names the operators use themselves.
CLASHING = "score double, size long, ids string, row int, `class` int, __text string, kept boolean"


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with nulls in any column, empty, long and repeated texts, repeated rows and ids."""
    rng = random.Random(5)
    words = ["the", "of", "Haus", "été", "niño", "token:", "and", "x1", "\U0001F600", "it's", "WORD."]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    long = text(6_000)
    plain = text(80)
    rows = [
        (1, plain, "en", "a", 5), (2, plain, "en", "a", 5), (3, plain.replace(" ", "\n "), "en", "b", 5),
        (4, None, "en", "a", None), (5, "", "de", None, 0), (6, " \t\n", None, "b", 3), (7, long, "de", "a", 9),
        (8, long + " end", "de", "a", 9), (9, "12345 +-", None, None, 8), (None, text(30), "fr", "c", 1),
        (None, None, None, None, None), (10, text(200), "fr", "c", 1), (10, text(200), "fr", "c", 1),
        (11, text(50), "es", "b", 2), (11, None, "es", "b", 2), (12, "a" * 5_000, "es", "b", 2),
        (13, "ab " * 900, "en", "b", 2), (14, "a b", "en", "b", 2), (15, "A  b", "en", "b", 2),
    ]
    rows += [(20 + i, text(rng.randint(1, 60)), rng.choice(["en", "de", "fr", "es"]), rng.choice("abc"), i) for i in range(60)]
    return rows + [rows[0], rows[11], rows[4]]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    rows = [(*r, 0.5, 7, "x", 1, 2, "t", True) for r in odd_rows]
    return spark.createDataFrame(rows, f"{COLUMNS}, {CLASHING}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
