import random
import re

import pytest

from layercake.llm.common import ship

# Extra columns with the names that operators use inside or for results.
CLASHING = "id string, score string, matches string, n_words int, c0 string, n0 string, gone string, cell int"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text), with lang, source and columns of clashing names."""

    def make(rows, lang="en", source="s"):
        extra = (None, "x", "y", 1, None, "z", "g", 7)
        full = [(i, t, lang, source, len(t or ""), *extra) for i, t in rows]
        schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
        return spark.createDataFrame(full, schema)

    return make


def words(n, seed, vocabulary=400):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(n))


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids and texts, empty, blank, very long and repeated ones, odd characters."""
    long = words(60_000, 5)
    return [
        (1, None), (2, ""), (3, " \n\t\r\n "), (4, long), (5, long), (5, long), (None, long),
        (None, None), (6, "one"), (7, "one"), (8, "Été \U0001f600 fin\x00nul K"),
        (9, words(30, 1)), (10, words(30, 1)), (11, words(30, 1).upper()), (12, "a b c d\n" * 9),
    ]
