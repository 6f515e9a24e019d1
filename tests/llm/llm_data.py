"""Tables and small helpers of the tests (the spark fixture is that of the other tests)."""

import re

import pytest

SF = "/root/testdata/sf0.001"

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "score double, key string, block int, size long, spans string, base string, copies int")
MORE = (0.5, "k", 1, 7, "x", "y", 3)
NONE = (None,) * 7

#: Nulls in every column, empty and very long texts, ties, repeated rows, and extra columns with clashing names.
ODD_DOCS = [
    (1, None, None, None, None, *NONE),
    (2, "", "en", "a", 0, *MORE),
    (3, " \t\n ", "en", "a", 4, *MORE),
    (4, "one two", "en", "b", 7, *MORE),
    (5, "one two", "en", "b", 7, *MORE),
    (6, "One TWO", None, "b", 7, *MORE),
    (7, "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf at night", "en", "a", 88, *MORE),
    (8, "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf at noon", "en", None, 87, *MORE),
    (9, "word " * 20000 + 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "en", "a", 100050, *MORE),
    (10, "é ü  \r\n x\x0by \U0001F600 end", "fr", "c", 20, *NONE),
    (10, "é ü  \r\n x\x0by \U0001F600 end", "fr", "c", 20, *NONE),
    (None, "a row without an id", None, "c", 19, *NONE),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD_DOCS, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
