import pytest
from pyspark.sql import functions as F

from tests_llm_plain import random_texts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Odd texts: null, empty, white space, one word, many repeats, very long.
ODD = [None, "", " \t\n ", "one", "a\n\na\n", "x y " * 40, "Word, " * 30000, "\x0b#*$%&|<>\x0c é ñ ß z", "it's 'tis <|endoftext|> <|STARTOFTEXT|> ###'s"]


@pytest.fixture(scope="session")
def texts():
    return random_texts(3, 70) + ODD


@pytest.fixture(scope="session")
def pairs(texts):
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def docs(spark, pairs):
    """Documents with extra columns whose names the operators use inside."""
    rows = [(i, t, "en" if i % 2 else "fr", None if i % 11 == 0 else f"s{i % 5}", len(t or "")) for i, t in pairs]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    clash = ["n_words", "kept", "size", "key", "fp", "doc", "base", "anchor", "segment", "part", "own", "label", "text_", "component", "u"]
    return frame.select("*", *[F.lit("clash").alias(c) for c in clash])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def benchmark(spark):
    rows = random_texts(3, 70)
    items = [(1, " ".join(rows[13].split()[:25])), (2, rows[8]), (10, "One!"), (3, None), (4, ""), (2, rows[8]), (None, "no such words here at all")]
    return spark.createDataFrame(items, "item_id long, text string")
