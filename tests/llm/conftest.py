import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path[:0] = [str(Path(__file__).parent)]

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, row string, id string, node bigint, size int"


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def benchmark(spark, folder):
    return spark.read.parquet(f"{folder}/benchmark.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like inner ones."""
    long_text = " ".join(f"wort{i % 977} Ünd{i % 31}" for i in range(60_000))
    copied = " ".join(f"alpha{i} beta" for i in range(60))
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, " \t\n ", None, "a", 4), (4, "One two", "en", "b", 7),
        (4, "One two", "en", "b", 7), (5, "ONE TWO", None, None, 7), (6, long_text, "de", "a", 9), (7, copied, "en", "a", 9),
        (8, copied.upper(), "en", "", 9), (9, copied + " tail", "en", "b", 9), (None, copied, "en", "a", 9),
        (None, None, None, None, None), (10, "### !!! 123", "en", "b", 9), (11, "日本語 の テキスト", "ja", "b", 9), (12, "a\x00b \x00", "en", "c", 5),
    ]
    return spark.createDataFrame([(*r, 0.5, "x", "y", 1, 2) for r in rows], COLUMNS)


@pytest.fixture(scope="session")
def nothing(spark, odd):
    return spark.createDataFrame([], T.StructType(odd.schema.fields))
