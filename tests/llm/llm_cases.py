import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def prose(seed: int, n: int, words: int = 4000) -> str:
    """``n`` words drawn with the frequencies of a text."""
    r = random.Random(seed)
    pool = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(words)]
    r = random.Random(seed * 7 + 1)
    return " ".join(pool[min(words - 1, int(r.paretovariate(0.6)) - 1)] + ("." if r.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and blank texts, repeated rows and ids, ties, a long text."""
    long = prose(5, 30_000)
    plain = prose(1, 120)
    return [(1, plain, "en", "a", 3), (2, plain, "en", "b", None), (2, plain, "en", "b", None), (3, None, "en", "a", 0),
            (4, "", None, "a", 0), (5, " \t\n ", "de", None, 1), (None, plain, "en", "a", 3), (None, None, None, None, None),
            (6, long, "en", "c", 9), (7, long + " end", "en", "c", 9), (8, "One", "fr", "c", 1), (9, "one", "fr", "a", 1),
            (10, plain.replace(" ", "\n", 1), "en", "a", 3), (11, "a\u00a0b \u4e2d\u6587 " * 40, None, "b", 5), (12, "x" * 50_000, "de", "b", 7)]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, DOCS).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sample(spark):
    """All documents of the smallest data set."""
    from assay.sources.tables import table

    return table(spark, "/root/testdata/sf0.001", "documents")


@pytest.fixture(scope="session", autouse=True)
def scratch(spark):
    yield
    from assay.llm.staging import release

    assert release(spark) >= 0
