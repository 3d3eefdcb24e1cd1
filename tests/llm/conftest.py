import pytest
from pyspark.sql import types as T

EXTRA = ["size", "target", "score", "bucket", "batch", "id", "part", "key", "w", "base", "tokens", "hub", "rank", "rep"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())]
                      + [T.StructField(c, T.StringType()) for c in EXTRA])

PROSE = "the quick brown fox jumps over the lazy dog and runs far away from here to there again today "
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(12000))
EDGE = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, LONG, "en", "b"),
    (5, PROSE * 3, "en", "b"), (6, PROSE * 3, "en", None), (6, PROSE * 3, "en", None), (7, PROSE * 3 + "end", "en", "c"),
    (None, PROSE, "en", "c"), (8, "123 456", None, "a"), (9, "café ÀÉ 日本語 \U0001F600 token", "fr", "é"),
    (10, "one two", "de", "a"), (11, "One  TWO", "de", "a"),
]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        rows = [tuple(r) + (None,) * (4 - len(r)) for r in rows]
        return spark.createDataFrame([r[:4] + (None if r[1] is None else len(r[1]),) + ("x",) * len(EXTRA) for r in rows], SCHEMA)
    return make


@pytest.fixture(scope="session")
def edge(make_docs):
    return make_docs(EDGE).cache()


@pytest.fixture(scope="session")
def none(make_docs):
    return make_docs([])
