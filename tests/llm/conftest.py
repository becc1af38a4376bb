"""Tables for the corpus operators: awkward rows, no rows, and a small planted corpus."""

import random

import pytest
from pyspark.sql import types as T

WORDS = ("the of and to in is was that for with on as river stone window morning letter garden "
         "winter paper silver market village doctor answer story summer engine mountain").split()
# columns whose names are also those of operators' outputs or of their helpers
EXTRA = ["fp", "kept", "Score", "copies", "shard", "ids", "_mark", "n_pseudonyms", "lang_pred"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
     T.StructField("n_chars", T.LongType())] + [T.StructField(c, T.StringType()) for c in EXTRA])


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def prose(seed, n=40):
    rng = random.Random(seed)
    return "\n".join(sentence(rng, 8) for _ in range(max(1, n // 8)))


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *EXTRA)


def edge_rows():
    long_text = prose(1, 40_000)
    return [
        row(1, prose(2)), row(1, prose(2)),                    # a repeated row
        row(1, prose(3)),                                      # an id with another text
        row(None, prose(4)), row(None, None, None, None),
        row(5, None), row(6, ""), row(7, " \t\n "), row(8, "x" * 3000), row(9, long_text),
        row(10, prose(2), None, None), row(11, "été ▁ 日本 😀 été", "fr", "b"), row(12, "4111111111111111 #%&", "de", ""),
        row(-3, prose(5), "en", "b"),
    ]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture()
def many_parts(spark):
    """No coalescing: several tasks even for small tables."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, old)
