import random

import pytest
from pyspark.sql import types as T

SF_SMALL, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])
#: Names that the operators use inside.
CLASHING = ["h", "size", "start", "row", "_row", "_id", "_th", "t", "w", "fp", "shard", "words", "place",
            "n", "ids", "queue", "toxicity", "score", "kept", "recipe", "digest", "doc", "s"]


def words(rng, n, pool=600):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, odd white space."""
    rng = random.Random(5)
    rows = [(i, words(rng, rng.randrange(1, 200)), "en", f"src{i % 4}", None) for i in range(60)]
    rows += [(100, None, "en", "src1", 0), (101, "", "en", "src1", 0), (102, " \t\n ", None, None, None),
             (None, "a lost id", "de", "src2", 9), (None, None, None, None, None),
             (103, "twice", "en", None, 5), (103, "twice", "en", None, 5), (103, "not twice", "en", "src0", 9),
             (104, words(rng, 30_000, 5000), "en", "src0", None), (105, "x" * 20_000, "en", "src3", 20_000),
             (106, "Été \U0001f600 Kelvin naïve space", "fr", "", 20)]
    rows += [(200 + i, rows[3][1], "en", "src0", None) for i in range(40)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCUMENTS).repartition(4)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def clashing(odd):
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)])


def same_rows(a, b):
    key = lambda r: repr(tuple(r))
    return a.columns == b.columns and sorted(a.collect(), key=key) == sorted(b.collect(), key=key)
