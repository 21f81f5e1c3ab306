import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("_text", T.StringType()),  # a name that operators use themselves
        T.StructField("n", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(*rows):
        return spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and long texts, ties and repeated rows."""
    long = " ".join(f"word{k % 997} is {k}." for k in range(30_000))
    same = "A house. A small house on the hill.\nAnd a garden behind the house with many trees."
    return make_docs(
        (1, same, "en", "s1"),
        (1, same, "en", "s1"),
        (2, same, None, None),
        (3, None, None, "s2"),
        (4, "", "en", "s2"),
        (None, "eins zwei drei vier", "de", "s1"),
        (5, long, "en", "s2"),
        (6, "\t\n ... 123", "xx", None),
    )
