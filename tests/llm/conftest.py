import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("n_chars", LongType()),
                   # extra columns with clashing names
                   StructField("h", StringType()), StructField("fp", LongType()), StructField("block", IntegerType()),
                   StructField("ids", StringType()), StructField("_site", StringType())])

LONG = " ".join(f"word{i % 977}" for i in range(60_000))


def hard_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    rows = [(1, base, "en", "a", 10), (1, base, "en", "a", 10), (2, base + " pi", "en", "b", 10), (3, "", "en", "a", 0),
            (4, None, "en", "c", None), (5, " \n\t ", None, "a", 4), (None, base, "en", "a", 10), (6, LONG, "de", None, 1),
            (7, LONG, "de", "b", 1), (8, "one two", "fr", "c", 7), (9, "mail bob@example.com or +1 (555) 123-4567", "en", "d", 3),
            (10, None, None, None, None), (11, "a<|endoftext|>b\n\nalpha", "en", "e", 1), (None, None, None, None, None),
            (12, "ünïcödé 🙂 " * 20, "de", "e", 220), (12, "other text under the same id", "de", "e", 220)]
    return [(*r, "x", 1, 2, "i", "s") for r in rows]


@pytest.fixture(scope="session")
def hard(spark):
    return spark.createDataFrame(hard_rows(), DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
