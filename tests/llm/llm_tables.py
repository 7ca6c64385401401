import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
SENTENCE = "The quick brown fox jumps over the lazy dog while seven wizards quietly mix a potion of moss and rain. "
#: Columns that clash with names the operators use inside or return.
EXTRA = "shard slot bucket record node copy t bands core place pii score spans kept words hash stays mark_id".split()


def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    texts = [
        (1, SENTENCE * 3), (2, SENTENCE * 3), (3, SENTENCE * 3 + "and then some"), (4, None), (5, ""), (6, "  \n\t "), (7, "one"),
        (8, "x" * 5000), (9, "word " * 4000), (10, "mail bob@example.com or +1 (212) 555-0100 now, 4111 1111 1111 1111"),
        (11, "9" * 3000), (12, "1 " * 3000), (None, SENTENCE), (None, None), (13, "é漢😀 " * 50), (13, "other text under the id 13"),
        (1, SENTENCE * 3), (1, SENTENCE * 3), (14, "a.b@c." * 500), (15, "+1 " * 500),
    ]
    rows = []
    for i, (key, text) in enumerate(texts):
        rows.append((key, text, None if i % 3 else "en", None if i % 4 else f"src{i % 2}", None if i % 5 else 7, *["extra"] * len(EXTRA)))
    return rows


SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(name, T.StringType()) for name in EXTRA]
)


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
