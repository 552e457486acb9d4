import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCUMENTS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
])

PROSE = "The quick brown fox jumps over the lazy dog. It don't care, and 12 others didn't either!"

#: Null, empty, blank and long texts, ties, repeated rows, null ids and sources, words of many kinds.
ODD = [
    (1, PROSE, "en", "a", 10), (2, PROSE, "en", "a", 10), (2, PROSE, "en", "a", 10), (3, None, None, None, None),
    (4, "", "en", "b", 0), (5, " \t\n ", "en", "b", 4), (None, PROSE + " More of it.", "en", None, 1), (None, None, None, "b", None),
    (6, "word " * 5000, "en", "a", 1), (7, "é" * 700 + " ß̈ 日本語のテキスト \U0001f600\U0001f600", "de", "c", 1),
    (8, "one\ntwo\n\none\r\ntwo", "en", "c", 2), (9, "x" * 3000, "en", "c", 2), (10, "a\x1fb <|endoftext|> c d\x85e", "en", "d", 2),
    (11, "\n".join(f"line number {i} of a text with several words" for i in range(200)), "en", "a", 3),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOCUMENTS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def clashing(documents):
    """Extra columns with the names of helper columns."""
    from pyspark.sql import functions as F

    names = ("_size", "_order", "_due", "size", "target", "taken", "due_times", "source_size", "_pieces", "_tables", "_far",
             "_h", "_row", "removed", "h", "doc", "id", "node", "ids", "_range", "rank", "statistics", "score", "words")
    return documents.limit(30).select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])


def by_id(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)
