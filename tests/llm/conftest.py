import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
PROSE = "the river runs past the old mill and the children of the village swim in it when the summer is warm"
ODD = [
    (1, PROSE, "en", "a", 1),
    (2, PROSE, "en", "b", 1),  # equal text
    (2, PROSE, "en", "b", 1),  # repeated row
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \n\t ", "de", "c", 4),
    (6, LONG, "en", "a", 9),
    (7, "12 34 !!", "fr", None, 8),
    (None, PROSE + " again", "en", "a", 1),
    (None, None, None, None, None),
    (8, "ünï 😀 ▁ cödé\nline two\nline two", "de", "c", 2),
    (9, "one two", "en", "z", 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, very long, equal and repeated rows."""
    return spark.createDataFrame(ODD, DOCUMENTS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
