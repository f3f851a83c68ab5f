import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCUMENTS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text[, source]) as a table of documents."""

    def make(*rows):
        full = [
            (one[0], one[1], "en", one[2] if len(one) > 2 else "s", len(one[1] or ""))
            for one in rows
        ]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture
def clashing():
    """The same rows with more columns, named like those that operators work with."""

    def make(df):
        from pyspark.sql import functions as F

        names = ("score", "mark", "key", "key_id", "node", "size", "cell", "rank", "total", "times")
        return df.withColumns({name: F.lit("own") for name in names})

    return make
