import pytest

from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of documents from texts or (doc_id, text) pairs."""

    def make(rows, sources=None):
        pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(i, t, "en", (sources or {}).get(i, "s"), None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def clashing():
    """Adds columns that carry names the operators use for their own results."""

    def add(df, *names):
        for name in names:
            df = df.withColumn(name, F.lit("own"))
        return df

    return add


@pytest.fixture(scope="session")
def samples(spark):
    """The documents of the smallest sample as plain rows."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    return {r["doc_id"]: r["text"] for r in rows}
