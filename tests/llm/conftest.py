import pytest
from pyspark.sql import SparkSession


@pytest.fixture
def docs(spark: SparkSession):
    """Makes a documents table from (doc_id, text) pairs, with extra columns named like results."""
    def make(rows, partitions=3):
        rows = [(i, t, "en", "s", None if t is None else len(t), "x", -1) for i, t in rows]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, n_removed int").repartition(partitions)
    return make
