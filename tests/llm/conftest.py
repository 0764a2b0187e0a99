import pytest

from newsweave.session import tune


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with other columns and one of a clashing name."""

    def make(rows, schema="doc_id bigint, text string"):
        tune(spark)
        from pyspark.sql import functions as F

        return spark.createDataFrame(rows, schema).select("*", F.lit("x").alias("node"), F.lit(1).alias("line"), F.lit(None).cast("string").alias("source")).repartition(3)

    return make
