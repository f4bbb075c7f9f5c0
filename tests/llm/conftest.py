import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A small frame from rows and a schema, in one partition or more."""
    def make(rows, schema, parts=2):
        return spark.createDataFrame(rows, schema).repartition(parts)
    return make
