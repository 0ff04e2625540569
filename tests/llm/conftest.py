import pytest
from cases import AWKWARD, CLASHING, SCHEMA
from pyspark.sql import functions as F


@pytest.fixture
def awkward(spark):
    """Null values, empty and very long texts, ties and repeated rows, with columns of clashing names."""
    docs = spark.createDataFrame(AWKWARD, SCHEMA).repartition(3)
    return docs.withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (6, 1, 0), (7, 1, 1), (8, 0, 0), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
