import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brute import ROWS, SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """A small table of odd rows with an extra column named like the operators' own."""
    from pyspark.sql import functions as F
    return spark.createDataFrame(ROWS, SCHEMA).withColumn("fp", F.lit("x")).withColumn("score", F.lit(1)) \
        .withColumn("text_sha256", F.lit("y")).withColumn("component_id", F.lit(-1)).withColumn("n_tokens", F.lit("z"))


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def rows01(spark):
    """documents of sf0.001 as a DataFrame and as a list of rows."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, df.collect()
