"""Tables for the tests of the text operators."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from awkward import CLASHING, SCHEMA, awkward_rows  # noqa: E402


@pytest.fixture(scope="session")
def awkward(spark):
    """The rows above with extra columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(awkward_rows(), SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, k % 3 % 2) for k in range(30)] + [(None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
