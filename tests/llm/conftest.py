import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fixtures_llm import ROWS, frame  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty, repeated and very long texts, and columns with clashing names."""
    return frame(spark, ROWS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}
