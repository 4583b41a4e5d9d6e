import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    """The smallest documents table with only the columns that operators need, and odd rows besides."""
    if not os.path.isdir(SMALL):
        pytest.skip("driver test data not present")
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source")


@pytest.fixture(scope="session")
def odd(spark):
    """Adds rows (doc_id, text) to a documents table."""

    def add(docs, rows):
        more = [(i, t, None) for i, t in rows]
        return docs.unionByName(spark.createDataFrame(more, "doc_id long, text string, source string"))

    return add


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")
