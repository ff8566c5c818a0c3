import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

from gaugeline.llm.common import share_package  # noqa: E402

TABLES = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def texts(spark):
    """A frame of (doc_id, text) rows with columns whose names operators use inside."""
    share_package(spark)

    def build(rows):
        extra = ", id string, n int, fp string, word string, `a.b` int"
        values = [(*row, "x", 1, "y", "z", 2) for row in rows]
        return spark.createDataFrame(values, "doc_id bigint, text string" + extra)

    return build
