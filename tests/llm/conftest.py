import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def sf():
    return SF


@pytest.fixture()
def make_docs(spark):
    """documents-like rows from (doc_id, text) pairs over several partitions,
    with extra columns whose names clash with operator outputs."""
    def build(rows, parts=3):
        full = [(i, t, "en", "s", i, "x", "x") for i, t in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, part long, size string, "
                  "length string").repartition(parts)
    return build
