import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(os.path.dirname(HERE))]

SMALL = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(rows):
        full = [(*row, *(None,) * (4 - len(row)), len(row[1]) if row[1] is not None else None) for row in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def small_tables(spark):
    if not os.path.isdir(SMALL):
        pytest.skip("given tables are not here")
    return lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet")
