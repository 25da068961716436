import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, **ids):
        rows = [(i if not isinstance(t, tuple) else t[0], t if not isinstance(t, tuple) else t[1], "en", "s", None) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)
    return make


@pytest.fixture(scope="session")
def sample_texts():
    """Whole texts of the smallest table."""
    import pyarrow.parquet as pq
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    return dict(zip(t["doc_id"], t["text"], strict=True))
