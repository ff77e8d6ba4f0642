import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, token long, cls string, row string"


@pytest.fixture
def docs(spark):
    """Rows of (doc_id, text[, source]) as documents with extra, clashing columns."""
    def make(rows):
        return spark.createDataFrame(
            [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 7, "x", "y") for r in rows], SCHEMA)
    return make
