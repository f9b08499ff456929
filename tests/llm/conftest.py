import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def documents(spark):
    """A document table with a column more than usual, whose name operators use inside."""

    def made(rows):
        full = [(i, text, lang, source, len(text or ""), "own") for i, text, lang, source in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, component_id string"
        return spark.createDataFrame(full, schema)

    return made
