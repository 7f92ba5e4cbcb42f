from __future__ import annotations

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents of (id, text) or (id, text, source), with columns that clash with results."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        clash = ["size", "kept", "score", "slot", "_key", "bucket", "target", "content", "start", "row_key"]
        docs = spark.createDataFrame(full, DOCS)
        return docs.withColumns({c: F.lit("clash") for c in clash})

    return make
