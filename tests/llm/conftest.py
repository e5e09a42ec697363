from __future__ import annotations

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Builds a documents table; texts only, or (doc_id, text)."""

    def build(*texts):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], DOC)

    return build
