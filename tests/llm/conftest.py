from __future__ import annotations

import pytest
from pyspark.sql import DataFrame

from shopmarts.llm.shipping import shipped

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, n_words string"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from texts or (id, text) pairs, with extra columns whose names operators use too."""
    shipped(spark)

    def make(*texts, langs=None) -> DataFrame:
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [
            (name, text, langs[i] if langs else None, "here", None if text is None else len(text), "s", "w")
            for i, (name, text) in enumerate(pairs)
        ]
        return spark.createDataFrame(rows, SCHEMA)

    return make


ODD = [None, "", " ", "\n\t", "!?", "a", "é", "x" * 50_000, "word " * 3_000, "\x00 \x1c "]
