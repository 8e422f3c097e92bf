from __future__ import annotations

import pytest


@pytest.fixture
def store(spark):
    from harrow.llm.store import Store

    return Store(spark, "test")


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    def make(texts, **columns):
        rows = [(i, t) if not isinstance(t, tuple) else t for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string")

    return make
