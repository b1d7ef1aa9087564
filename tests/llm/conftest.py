"""Shared helpers of the operator tests."""

from __future__ import annotations

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, count long, node long, size string"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text, lang) with extra columns whose names clash with those that the operators use."""

    def make(rows):
        return spark.createDataFrame([(i, t, g, "s", len(t or ""), "x", 1, 2, "y") for i, t, g in rows], DOC_SCHEMA).repartition(3)

    return make
