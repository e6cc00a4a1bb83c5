from __future__ import annotations

import pytest

DOCS = "doc_id long, text string"


@pytest.fixture
def docs_of(spark):
    """A documents table with columns whose names clash with those that operators make."""

    def make(rows, partitions: int = 3):
        df = spark.createDataFrame(rows, DOCS).repartition(partitions)
        return df.selectExpr("*", "'x' as spans", "1 as key", "2 as rank", "3 as fp", "4 as line", "5 as _key", "6 as _text")

    return make
