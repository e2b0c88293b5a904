from __future__ import annotations

import pytest
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, owner int, `a b` int"


@pytest.fixture(scope="session")
def make(spark):
    """Documents out of (doc_id, text, source) with extra columns whose names operators use themselves."""

    def of(*rows, repeat=()):
        full = [(i, t, "en", s, None if t is None else len(t), "x", 1, 2) for i, t, s in [*rows, *repeat]]
        return spark.createDataFrame(full, COLUMNS).repartition(3, F.col("doc_id"))

    return of


@pytest.fixture(scope="session")
def small(spark, folder):
    """The whole documents of the smallest tables."""
    return spark.read.parquet(f"{folder}/documents.parquet")
