"""Every query that has SQL must return what the SQL returns."""

from __future__ import annotations

import check
import pytest

import __spark_entry__ as entry
from arrears.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_as_sql(spark, folder, duck, name):
    assert check.difference(catalog.QUERIES[name](spark, folder), duck, catalog.ORACLES[name]) is None


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 1 and 0.8 < rows[0]["accuracy"] <= 1.0
