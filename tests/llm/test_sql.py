"""Every operator that SQL can express returns what the SQL returns."""

from __future__ import annotations

import check
import pytest

from arrears.llm import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_as_sql(spark, folder, duck, name):
    assert check.difference(catalog.QUERIES[name](spark, folder), duck, catalog.ORACLES[name]) is None


def test_every_operator_is_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in catalog.QUERIES) == list(range(1, 14))
