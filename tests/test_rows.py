"""Figures of trained models, beyond what their queries compare with SQL."""

from __future__ import annotations

import pytest

from arrears.plans import catalog, smote_queries
from arrears.plans import training_queries as t

CHECKS = {
    "flagship": (lambda s, f: t.flagship(s, f), lambda rows: len(rows) == 1 and rows[0]["accuracy"] > 0.85),
    "lr": (t.lr_scores, lambda rows: _right(rows) > 0.85),
    "dt": (t.dt_scores, lambda rows: _right(rows) > 0.85),
    "rf": (t.rf_scores, lambda rows: _right(rows) > 0.8),
    "gbt": (t.gbt_scores, lambda rows: _right(rows) > 0.85),
    "balanced": (lambda s, f: smote_queries.balanced_figures(s, f)[0], lambda rows: rows[0]["recall"] > 0.85),
    "champion": (lambda s, f: t.champion_scores(s, f)[0], lambda rows: len(rows) == 1 and rows[0]["score"] > 70),
    "importance": (t.importance_rows, lambda rows: rows[0]["feature"] == "idade_divida_dias"),
    "report": (t.report_rows, lambda rows: {r["section"] for r in rows}
               == {"metrics", "confusion_matrix", "classes", "params", "importance"}),
    "batch": (t.batch_scores, lambda rows: len(rows) == 1500 and _right(rows) > 0.85),
}


def _right(rows):
    return sum(r["label"] == r["prediction"] for r in rows) / len(rows)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_figures(spark, folder, name):
    make, holds = CHECKS[name]
    assert holds(make(spark, folder).collect())


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
