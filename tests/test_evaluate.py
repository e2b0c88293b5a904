from __future__ import annotations

from arrears.operators import evaluate


def test_every_class_is_counted(spark):
    rows = [(0.0, 0.0), (1.0, 2.0), (2.0, 2.0), (None, 1.0), (2.0, None)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = {(r["label"], r["prediction"]): r["n"] for r in evaluate.confusion(df).collect()}
    assert len(got) == 16 and sum(got.values()) == 5
    assert got[1.0, 2.0] == got[None, 1.0] == got[2.0, None] == 1 and got[1.0, 0.0] == 0
    binary = {(r["label"], r["prediction"]): r["n"] for r in evaluate.confusion(df.limit(0)).collect()}
    assert binary == {(a, b): 0 for a in (0.0, 1.0) for b in (0.0, 1.0)}
    assert evaluate.confusion(df, (0.0, 2.0)).count() == 4


def test_missing_scores_are_left_out_and_counted(spark):
    rows = [(1.0, 0.9), (0.0, 0.4), (1.0, 0.6), (0.0, 0.7), (1.0, float("nan")), (0.0, None)]
    df = spark.createDataFrame(rows, "label double, score double")
    assert evaluate.roc_auc(df).first()["auc"] == 0.75
    assert evaluate.roc_points(df).count() == 5 and evaluate.pr_points(df).count() == 5
    assert evaluate.unscored(df).first().asDict() == {"rows": 6, "unscored": 2}
