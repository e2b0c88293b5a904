from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F

from arrears import __main__ as commands
from arrears.operators import prepare, train
from arrears.plans import workflow
from arrears.plans.model_table import model_table


def test_ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with zipfile.ZipFile(tmp_path / "in" / "2023T1_a_FGTS.zip", "w") as z:
        z.writestr("a.csv", "CPF_CNPJ;TIPO_PESSOA\n1;J\n2;F\n")
        z.writestr("b.csv", "")
    with zipfile.ZipFile(tmp_path / "in" / "2023T2_b_FGTS.zip", "w") as z:
        z.writestr("locked.csv", "CPF_CNPJ;TIPO_PESSOA\n3;J\n")
    locked = (tmp_path / "in" / "2023T2_b_FGTS.zip").read_bytes()
    for mark, at in ((b"PK\x03\x04", 6), (b"PK\x01\x02", 8)):  # the flags in the local and the central header
        place = locked.index(mark) + at
        locked = locked[:place] + bytes([locked[place] | 1]) + locked[place + 1 :]
    (tmp_path / "in" / "2023T2_b_FGTS.zip").write_bytes(locked)
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    commands.ingest(spark, commands.parser().parse_args(["ingest", str(tmp_path / "in"), out, bad]))
    assert [(r["CNPJ"], r["ORIGEM"]) for r in spark.read.parquet(out).collect()] == [("1".zfill(14), "FGTS")]
    assert sorted((r["member"], r["problem"]) for r in spark.read.parquet(bad).collect()) == [("b.csv", "empty"), ("locked.csv", "encrypted")]


@pytest.mark.parametrize("grids", [({"C": [1.0]}, {}), ({}, {"max_depth": [5], "min_samples_split": [20], "min_samples_leaf": [5]})])
def test_train_then_score(spark, folder, tmp_path, monkeypatch, grids):
    table, model, scores = (str(tmp_path / n) for n in ("table", "model", "scores"))
    model_table(spark, folder).withColumn("valor", F.lit(1).cast("decimal(18,2)")).withColumn("dia", F.current_date()).write.parquet(table)
    whole = workflow.run
    small = {"logistic_grid": grids[0] or {"C": [1e-9]}, "tree_grid": grids[1] or {"max_depth": [0], "min_samples_split": [2], "min_samples_leaf": [1]}}
    seen = {}

    def run(*a, **k):
        seen["outcome"] = whole(*a, **k, **small)
        return seen["outcome"]

    monkeypatch.setattr(workflow, "run", run)
    parse = commands.parser().parse_args
    commands.train(spark, parse(["train", table, model, "--balancing", "none", "--folds", "2"]))
    outcome = seen["outcome"]
    assert outcome.champion == ("logistic_regression" if grids[0] else "decision_tree")
    assert outcome.unused == ["dia"] and outcome.left_out == {"rows_unknown_label": 0, "rows_incomplete": 0}
    commands.score(spark, parse(["score", model, table, scores]))
    rows = spark.read.parquet(scores)
    assert rows.count() == 1500
    want = outcome.score(spark.read.parquet(table)).select("numero_inscricao", F.col("prediction").alias("p"))
    assert rows.join(want, "numero_inscricao").filter("prediction = p").count() == 1500


def test_run_fills_and_balances_inside_folds(spark, folder, tmp_path):
    """Missing values stay in the run when they are filled; each fold's rows are scored as they are."""
    holes = F.when(F.col("numero_inscricao") % 5 > 0, F.col("idade_divida_dias"))
    table = model_table(spark, folder).withColumn("idade_divida_dias", holes).filter("numero_inscricao % 3 = 0")
    outcome = workflow.run(
        table, "numero_inscricao", "target", balancing="undersample", folds=2, impute=True, encoding="ordinal",
        families=[train.Forest({"n_estimators": [2, 4], "max_depth": [3]}), train.Logistic({"C": [1.0]})],
        scorer=train.auc_scorer(), output=str(tmp_path / "out"),
    )
    assert outcome.left_out == {"rows_unknown_label": 0, "rows_incomplete": 0}
    assert set(outcome.fold_scores) == {"random_forest", "logistic_regression"} and min(outcome.fold_scores.values()) > 0.6
    loaded = workflow.load_champion(spark, str(tmp_path / "out"))
    assert type(loaded) is type(outcome.model) and outcome.scored.count() > 100


def test_many_categories(spark):
    rows = spark.range(120_000).select(F.col("id"), F.concat(F.lit("c"), F.col("id")).alias("c"))
    codes = prepare.category_codes(rows, "c")
    assert codes.agg(F.min("code"), F.max("code"), F.count_distinct("code")).first() == (0, 119_999, 120_000)
    first = codes.orderBy("value").limit(3).collect()
    assert [r["code"] for r in first] == [0, 1, 2]
    odd = rows.limit(5).unionByName(spark.createDataFrame([(-1, "new"), (-2, None)], "id long, c string"))
    got = {r["id"]: r["k"] for r in prepare.join_codes(odd, "c", codes, "k", ["id"]).collect()}
    assert got[-1] == got[-2] == -1.0 and all(got[i] >= 0 for i in got if i >= 0)
    hot = {r["id"]: r["k"] for r in prepare.join_codes(odd, "c", codes, "k", ["id"], one_hot=True).collect()}
    assert all(v.size == 120_000 and list(v.indices) == ([int(got[i])] if got[i] >= 0 else []) for i, v in hot.items())


def test_many_categories_in_a_saved_preparation(spark, tmp_path, monkeypatch):
    """Encoders give the same with lists and with tables, before and after saving."""
    texts = ["b", "a", None, "d`x", " ", "a", "é", "b"]
    rows = spark.createDataFrame([(k, t, float(k), f"n{k % 2}") for k, t in enumerate(texts)], "id long, c string, x double, few string")
    new = rows.unionByName(spark.createDataFrame([(9, "unseen", 1.0, "n0"), (10, None, 2.0, None)], rows.schema))
    for encoding in ("one_hot", "ordinal", "categorise"):
        got = []
        for most in (100, 1):
            monkeypatch.setattr(prepare, "MOST_CATEGORIES", most)
            model = prepare.fit_preparation(rows, ["x"], ["c", "few"], encoding=encoding)
            path = str(tmp_path / f"{encoding}{most}")
            model.write().save(path)
            for m in (model,) if most == 100 else (model, prepare.PipelineModel.load(path)):
                done = m.transform(new)
                assert len(prepare.feature_names(done)) == done.first()["features"].size
                got.append({r["id"]: tuple(r["features"].toArray()) for r in done.collect()})
        assert all(g == got[0] for g in got) and len(got[0]) == 10
    empty = rows.withColumn("few", F.lit(""))  # no name for a slot, so its index is a table
    assert prepare.fit_preparation(empty, ["x"], ["few"]).transform(empty).first()["features"].size == 2


def test_run_with_many_categories(spark, folder, tmp_path):
    own = F.concat(F.lit("c"), F.col("numero_inscricao").cast("string"))
    table = model_table(spark, folder).withColumn("own", own)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(prepare, "MOST_CATEGORIES", 500)
        outcome = workflow.run(
            table, "numero_inscricao", "target", balancing="none", folds=2, encoding="ordinal",
            families=[train.Tree({"max_depth": [3], "min_samples_split": [2], "min_samples_leaf": [1]})], output=str(tmp_path / "out"),
        )
    loaded = prepare.PipelineModel.load(str(tmp_path / "out" / "preparation"))
    want = {r[0]: r[1] for r in outcome.preparation.transform(table).select("numero_inscricao", "own__code").collect()}
    got = {r[0]: r[1] for r in loaded.transform(table).select("numero_inscricao", "own__code").collect()}
    assert got == want and max(got.values()) > 500 and min(got.values()) == -1.0


def test_wide_index_of_150_000_texts(spark):
    rows = spark.range(150_000).select("id", F.concat(F.lit("c"), F.col("id")).alias("c"))
    model = prepare.OrdinalCoder(["c"], ["code"]).fit(rows)
    coded = model.transform(rows)
    assert coded.agg(F.min("code"), F.max("code"), F.count_distinct("code")).first() == (0.0, 149_999.0, 150_000)
