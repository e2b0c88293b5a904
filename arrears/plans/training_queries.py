"""Training, search, scoring and registering on the model table."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.functions.labels import encode_label
from arrears.operators import evaluate, prepare, runs, sampling, train
from arrears.operators.joins import join_spread
from arrears.operators.shaping import drop_incomplete
from arrears.plans.evaluation_queries import SCORED_SQL, scored
from arrears.plans.model_table import (
    CATEGORICAL,
    KEY,
    LABELLED_SQL,
    MODEL_SQL,
    NUMERIC,
    companies,
    debts,
    model_table,
)
from arrears.plans import workflow
from arrears.plans.registry import query
from arrears.plans.sampling_queries import SPLIT_SQL
from arrears.session import fresh_path
from arrears.sources.tables import bounded, stage


def split_model_table(spark, folder) -> DataFrame:
    """The model table with label and ``is_test``, written once to be read by many fits.

    The split needs key and label only, so it is made before the joins.
    """
    own = debts(spark, folder).withColumn("label", encode_label("target"))
    flagged = sampling.split_stratified(own, "label", [KEY])
    registry = companies(spark, folder).withColumnRenamed("cd_cnpj", "cpf_cnpj")
    joined = join_spread(flagged, registry, ["cpf_cnpj"], [KEY], "inner")  # a debtor may own many debts
    complete = drop_incomplete(joined.select(KEY, *NUMERIC, *CATEGORICAL, "label", "is_test"))
    return stage(complete, "model_table", [KEY])


def prepared(spark, folder):
    """(train, test, preparation): features fitted on the train part."""
    df = split_model_table(spark, folder)
    fitted = prepare.fit_preparation(df.filter(~F.col("is_test")), NUMERIC, CATEGORICAL)
    wide = fitted.transform(df).select(KEY, "label", "features", "is_test")
    return wide.filter(~F.col("is_test")), wide.filter("is_test"), fitted


def flagship(spark, folder) -> DataFrame:
    """Label, clean, split, prepare, train, score: weighted metrics of the test part."""
    return evaluate.weighted_metrics(_fitted_logistic(spark, folder)[1])


def _fitted_logistic(spark, folder):
    fit_part, test, preparation = prepared(spark, folder)
    fit_part.persist(StorageLevel.MEMORY_AND_DISK)
    model = train.logistic(fit_part.count()).fit(fit_part)
    fit_part.unpersist()
    return model, model.transform(test), preparation, test


def _scores(df: DataFrame) -> DataFrame:
    return train.positive_probability(df).select(KEY, "label", "prediction", F.round("score", 6).alias("score"))


TEST_SQL = f"WITH {LABELLED_SQL}, {SPLIT_SQL} SELECT numero_inscricao, label, true AS sound FROM split WHERE is_test"


def sound(scores: DataFrame) -> DataFrame:
    """Key, label, and whether score and prediction are well formed and agree."""
    said = F.when(F.col("score") == 0.5, F.col("prediction")).otherwise((F.col("score") > 0.5).cast("double"))
    fine = F.col("score").between(0.0, 1.0) & (F.col("prediction") == said)
    return scores.select(KEY, "label", F.coalesce(fine, F.lit(False)).alias("sound"))


def above_majority(figures: DataFrame, test: DataFrame, names) -> DataFrame:
    """(metric, above): whether each figure is above the share of the largest class of the test part."""
    share = test.groupBy("label").count().agg(F.max("count") / F.sum("count")).first()[0]
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), (F.col(n) > share).alias("above")) for n in names])
    return figures.select(F.inline(rows))


def _metrics_sql(names) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"('{n}', true)" for n in names) + ") v(metric, above)"


WEIGHTED = ("accuracy", "precision", "recall", "f1")


@query("flagship", _metrics_sql(WEIGHTED))
def flagship_query(spark, folder):
    """Each weighted metric against the majority share; ``flagship`` has the figures."""
    _, scored_test, _, test = _fitted_logistic(spark, folder)
    return above_majority(evaluate.weighted_metrics(scored_test), test, WEIGHTED)


def lr_scores(spark, folder):
    return _scores(_fitted_logistic(spark, folder)[1])


def _fit_and_score(spark, folder, estimator):
    fit_part, test, _ = prepared(spark, folder)
    fit_part = bounded(fit_part, [KEY]).persist(StorageLevel.MEMORY_AND_DISK)
    model = estimator.fit(fit_part)
    fit_part.unpersist()
    return _scores(model.transform(test))


def dt_scores(spark, folder):
    return _fit_and_score(spark, folder, train.decision_tree(10, 5))


def rf_scores(spark, folder):
    return _fit_and_score(spark, folder, train.random_forest(100, 5))


def gbt_scores(spark, folder):
    fit_part, test, _ = prepared(spark, folder)
    weighted = train.copies(fit_part).persist(StorageLevel.MEMORY_AND_DISK)  # no row is drawn, so equal ones are fitted as one
    model = train.gradient_boosting(100, 0.1, 3, weightCol="weight").fit(weighted)
    weighted.unpersist()
    return _scores(model.transform(test))


@query("train_lr", TEST_SQL)
def train_lr(spark, folder):
    return sound(lr_scores(spark, folder))


@query("train_dt", TEST_SQL)
def train_dt(spark, folder):
    return sound(dt_scores(spark, folder))


@query("train_rf", TEST_SQL)
def train_rf(spark, folder):
    return sound(rf_scores(spark, folder))


@query("train_gbt", TEST_SQL)
def train_gbt(spark, folder):
    return sound(gbt_scores(spark, folder))


def _folded(spark, folder, k):
    fit_part, test, preparation = prepared(spark, folder)
    return stage(sampling.stratified_folds(fit_part, "label", [KEY], k), "folds", [KEY]), test, preparation


def ranked(found: train.Search, spark) -> DataFrame:
    """Each point with its parameters, and whether its rank is that of its mean score."""
    table = found.results(spark)
    better = table.select(F.col("mean_score").alias("other"))
    # one row per point of the grid on either side
    places = table.join(better, F.col("other") > F.col("mean_score"), "left").groupBy("point", "params", "rank").agg(
        F.count("other").alias("n")
    )
    return places.select("point", "params", (F.col("rank") == F.col("n") + 1).alias("rank_agrees"))


def _grid_sql(points) -> str:
    rows = ", ".join(f"({i}, '{str(p).replace(chr(39), 2 * chr(39))}', true)" for i, p in enumerate(points))
    return f"SELECT * FROM (VALUES {rows}) v(point, params, rank_agrees)"


@query("grid_lr", _grid_sql(train.points(train.LOGISTIC_GRID)))
def grid_lr(spark, folder):
    """Both penalties, eight strengths, five folds, F1 of class 1."""
    df, _, _ = _folded(spark, folder, 5)
    return ranked(train.search_logistic(df, train.LOGISTIC_GRID, 5), spark)


@query("grid_lr_solver", _grid_sql(train.points(train.LOGISTIC_SOLVER_GRID)))
def grid_lr_solver(spark, folder):
    """Strength, iterations and tolerance by weighted F1, three folds."""
    df, _, _ = _folded(spark, folder, 3)
    return ranked(train.search_logistic(df, train.LOGISTIC_SOLVER_GRID, 3, train.weighted_f1_scorer()), spark)


@query("grid_dt", _grid_sql(train.tree_points(train.TREE_GRID)))
def grid_dt(spark, folder):
    """Depths, split sizes and leaf sizes, five folds, from one tree per fold and leaf size."""
    df, _, _ = _folded(spark, folder, 5)
    return ranked(train.search_tree(df, train.TREE_GRID, 5), spark)


@query("grid_prepared", _grid_sql(train.points(train.LOGISTIC_AUC_GRID)))
def grid_prepared(spark, folder):
    """Imputing, scaling and encoding refitted inside every fold, scored by ROC AUC."""
    df = split_model_table(spark, folder).filter(~F.col("is_test"))
    folded = stage(sampling.stratified_folds(df, "label", [KEY], 3), "folds", [KEY])
    steps = prepare.feature_preparation(NUMERIC, CATEGORICAL, impute=True)
    return ranked(train.search_logistic(folded, train.LOGISTIC_AUC_GRID, 3, train.auc_scorer(), preparation=steps), spark)


@query("random_search_lr", _grid_sql(train.random_points(20)))
def random_search_lr(spark, folder):
    df, _, _ = prepared(spark, folder)
    return ranked(train.random_search_logistic(df, [KEY], trials=20), spark)


@query("grid_results", _grid_sql(train.points(train.FOREST_GRID)))
def grid_results(spark, folder):
    """Result table of a forest search: trees and depths, three folds, ROC AUC, from one forest per depth and fold."""
    df, _, _ = _folded(spark, folder, 3)
    return ranked(train.search_forest(df, train.FOREST_GRID, 3), spark)


PIPELINE = [train.Logistic(train.LOGISTIC_AUC_GRID), train.Forest(train.FOREST_GRID)]


def _family_sql(families) -> str:
    rows = ", ".join(
        f"('{f.name}', {i}, '{str(p).replace(chr(39), 2 * chr(39))}', true)" for f in families for i, p in enumerate(f.points)
    )
    return f"SELECT * FROM (VALUES {rows}) v(name, point, params, rank_agrees)"


@query("grid_pipeline", _family_sql(PIPELINE))
def grid_pipeline(spark, folder):
    """Several kinds of models by ROC AUC; imputing, scaling and encoding are fitted once in each of three folds."""
    df = split_model_table(spark, folder).filter(~F.col("is_test"))
    folded = stage(sampling.stratified_folds(df, "label", [KEY], 3), "folds", [KEY])
    steps = prepare.feature_preparation(NUMERIC, CATEGORICAL, impute=True)
    found = train.search_families(folded, PIPELINE, 3, train.auc_scorer(), steps)
    parts = [ranked(search, spark).select(F.lit(name).alias("name"), "point", "params", "rank_agrees") for name, search in found.items()]
    return parts[0].unionByName(parts[1])


def champion_scores(spark, folder):
    """Logistic regression against a tree, whole grids, by F1 of class 1 on held-out rows: (name, score)."""
    df, test, _ = _folded(spark, folder, 3)
    found = [
        ("logistic_regression", train.search_logistic(df, train.LOGISTIC_GRID, 3)),
        ("decision_tree", train.search_tree(df, train.TREE_GRID, 3)),
    ]
    scores = None
    for place, (name, search) in enumerate(found):
        row = evaluate.binary_metrics(search.model.transform(test)).select(
            F.lit(name).alias("name"), F.lit(place).alias("place"), F.col("f1").alias("score"),
            F.lit(search.best_score).alias("fold_score"),
        )
        scores = row if scores is None else scores.unionByName(row)
    best = evaluate.champion(scores, score="fold_score").drop("fold_score")  # chosen on folds, reported on test
    return best.join(scores, "name").select("name", (F.col("score") * 100).alias("score")), test


@query("model_champion", _metrics_sql(["score"]))
def model_champion(spark, folder):
    best, test = champion_scores(spark, folder)
    return above_majority(best.select((F.col("score") / 100).alias("score")), test, ["score"])


def full_run_figures(spark, folder):
    """The whole way from labelled table to registered champion, with small grids: (champion, key, value)."""
    output = fresh_path(spark, "full_run")
    outcome = workflow.run(
        model_table(spark, folder),
        KEY,
        "target",
        folds=3,
        logistic_grid={"penalty": ["l2"], "C": [1, 100]},
        tree_grid={"max_depth": [10], "min_samples_split": [2, 20], "min_samples_leaf": [5]},
        output=output,
    )
    metrics = runs.RunRegistry(spark, f"{output}/registry").table("metrics").filter(F.col("run_id") == outcome.run_id)
    return metrics.select(F.lit(outcome.champion).alias("champion"), "key", "value")


LOGGED = ("accuracy", "precision", "recall", "f1", "hit_rate", "rows_unknown_label", "rows_incomplete")


@query(
    "full_run",
    "SELECT * FROM (VALUES " + ", ".join(f"('{k}', true)" for k in LOGGED) + ") v(key, fine)",
)
def full_run(spark, folder):
    """The logged figures: metrics above seven tenths, no row left out."""
    found = full_run_figures(spark, folder)
    rows = F.startswith(F.col("key"), F.lit("rows_"))
    return found.select("key", F.when(rows, F.col("value") == 0).otherwise(F.col("value") > 0.7).alias("fine"))


def importance_rows(spark, folder):
    model, _, _, test = _fitted_logistic(spark, folder)
    return train.importance_table(spark, model, prepare.feature_names(test))


@query(
    "feature_importance",
    f"""WITH {MODEL_SQL}, {SPLIT_SQL}, fit AS (SELECT model.* FROM model JOIN split USING (numero_inscricao) WHERE NOT is_test)
        SELECT 'idade_divida_dias' AS feature, true AS finite """
    + " ".join(f"UNION SELECT '{c}_' || {c}, true FROM fit" for c in CATEGORICAL),
)
def feature_importance(spark, folder):
    """The slots, and that each has a finite coefficient."""
    value = F.col("importance")
    return importance_rows(spark, folder).select("feature", (~F.isnan(value) & (F.abs(value) < float("inf"))).alias("finite"))


def report_rows(spark, folder):
    model, scored_test, _, test = _fitted_logistic(spark, folder)
    return runs.report(
        spark, model, prepare.feature_names(test), evaluate.weighted_metrics(scored_test),
        evaluate.class_report(scored_test), evaluate.confusion(scored_test),
    )


@query(
    "model_report",
    f"""WITH {LABELLED_SQL}, {SPLIT_SQL} SELECT section, CASE WHEN section = 'confusion_matrix' THEN n END AS rows
        FROM (VALUES ('metrics'), ('confusion_matrix'), ('classes'), ('params'), ('importance')) v(section),
             (SELECT count(*) AS n FROM split WHERE is_test)""",
)
def model_report(spark, folder):
    """The sections of the report, and the rows in its confusion matrix."""
    counted = F.when(F.col("section") == "confusion_matrix", F.col("value").cast("bigint"))
    return report_rows(spark, folder).groupBy("section").agg(F.sum(counted).alias("rows"))


def batch_scores(spark, folder):
    """Save preparation and model as one, load it, score the whole model table."""
    model, _, preparation, _ = _fitted_logistic(spark, folder)
    path = fresh_path(spark, "scoring_model")
    PipelineModel(stages=[*preparation.stages, model]).write().overwrite().save(path)
    return _scores(PipelineModel.load(path).transform(model_table(spark, folder).withColumn("label", encode_label("target"))))


@query("batch_score", f"WITH {LABELLED_SQL} SELECT numero_inscricao, label, true AS sound FROM labelled")
def batch_score(spark, folder):
    return sound(batch_scores(spark, folder))


@query(
    "run_registry",
    f"""WITH {SCORED_SQL}, m AS (SELECT round((tp + tn) / n, 6) AS accuracy, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM counts)
        SELECT 'rule' AS run_name, NULL AS parent_name, 'accuracy' AS key, accuracy AS value FROM m
        UNION ALL SELECT 'rule', NULL, 'f1', f1 FROM m
        UNION ALL SELECT 'rule_detail', 'rule', 'rows', (SELECT n FROM counts) FROM m""",
)
def run_registry(spark, folder):
    """Log a run with a run below it, then read the metrics back by name."""
    df = scored(spark, folder)
    found = evaluate.binary_metrics(df).first()
    registry = runs.RunRegistry(spark, fresh_path(spark, "registry"))
    top = registry.log("rule", {"cut": 1700}, {k: round(found[k], 6) for k in ("accuracy", "f1")})
    registry.log("rule_detail", {}, {"rows": df.count()}, parent=top)
    named = registry.table("runs")
    parents = named.select(F.col("run_id").alias("parent_run_id"), F.col("run_name").alias("parent_name"))
    return (
        named.join(registry.table("metrics"), "run_id")
        .join(parents, "parent_run_id", "left")
        .select("run_name", "parent_name", "key", "value")
    )


