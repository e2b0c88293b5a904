"""From a labelled table to a registered, saved champion.

``run`` is what a user starts: feature hook, label, clean rows, stratified
split and folds, searches of several kinds of models with preparation and
balancing inside every fold, choice of the champion on the folds, figures of
the test part, saved model and registry entries.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    GBTClassificationModel,
    LogisticRegressionModel,
    RandomForestClassificationModel,
)
from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.functions.labels import encode_label
from arrears.operators import evaluate, prepare, runs, sampling, smote, train
from arrears.operators.balance import balance_random
from arrears.operators.shaping import apply_features, columns_by_type, drop_incomplete, require_columns
from arrears.sources.tables import stage

BALANCING = ("smote", "undersample", "oversample", "none")


@dataclass
class Outcome:
    champion: str
    params: dict
    fold_scores: dict[str, float]
    preparation: PipelineModel
    model: Model
    scored: DataFrame
    run_id: str | None
    left_out: dict[str, int]  # rows without a known label, and other rows with a missing value
    unused: list[str]  # columns of types that are no features

    def score(self, df: DataFrame) -> DataFrame:
        """Predictions for new rows, prepared as the train part was."""
        return self.model.transform(self.preparation.transform(df))


KINDS = (LogisticRegressionModel, DecisionTreeClassificationModel, RandomForestClassificationModel, GBTClassificationModel)


def load_champion(spark: SparkSession, folder: str) -> Model:
    """The model that ``run`` saved below its output folder, of the kind its metadata names."""
    path = f"{folder}/model"
    named = json.loads(spark.read.text(f"{path}/metadata").first()[0])["class"].rsplit(".", 1)[-1]
    for kind in KINDS:
        if kind.__name__ == named:
            return kind.load(path)
    raise ValueError(f"{path} holds a {named}, which is no known model")


def _balanced(df: DataFrame, how: str, key: str) -> DataFrame:
    if how == "none":
        return df.select("label", "features")
    narrow = df.select(key, "label", "features")
    even = smote.smote(narrow, key) if how == "smote" else balance_random(narrow, "label", [key], how)
    return even.select("label", "features")


def run(
    df: DataFrame,
    key: str,
    target: str,
    numeric: Sequence[str] | None = None,
    text: Sequence[str] | None = None,
    exclude: Iterable[str] = (),
    hook: Callable[[DataFrame], DataFrame] | None = None,
    test_share: float = 0.3,
    balancing: str = "smote",
    folds: int = 5,
    logistic_grid: Mapping[str, Sequence] = train.LOGISTIC_GRID,
    tree_grid: Mapping[str, Sequence] = train.TREE_GRID,
    families: Sequence | None = None,
    scorer: Evaluator | None = None,
    impute: bool = False,
    encoding: str = "one_hot",
    unknown: str = "null",
    output: str | None = None,
    experiment: str = "default",
) -> Outcome:
    """Train, compare and register; columns not named are taken by type.

    ``families`` are the searches to run (``train.Logistic``, ``Tree``, ``Forest``, ``Boosting``), by default the first
    two with the given grids; ``scorer`` compares them on the folds, by default F1 of class 1. With ``impute`` missing
    numbers and texts are filled from the training rows; without it, rows that miss any are left out.
    """
    if balancing not in BALANCING:
        raise ValueError(f"balancing must be one of {BALANCING}")
    require_columns(df, key, target)
    found_numeric, found_text = columns_by_type(df, {key, target, *exclude})
    unused = [c for c in df.columns if c not in {key, target, *exclude, *found_numeric, *found_text}]
    numeric = list(found_numeric if numeric is None else numeric)
    text = list(found_text if text is None else text)
    shaped = apply_features(df, hook)
    label = encode_label(target, unknown) if dict(shaped.dtypes)[target] == "string" else F.col(target).cast("double")
    labelled = shaped.select(key, *numeric, *text, label.alias("label"))
    complete = labelled.filter(F.col("label").isNotNull()) if impute else drop_incomplete(labelled)
    counts = labelled.agg(
        F.count_if(F.col("label").isNull()).alias("rows_unknown_label"), F.count(F.lit(1)).alias("rows")
    ).first()
    table = stage(sampling.split_stratified(complete, "label", [key], test_share), "split", [key])

    test = table.filter("is_test")
    folded = stage(sampling.stratified_folds(table.filter(~F.col("is_test")), "label", [key], folds), "folds", [key])
    steps = prepare.feature_preparation(numeric, text, impute=impute, encoding=encoding)
    families = [train.Logistic(logistic_grid), train.Tree(tree_grid)] if families is None else list(families)
    searches = train.search_families(
        folded, families, folds, scorer or train.f1_scorer(), steps, lambda part: _balanced(part, balancing, key)
    )
    name = max(searches, key=lambda n: searches[n].best_score)  # the first one wins a tie
    whole = searches[name]
    preparation = PipelineModel(stages=whole.model.stages[:-1])
    best = train.Search(whole.best_params, whole.best_score, whole.model.stages[-1], whole.table)
    scored = best.model.transform(preparation.transform(test))
    left_out = {
        "rows_unknown_label": counts["rows_unknown_label"],
        "rows_incomplete": counts["rows"] - counts["rows_unknown_label"] - table.count(),
    }
    run_id = _keep(output, experiment, name, best, searches, preparation, scored, left_out) if output else None
    return Outcome(
        name, best.best_params, {n: s.best_score for n, s in searches.items()}, preparation, best.model, scored, run_id,
        left_out, unused,
    )


def _keep(output, experiment, name, best, searches, preparation, scored, left_out) -> str:
    """Model, preparation and report below ``output``; figures in the registry."""
    spark = scored.sparkSession
    figures = evaluate.weighted_metrics(scored)
    rate = evaluate.hit_rate(scored).first()["hit_rate"]
    named = figures.first().asDict()
    names = prepare.feature_names(scored)
    paths = {n: f"{output}/{n}" for n in ("preparation", "model", "report")}
    preparation.write().overwrite().save(paths["preparation"])
    best.model.write().overwrite().save(paths["model"])
    runs.report(
        spark, best.model, names, figures, evaluate.class_report(scored), evaluate.confusion(scored), best.best_params
    ).write.mode("overwrite").parquet(paths["report"])
    registry = runs.RunRegistry(spark, f"{output}/registry")
    for other, search in searches.items():
        registry.log_search(other, search, experiment)
    return registry.log(f"champion:{name}", best.best_params, {**named, "hit_rate": rate, **left_out}, paths, experiment)
