"""Classifiers, parameter searches and their result tables.

Fits run as Spark jobs over the whole training frame. Points of a grid share
what they can: passes over the rows (logistic regression), trees (decision
trees, forests, boosting) and prepared folds. Rows never come to the driver.
"""

from __future__ import annotations

import itertools
import math
import random
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.operators import forest, logistic_grid
from arrears.operators.cells import Cuts, cells, centred, copies, find_cuts
from arrears.operators.tree import collapse, floored_leaves, prefix_scores, read_nodes, with_numbers
from arrears.sources.tables import stage

SEED = 42
DEEPEST = 30  # the deepest tree Spark grows
SHARE = 4  # rows of a cell, on average, from which on models of the cells are fitted first
MANY = 12  # models from which on that is worth the cells
SHALLOW = 5  # levels to which rows of a forest are led anew from the root

# The parameter grids searched by default.
LOGISTIC_GRID = {"penalty": ["l1", "l2"], "C": [0.001, 0.01, 0.1, 1, 10, 100, 500, 1000]}
LOGISTIC_SOLVER_GRID = {"C": [0.01, 0.1, 1, 10], "penalty": ["l2"], "max_iter": [100, 200], "tol": [1e-4, 1e-3]}
LOGISTIC_AUC_GRID = {"C": [0.1, 1, 10]}
TREE_GRID = {
    "max_depth": [None, 10, 20, 30],
    "min_samples_split": [2, 5, 10, 20],
    "min_samples_leaf": [1, 2, 5, 10],
}
FOREST_GRID = {"n_estimators": [100, 200], "max_depth": [5, 10]}
BOOSTING_GRID = {"n_estimators": [100, 200], "learning_rate": [0.01, 0.1], "max_depth": [3, 5]}


def points(grid: Mapping[str, Sequence]) -> list[dict]:
    names = list(grid)
    return [dict(zip(names, values)) for values in itertools.product(*grid.values())]


def logistic(
    rows: int, C: float = 1.0, penalty: str = "l2", max_iter: int = 100, tol: float = 1e-4, **columns: str
) -> LogisticRegression:
    """Logistic regression on features that are already scaled.

    The usual ``C`` weighs the summed loss, Spark's parameter the penalty on the
    mean loss: ``regParam = 1 / (C * rows)``.
    """
    if penalty not in ("l1", "l2"):
        raise ValueError("penalty must be 'l1' or 'l2'")
    return LogisticRegression(
        regParam=1.0 / (C * max(rows, 1)),
        elasticNetParam=1.0 if penalty == "l1" else 0.0,
        maxIter=max_iter,
        tol=tol,
        standardization=False,
        **columns,
    )


def tree_depth(max_depth: int | None) -> int:
    """None is the deepest tree Spark grows; a deeper one is refused."""
    if max_depth is not None and max_depth > DEEPEST:
        raise ValueError(f"max_depth must be at most {DEEPEST}")
    return DEEPEST if max_depth is None else max_depth


def decision_tree(max_depth: int | None = None, min_samples_leaf: int = 1, seed: int = SEED, **columns: str) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(
        maxDepth=tree_depth(max_depth),
        minInstancesPerNode=min_samples_leaf,
        seed=seed,
        **columns,
    )


def random_forest(n_estimators: int = 100, max_depth: int | None = None, seed: int = SEED, **columns: str) -> RandomForestClassifier:
    deep = tree_depth(max_depth)
    # deep trees: remembering where rows are costs memory, finding their way from the root at every level more time
    return RandomForestClassifier(
        numTrees=n_estimators, maxDepth=deep, seed=seed, cacheNodeIds=deep > SHALLOW, **columns
    )


def gradient_boosting(
    n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int = 3, seed: int = SEED, **columns: str
) -> GBTClassifier:
    return GBTClassifier(
        maxIter=n_estimators, stepSize=learning_rate, maxDepth=tree_depth(max_depth), seed=seed, **columns
    )


def in_order(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions, like ones next to each other.

    As text a sparse vector begins with its slots, so rows of the same categories meet, and in them those of near
    numbers. Trees lead such rows the same way, which makes the passes of a forest faster.
    """
    return df.sortWithinPartitions(F.col("features").cast("string"))


def f1_scorer(label: str = "label") -> Evaluator:
    """F1 of class 1."""
    return MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0)


def weighted_f1_scorer(label: str = "label") -> Evaluator:
    return MulticlassClassificationEvaluator(labelCol=label, metricName="f1")


def accuracy_scorer(label: str = "label") -> Evaluator:
    return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")


def auc_scorer(label: str = "label") -> Evaluator:
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")


def positive_probability(df: DataFrame, out: str = "score", probability: str = "probability") -> DataFrame:
    return df.withColumn(out, vector_to_array(probability)[1])


@dataclass
class Search:
    """What a search found. ``table`` has one entry per point of the grid."""

    best_params: dict
    best_score: float
    model: Model
    table: list[dict] = field(default_factory=list)

    def results(self, spark) -> DataFrame:
        """(point, params, mean_score, std_score, std_fit_time, rank)."""
        rows = [
            (r["point"], str(r["params"]), r["mean_score"], r["std_score"], r["std_fit_time"], r["rank"])
            for r in self.table
        ]
        return spark.createDataFrame(
            rows,
            "point int, params string, mean_score double, std_score double, std_fit_time double, rank int",
        )


def _spread(values: Sequence[float]) -> float:
    if not values:
        return 0.0
    mean = sum(values) / len(values)
    return math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))


def _results(
    grid: Sequence[dict], scores: Sequence[Sequence[float]], times: Sequence[Sequence[float]], larger: bool = True
) -> list[dict]:
    """Mean and spread per point; the best mean has rank 1, equal means share a rank."""
    means = [sum(s) / len(s) for s in scores]
    return [
        {
            "point": i,
            "params": grid[i],
            "mean_score": means[i],
            "std_score": _spread(scores[i]),
            "std_fit_time": _spread(times[i]),
            "rank": 1 + sum((m > means[i]) if larger else (m < means[i]) for m in means),
        }
        for i in range(len(grid))
    ]


def evaluate_all(predictions: DataFrame, models: int, scorer: Evaluator) -> list[float]:
    """The figure of each model from (model, label, score, prediction), and a weight where rows stand for several.

    Figures that follow from counts take one job for all models; others take one for each.
    """
    weighted = "weight" in predictions.columns
    if isinstance(scorer, MulticlassClassificationEvaluator) and scorer.getMetricName() in COUNTED:
        times = F.sum("weight").cast("long") if weighted else F.count(F.lit(1))
        counts = predictions.groupBy("model", "label", "prediction").agg(times.alias("n")).collect()
        cells: list[dict] = [{} for _ in range(models)]
        for r in counts:
            cells[r["model"]][r["label"], r["prediction"]] = r["n"]
        return [COUNTED[scorer.getMetricName()](c) for c in cells]
    shown = predictions.withColumn(scorer.getRawPredictionCol(), F.col("score")) if hasattr(scorer, "getRawPredictionCol") else predictions
    if weighted:
        scorer = scorer.copy({scorer.weightCol: "weight"})
    return [scorer.evaluate(shown.filter(F.col("model") == k)) for k in range(models)]


def _f1(cells: Mapping[tuple, int], of: float = 1.0) -> float:
    right = cells.get((of, of), 0)
    said = sum(n for (_, p), n in cells.items() if p == of)
    real = sum(n for (y, _), n in cells.items() if y == of)
    return 2.0 * right / (said + real) if said + real else 0.0


def _weighted_f1(cells: Mapping[tuple, int]) -> float:
    total = sum(cells.values())
    real = {c: sum(n for (y, _), n in cells.items() if y == c) for c in {y for y, _ in cells}}
    return sum(_f1(cells, c) * n for c, n in real.items()) / total if total else 0.0


def _accuracy(cells: Mapping[tuple, int]) -> float:
    total = sum(cells.values())
    return sum(n for (y, p), n in cells.items() if y == p) / total if total else 0.0


#: Metrics of MulticlassClassificationEvaluator that the counts of (label, prediction) give.
COUNTED = {"fMeasureByLabel": _f1, "f1": _weighted_f1, "accuracy": _accuracy}


class Logistic:
    """All points of a grid of logistic regressions, fitted side by side."""

    name = "logistic_regression"
    any_order = True  # of the rows it is fitted to

    def __init__(self, grid: Mapping[str, Sequence] = LOGISTIC_GRID):
        self.points = points(grid)

    def fit(self, df: DataFrame, point: dict) -> Model:
        return logistic(df.count(), **point).fit(df)

    def scores(self, fit_part: DataFrame, held: DataFrame, scorer: Evaluator) -> tuple[list[float], list[float]]:
        """The figure of each point on ``held``, and the seconds its fit took."""
        both = fit_part.withColumn("__fold", F.lit(0)).unionByName(held.withColumn("__fold", F.lit(1)))
        found, times = logistic_scores(both, self.points, [1], scorer, "__fold")
        return [f[0] for f in found], [t[0] for t in times]


def logistic_scores(
    df: DataFrame, grid: Sequence[dict], folds: Sequence[int], scorer: Evaluator, fold_column: str
) -> tuple[list[list[float]], list[list[float]]]:
    """Figures and seconds of each point, fold by fold; every model is fitted without its fold, all in the same passes.

    Where many models are fitted and the rows of a large table share few cells, the passes begin at the models of the cells, so that few are needed.
    """
    cuts = find_cuts(df) if len(grid) * len(folds) >= MANY else None
    coarse = None if cuts is None else cells(df, cuts, fold_column)
    data, features, sizes = logistic_grid.packed(copies(df, fold_column), fold_column, "weight")
    try:
        total = sum(sizes.values())
        problems, rows = [], []
        for p in grid:
            for f in folds:
                rows.append(max(1, total - sizes.get(f, 0)))
                one = logistic(rows[-1], **p)
                problems.append(
                    logistic_grid.Problem(f, one.getRegParam(), one.getElasticNetParam(), one.getMaxIter(), one.getTol())
                )
        near = None
        if coarse is not None and SHARE * coarse.count() <= total:
            few, width, _ = logistic_grid.packed(centred(coarse, cuts), fold_column, "weight")
            near = logistic_grid.fit_all(few, problems, rows, width) if width <= features else None
            few.unpersist()
        fitted = logistic_grid.fit_all(data, problems, rows, features, near)
        held = logistic_grid.held_out(data, problems, fitted).persist(StorageLevel.MEMORY_AND_DISK)
        found = evaluate_all(held, len(problems), scorer)
        held.unpersist()
    finally:
        data.unpersist()
    k = len(folds)
    cut = lambda values: [values[i * k : (i + 1) * k] for i in range(len(grid))]
    return cut(found), cut(fitted.seconds)


class _Ensemble:
    """Points that differ in the number of trees share a fit: the first trees of a model are a model of their own.

    So do points of a forest that differ in depth: the tops of its trees are a forest of shallower ones.
    """

    size = "n_estimators"
    tops = False  # whether depths share a fit

    def __init__(self, grid: Mapping[str, Sequence]):
        self.points = points(grid)

    def fit(self, df: DataFrame, point: dict) -> Model:
        return self.make(**point).fit(df)

    def scores(
        self, fit_part: DataFrame, held: DataFrame, scorer: Evaluator, parallelism: int = 4, grow: Callable | None = None
    ) -> tuple[list[float], list[float]]:
        """The figure of each point on ``held``, and the seconds its fit took; ``grow`` may stand in for fits to rows."""
        shared = {self.size, "max_depth"} if self.tops else {self.size}
        rest = lambda p: tuple((k, v) for k, v in p.items() if k not in shared)
        jobs = list(dict.fromkeys(map(rest, self.points)))

        def one(job: tuple) -> dict[int, tuple[float, float]]:
            mine = [i for i, p in enumerate(self.points) if rest(p) == job]
            sizes = [self.points[i][self.size] for i in mine]
            depths = [tree_depth(self.points[i].get("max_depth")) for i in mine] if self.tops else None
            largest = {self.size: max(sizes)} | ({"max_depth": max(depths)} if depths else {})
            start = time.perf_counter()
            estimator = self.make(**largest, **dict(job))
            model = grow(estimator) if grow else estimator.fit(fit_part)
            taken = time.perf_counter() - start
            said = prefix_scores(model, held, sizes, depths).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                found = evaluate_all(said, len(sizes), scorer)
            finally:
                said.unpersist()
            return {i: (f, taken) for i, f in zip(mine, found)}

        fit_part.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with ThreadPoolExecutor(parallelism) as pool:
                done = list(pool.map(inheritable_thread_target(fit_part.sparkSession)(one), jobs))
        finally:
            fit_part.unpersist()
        by_point = {i: v for part in done for i, v in part.items()}
        return [by_point[i][0] for i in range(len(self.points))], [by_point[i][1] for i in range(len(self.points))]


class Forest(_Ensemble):
    """Forests of large tables are grown on cells, as long as a task can hold them; others are fitted to rows."""

    name = "random_forest"
    any_order = True
    make = staticmethod(random_forest)
    tops = True

    def __init__(self, grid: Mapping[str, Sequence] = FOREST_GRID):
        super().__init__(grid)

    def fit(self, df: DataFrame, point: dict) -> Model:
        estimator, cuts = self.make(**point), find_cuts(df)
        known = forest.held(cells(df, cuts), cuts, raw=True) if cuts and forest.plain(estimator) else None
        return forest.grow(estimator, known) if known else estimator.fit(in_order(df))

    def scores(self, fit_part: DataFrame, held: DataFrame, scorer: Evaluator, parallelism: int = 4):
        cuts = find_cuts(fit_part)
        known = forest.held(cells(fit_part, cuts), cuts, raw=False) if cuts else None
        if known is None:
            return super().scores(in_order(fit_part), held, scorer, parallelism)
        grow = lambda estimator: forest.grow(estimator, known)
        return super().scores(fit_part, cells(held, cuts), scorer, parallelism, grow)


class Boosting(_Ensemble):
    name = "gradient_boosting"
    make = staticmethod(gradient_boosting)

    def __init__(self, grid: Mapping[str, Sequence] = BOOSTING_GRID):
        super().__init__(grid)


def search_families(
    train: DataFrame,
    families: Sequence,
    folds: int,
    scorer: Evaluator | None = None,
    preparation: Pipeline | None = None,
    balance: Callable[[DataFrame], DataFrame] | None = None,
    fold_column: str = "fold",
) -> dict[str, Search]:
    """Grid searches of several kinds of models on the same folds; ``{name: Search}``.

    For each fold ``preparation`` is fitted once on the other folds, ``balance`` makes their classes even (the rows of
    the fold itself stay as they are), and both parts are written once, all folds side by side. Then, fold by fold, all
    points of all families are fitted on them, the families side by side.
    Each family's best point is then fitted on all of ``train``; with a preparation, its model is the pipeline of both.
    """
    scorer = scorer or auc_scorer()
    scores = {f.name: [[] for _ in f.points] for f in families}
    times = {f.name: [[] for _ in f.points] for f in families}

    def prepared(fit_part: DataFrame, held: DataFrame | None):
        fitted = preparation.fit(fit_part) if preparation else None
        wide = fitted.transform(fit_part) if fitted else fit_part
        wide = (balance(wide) if balance else wide).select("label", "features")
        shown = None if held is None else (fitted.transform(held) if fitted else held).select("label", "features")
        return fitted, wide, shown

    laid = (lambda part: part) if all(getattr(f, "any_order", False) for f in families) else in_order

    def written(fold: int | None):
        if fold is None:
            fitted, whole, _ = prepared(train.drop(fold_column), None)
            return fitted, stage(laid(whole), "whole-fit")
        _, fit_part, held = prepared(train.filter(F.col(fold_column) != fold), train.filter(F.col(fold_column) == fold))
        return stage(laid(fit_part), "fold-fit"), stage(held, "fold-held")

    def refitted(family):
        table = _results(family.points, scores[family.name], times[family.name], scorer.isLargerBetter())
        best = min(table, key=lambda r: (r["rank"], r["point"]))
        model = family.fit(whole, best["params"])
        if fitted:
            model = PipelineModel(stages=[*fitted.stages, model])
        return Search(best["params"], best["mean_score"], model, table)

    # preparations are many small jobs, and so are some families: side by side they fill the cores
    beside = lambda work: inheritable_thread_target(train.sparkSession)(work)
    with ThreadPoolExecutor(min(folds, 4)) as pool:
        parts = list(pool.map(beside(written), range(folds)))
    with ThreadPoolExecutor(len(families) + 1) as pool:
        last = pool.submit(beside(written), None)
        for fit_part, held in parts:
            done = list(pool.map(beside(lambda family: family.scores(fit_part, held, scorer)), families))  # noqa: B023
            for family, (found, taken) in zip(families, done):
                for i, (s, t) in enumerate(zip(found, taken)):
                    scores[family.name][i].append(s)
                    times[family.name][i].append(t)
        fitted, whole = last.result()
        whole = whole.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return dict(zip([f.name for f in families], pool.map(beside(refitted), families)))
        finally:
            whole.unpersist()


def search_logistic(
    train: DataFrame,
    grid: Mapping[str, Sequence] = LOGISTIC_GRID,
    folds: int = 5,
    scorer: Evaluator | None = None,
    preparation: Pipeline | None = None,
    fold_column: str = "fold",
) -> Search:
    """Grid search of logistic regression, all points and folds in the same passes.

    A ``preparation`` is fitted once in every fold, and the points of a fold share their passes.
    """
    scorer = scorer or f1_scorer()
    if preparation:
        family = Logistic(grid)
        return search_families(train, [family], folds, scorer, preparation, fold_column=fold_column)[family.name]
    found, times = logistic_scores(train, points(grid), range(folds), scorer, fold_column)
    table = _results(points(grid), found, times, scorer.isLargerBetter())
    best = min(table, key=lambda r: (r["rank"], r["point"]))
    model = logistic(train.count(), **best["params"]).fit(train)
    return Search(best["params"], best["mean_score"], model, table)


def search_forest(
    train: DataFrame,
    grid: Mapping[str, Sequence] = FOREST_GRID,
    folds: int = 3,
    scorer: Evaluator | None = None,
    preparation: Pipeline | None = None,
    fold_column: str = "fold",
) -> Search:
    return search_families(train, [Forest(grid)], folds, scorer, preparation, fold_column=fold_column)[Forest.name]


def search_boosting(
    train: DataFrame,
    grid: Mapping[str, Sequence] = BOOSTING_GRID,
    folds: int = 3,
    scorer: Evaluator | None = None,
    preparation: Pipeline | None = None,
    fold_column: str = "fold",
) -> Search:
    return search_families(train, [Boosting(grid)], folds, scorer, preparation, fold_column=fold_column)[Boosting.name]


def tree_points(grid: Mapping[str, Sequence]) -> list[dict]:
    """Points with the depth really used; those that are then equal stand once."""
    named = [p | {"max_depth": tree_depth(p["max_depth"])} for p in points(grid)]
    return [p for i, p in enumerate(named) if p not in named[:i]]


class Tree:
    """All points of a grid of decision trees, from one tree for each leaf size.

    A shallower tree is the top of a deeper one, and a minimum split size only
    cuts subtrees off. Large tables are fitted as cells, the bins a tree tells
    apart anyway. So one deep tree for each leaf size answers for every
    depth and split size: held-out rows are counted once by leaf and label,
    and each point re-labels those leaves.
    """

    name = "decision_tree"
    any_order = True

    def __init__(self, grid: Mapping[str, Sequence] = TREE_GRID, seed: int = SEED):
        self.points, self.seed = tree_points(grid), seed
        self.deepest = max(p["max_depth"] for p in self.points)
        self.leaf_sizes = sorted({p["min_samples_leaf"] for p in self.points})

    def fit(self, df: DataFrame, point: dict) -> Model:
        cuts = find_cuts(df)
        return self.of_cells(cells(df, cuts), cuts, point)

    def of_cells(self, weighted: DataFrame, cuts: Cuts | None, point: dict) -> Model:
        grown = collapse(self._grow(weighted, point["max_depth"], point["min_samples_leaf"]), point["min_samples_split"])
        return with_numbers(grown, cuts)

    def _grow(self, weighted: DataFrame, max_depth: int | None, leaf_size: int) -> Model:
        """The tree of all rows, from ``cells``: a leaf's least weight stands for its least number of rows."""
        rows = weighted.agg(F.sum("weight")).first()[0] or 0.0
        share = min((leaf_size - 0.5) / rows, 0.499) if rows else 0.0
        grown = decision_tree(max_depth, 1, self.seed, leafCol="leaf", weightCol="weight", minWeightFractionPerNode=share)
        return grown.fit(weighted)

    def of_leaf_size(self, size: int, fit_part: DataFrame, held: DataFrame, scorer: Evaluator) -> tuple[dict[int, float], float]:
        """The figures of the points with that leaf size, by place in the grid, and the seconds of the fit.

        Both parts are ``cells``.
        """
        if not (isinstance(scorer, MulticlassClassificationEvaluator) and scorer.getMetricName() in COUNTED):
            raise ValueError(f"trees are compared by one of {sorted(COUNTED)}")
        start = time.perf_counter()
        model = self._grow(fit_part, self.deepest, size)
        taken = time.perf_counter() - start
        counted = (
            model.transform(held)
            .groupBy("leaf")
            .agg(
                *[F.sum(F.when(F.col("label") == y, F.col("weight")).otherwise(0.0)).cast("long").alias(n) for y, n in ((1.0, "pos"), (0.0, "neg"))]
            )
            .collect()  # at most one row per leaf of a tree the driver holds anyway
        )
        nodes = read_nodes(model)
        scores = {}
        for i, p in enumerate(self.points):
            if p["min_samples_leaf"] == size:
                said = floored_leaves(nodes, p["max_depth"], p["min_samples_split"])
                cells: dict[tuple, int] = {}
                for leaf, pos, neg in counted:
                    for y, n in ((1.0, pos), (0.0, neg)):
                        if n:
                            cells[y, said[int(leaf)]] = cells.get((y, said[int(leaf)]), 0) + n
                scores[i] = COUNTED[scorer.getMetricName()](cells)
        return scores, taken

    def scores(self, fit_part: DataFrame, held: DataFrame, scorer: Evaluator) -> tuple[list[float], list[float]]:
        cuts = find_cuts(fit_part)
        fit_part, held = cells(fit_part, cuts), cells(held, cuts)
        done = {s: self.of_leaf_size(s, fit_part, held, scorer) for s in self.leaf_sizes}
        sizes = [p["min_samples_leaf"] for p in self.points]
        return [done[s][0][i] for i, s in enumerate(sizes)], [done[s][1] for s in sizes]


def search_tree(
    train: DataFrame,
    grid: Mapping[str, Sequence] = TREE_GRID,
    folds: int = 5,
    parallelism: int = 4,
    fold_column: str = "fold",
    seed: int = SEED,
) -> Search:
    """Grid search of a decision tree by F1 of class 1; folds and leaf sizes side by side."""
    family = Tree(grid, seed)
    scorer = f1_scorer()

    def one(job: tuple[int, int]):
        fold, size = job
        return family.of_leaf_size(size, parts[fold], weighted.filter(F.col(fold_column) == fold), scorer)

    def whole(rows: DataFrame) -> DataFrame:
        """The cells of several folds, counted together."""
        summed = rows.groupBy("features", "label").agg(F.sum("weight").alias("weight"))
        return summed.persist(StorageLevel.MEMORY_AND_DISK)

    cuts = find_cuts(train)
    weighted = cells(train, cuts, fold_column).persist(StorageLevel.MEMORY_AND_DISK)
    parts = [whole(weighted.filter(F.col(fold_column) != f)) for f in range(folds)] + [whole(weighted)]
    try:
        jobs = [(f, s) for f in range(folds) for s in family.leaf_sizes]
        with ThreadPoolExecutor(parallelism) as pool:
            done = dict(zip(jobs, pool.map(inheritable_thread_target(train.sparkSession)(one), jobs)))
        sizes = [p["min_samples_leaf"] for p in family.points]
        scores = [[done[f, s][0][i] for f in range(folds)] for i, s in enumerate(sizes)]
        times = [[done[f, s][1] for f in range(folds)] for s in sizes]
        table = _results(family.points, scores, times)
        best = max(table, key=lambda r: (r["mean_score"], -r["point"]))
        model = family.of_cells(parts[-1], cuts, best["params"])
    finally:
        for part in parts:
            part.unpersist()
        weighted.unpersist()
    return Search(best["params"], best["mean_score"], model, table)


def random_points(trials: int, low: float = 1e-4, high: float = 10.0, seed: int = SEED) -> list[dict]:
    draw = random.Random(seed)
    return [{"C": math.exp(draw.uniform(math.log(low), math.log(high)))} for _ in range(trials)]


def random_search_logistic(
    train: DataFrame,
    key: Sequence[str],
    trials: int = 20,
    low: float = 1e-4,
    high: float = 10.0,
    validation_share: float = 0.2,
    seed: int = SEED,
) -> Search:
    """Log-uniform draws of C scored by accuracy on a validation part of ``train``."""
    from arrears.operators.sampling import split_random

    grid = [p | {"max_iter": 1000} for p in random_points(trials, low, high, seed)]
    parts = split_random(train, key, validation_share, seed=f"{seed}:validation", out="__held")
    parts = parts.withColumn("__held", F.col("__held").cast("int"))
    scores, times = logistic_scores(parts, grid, [1], accuracy_scorer(), "__held")
    table = _results([{"C": p["C"]} for p in grid], scores, times)
    best = max(table, key=lambda r: (r["mean_score"], -r["point"]))
    model = logistic(train.count(), best["params"]["C"], max_iter=1000).fit(train)
    return Search(best["params"], best["mean_score"], model, table)


def importances(model: Model, names: Sequence[str]) -> list[tuple[str, float]]:
    """Coefficients or tree importances with slot names, largest absolute value first."""
    last = model.stages[-1] if hasattr(model, "stages") else model
    if hasattr(last, "coefficients"):
        values = last.coefficients.toArray()
    elif hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    else:
        return []
    labelled = [(names[i] if i < len(names) else f"feature_{i}", float(v)) for i, v in enumerate(values)]
    return sorted(labelled, key=lambda p: (-abs(p[1]), p[0]))


def importance_table(spark, model: Model, names: Sequence[str]) -> DataFrame:
    rows = [(i + 1, n, v) for i, (n, v) in enumerate(importances(model, names))]
    return spark.createDataFrame(rows, "place int, feature string, importance double")
