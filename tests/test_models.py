from __future__ import annotations

import random
import threading

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from arrears.sources import tables
from arrears.operators import cells, evaluate, forest, logistic_grid, neighbours, prepare, runs, smote, train, tree
from arrears.operators.sampling import stratified_folds


def separable(spark, n=400, seed=3):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = draw.random(), draw.random()
        label = 1.0 if x + 0.6 * y + 0.1 * draw.random() > 0.9 else 0.0
        rows.append((i, label, Vectors.dense([x - 0.5, y - 0.5])))
    return spark.createDataFrame(rows, ["id", "label", "features"])


@pytest.fixture(scope="module")
def data(spark):
    return stratified_folds(separable(spark), "label", ["id"], 3).cache()


def accuracy(df):
    return evaluate.binary_metrics(df).first()["accuracy"]


@pytest.mark.parametrize(
    "estimator",
    [
        lambda: train.logistic(400, C=100),
        lambda: train.logistic(400, C=100, penalty="l1"),
        lambda: train.decision_tree(5, 2),
        lambda: train.random_forest(10, 5),
        lambda: train.gradient_boosting(5, 0.3, 3),
    ],
)
def test_models_beat_the_majority(data, estimator):
    model = estimator().fit(data)
    majority = max(r["count"] for r in data.groupBy("label").count().collect()) / 400
    assert accuracy(model.transform(data)) > max(0.85, majority)
    assert all(np.isfinite(v) for _, v in train.importances(model, ["x", "y"]))


def test_penalty_is_checked():
    with pytest.raises(ValueError):
        train.logistic(10, penalty="l3")


def test_logistic_weighs_like_the_summed_loss():
    assert train.logistic(200, C=0.5).getRegParam() == pytest.approx(0.01)


@pytest.mark.parametrize("depth, split", [(3, 2), (30, 20), (4, 50)])
def test_floored_leaves_equal_a_smaller_tree(spark, data, depth, split):
    """Cutting a deep tree by depth gives the tree grown to that depth."""
    deep = train.decision_tree(None, 1, leafCol="leaf").fit(data)
    nodes = tree.read_nodes(deep)
    said = tree.floored_leaves(nodes, depth, split)
    rows = deep.transform(data).select("id", "leaf").collect()
    assert {int(r["leaf"]) for r in rows} <= set(range(len(said)))
    if split == 2:
        small = {r["id"]: r["prediction"] for r in train.decision_tree(depth, 1).fit(data).transform(data).collect()}
        assert {r["id"]: said[int(r["leaf"])] for r in rows} == small


def test_collapsed_tree_is_a_model_of_its_own(spark, data, tmp_path):
    deep = train.decision_tree(None, 1, leafCol="leaf").fit(data)
    said = tree.floored_leaves(tree.read_nodes(deep), 30, 40)
    cut = tree.collapse(deep, 40)
    assert cut.numNodes < deep.numNodes
    old = {r["id"]: said[int(r["leaf"])] for r in deep.transform(data).collect()}
    rows = cut.transform(data).collect()
    assert {r["id"]: r["prediction"] for r in rows} == old
    for r in rows:  # raw prediction, probability and prediction say the same
        assert abs(r["rawPrediction"][1] / sum(r["rawPrediction"]) - r["probability"][1]) < 1e-9
        assert r["prediction"] == float(r["probability"][1] > 0.5) or r["probability"][1] == 0.5
    by_raw = train.auc_scorer().evaluate(cut.transform(data))
    exact = evaluate.roc_auc(train.positive_probability(cut.transform(data)), score="score").first()["auc"]
    assert abs(by_raw - exact) < 1e-9 and by_raw < train.auc_scorer().evaluate(deep.transform(data))
    kept = {s for s, v in enumerate(cut.featureImportances.toArray()) if v > 0}
    used = {r["split"]["featureIndex"] for r in _nodes(spark, cut, tmp_path / "n").collect() if r["leftChild"] >= 0}
    assert kept <= used and list(cut.featureImportances.toArray()) != list(deep.featureImportances.toArray())
    assert runs.model_params(cut)["maxDepth"] == 30
    PipelineModel(stages=[cut]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(data)
    assert {r["id"]: r["prediction"] for r in again.collect()} == old
    assert tree.collapse(deep, 2) is deep


def _nodes(spark, model, path):
    model.write().overwrite().save(str(path))
    return spark.read.parquet(f"{path}/data")


def test_depths_are_refused_or_reported(data):
    for make in (train.decision_tree, lambda max_depth: train.random_forest(5, max_depth), lambda max_depth: train.gradient_boosting(2, 0.1, max_depth)):
        with pytest.raises(ValueError, match="at most 30"):
            make(max_depth=31)
    found = train.search_tree(data, {"max_depth": [None, 30], "min_samples_split": [2, 40], "min_samples_leaf": [5]}, 2)
    assert [r["params"]["max_depth"] for r in found.table] == [30, 30]


def test_tree_search_scores_like_separate_fits(data):
    """One point of the shared search against a plain fit per fold."""
    found = train.search_tree(data, {"max_depth": [2, None], "min_samples_split": [2], "min_samples_leaf": [1, 5]}, 3)
    scores = []
    for fold in range(3):
        model = train.decision_tree(2, 5).fit(data.filter(F.col("fold") != fold))
        scores.append(evaluate.binary_metrics(model.transform(data.filter(F.col("fold") == fold))).first()["f1"])
    entry = next(r for r in found.table if r["params"] == {"max_depth": 2, "min_samples_split": 2, "min_samples_leaf": 5})
    assert entry["mean_score"] == pytest.approx(sum(scores) / 3)
    assert sorted(r["rank"] for r in found.table)[0] == 1
    assert found.best_score == max(r["mean_score"] for r in found.table)


def test_logistic_search(spark, data):
    found = train.search_logistic(data, {"penalty": ["l1", "l2"], "C": [0.001, 100]}, 3)
    assert found.best_params["C"] == 100
    rows = found.results(spark).collect()
    assert len(rows) == 4 and {r["rank"] for r in rows} >= {1} and all(r["std_fit_time"] >= 0 for r in rows)


def test_preparation_is_refitted_in_every_fold(spark):
    rows = [(i, float(i % 2), float(i % 2) * 5 + i % 3 if i % 11 else None, "ab"[i % 2] if i % 7 else None) for i in range(90)]
    df = spark.createDataFrame(rows, "id int, label double, n double, t string")
    folded = stratified_folds(df, "label", ["id"], 3)
    steps = prepare.feature_preparation(["n"], ["t"], impute=True)
    found = train.search_logistic(folded, {"C": [1]}, 3, train.auc_scorer(), preparation=steps)
    assert found.best_score > 0.95
    assert len(found.model.stages) == len(steps.getStages()) + 1


def test_random_search_is_reproducible(data):
    one = train.random_search_logistic(data.select("id", "label", "features"), ["id"], trials=3)
    two = train.random_search_logistic(data.select("id", "label", "features"), ["id"], trials=3)
    assert one.best_params == two.best_params and len(one.table) == 3
    assert all(1e-4 <= r["params"]["C"] <= 10 for r in one.table)


def test_runs_are_nested(spark, data, tmp_path):
    found = train.search_logistic(data, {"C": [1, 10]}, 3)
    registry = runs.RunRegistry(spark, str(tmp_path / "runs"))
    top = registry.log_search("search", found)
    below = registry.table("runs").filter(F.col("parent_run_id") == top)
    assert below.count() == 2
    assert below.join(registry.table("metrics"), "run_id").count() == 8


def test_preparation_edges(spark):
    df = spark.createDataFrame([(1.0, 5, "b'\\x"), (3.0, 5, "a"), (None, 5, None)], "n double, c int, t string")
    model = prepare.fit_preparation(df, ["n", "c"], ["t"], impute=True)
    wide = model.transform(df)
    rows = [r["features"].toArray().tolist() for r in wide.collect()]
    assert prepare.feature_names(wide) == ["n", "c", "t_a", "t_b'\\x"]
    assert rows[2][0] == pytest.approx(0.0) and all(r[1] == 0.0 for r in rows)
    assert rows[0][2:] == [0.0, 1.0] and rows[2][2:] == [1.0, 0.0]  # tie: the smaller text
    unseen = spark.createDataFrame([(1.0, 9, "zzz")], "n double, c int, t string")
    assert model.transform(unseen).first()["features"].toArray().tolist()[1:] == [4.0, 0.0, 0.0]
    uneven = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "p string, q string")
    both = prepare.fit_preparation(uneven, [], ["p", "q"]).transform(uneven)
    assert prepare.feature_names(both) == ["p_a", "p_b", "p_c", "q_x", "q_y"]
    assert both.first()["features"].toArray().tolist() == [1.0, 0.0, 0.0, 1.0, 0.0]
    coded = prepare.fit_preparation(df, [], ["t"], encoding="ordinal").transform(df)
    assert [r["features"][0] for r in coded.collect()] == [1.0, 0.0, -1.0]
    with pytest.raises(ValueError):
        prepare.feature_preparation([], ["t"], encoding="other")


# --- searches that share work ------------------------------------------------


@pytest.mark.parametrize("kind", ["forest", "boosting"])
def test_first_trees_are_a_model_of_their_own(spark, kind):
    """Scores of prefixes against the trees of the model, each asked by itself."""
    df = separable(spark, 300).select("label", "features")
    make = train.random_forest if kind == "forest" else train.gradient_boosting
    model = make(n_estimators=6, max_depth=3).fit(df)
    got = {}
    for r in tree.prefix_scores(model, df.select("label", "features"), [2, 6]).collect():
        got.setdefault(r.model, []).append((r.label, round(r.score, 9), r.prediction))
    rows = df.collect()
    for k, n in ((0, 2), (1, 6)):
        want = []
        for r in rows:
            if kind == "forest":
                p = sum(t.predictProbability(r.features)[1] for t in model.trees[:n]) / n
            else:
                p = 1 / (1 + np.exp(-2 * sum(w * t.predict(r.features) for w, t in zip(model.treeWeights[:n], model.trees[:n]))))
            want.append((r.label, round(float(p), 9), float(p > 0.5)))
        assert sorted(got[k]) == sorted(want)
    whole = sorted((r.label, r.prediction) for r in model.transform(df).collect())
    assert sorted((y, p) for y, _, p in got[1]) == whole
    with pytest.raises(ValueError):
        tree.prefix_scores(model, df, [7])


def test_equal_rows_are_fitted_as_one(spark, monkeypatch):
    """The tree of rows with numbers is that of all rows, and a grid fits no row twice."""
    df = separable(spark, 200).select("label", "features")
    df = df.unionByName(df.filter("label = 1.0")).unionByName(df).persist()
    weighted = train.copies(df)
    rows, distinct = df.count(), df.distinct().count()
    assert weighted.count() == distinct < rows and weighted.agg(F.sum("weight")).first()[0] == rows
    for leaf_size, split in ((1, 2), (7, 30)):
        point = {"max_depth": 6, "min_samples_leaf": leaf_size, "min_samples_split": split}
        one = train.Tree({k: [v] for k, v in point.items()}).fit(df, point)
        want = tree.collapse(train.decision_tree(6, leaf_size).fit(df), split)
        pairs = zip(one.transform(df).collect(), want.transform(df).collect())
        assert all(np.allclose(a.probability.toArray(), b.probability.toArray()) for a, b in pairs)
    fitted, grow = [], train.Tree._grow
    monkeypatch.setattr(train.Tree, "_grow", lambda self, part, *how: fitted.append(part.count()) or grow(self, part, *how))
    train.Tree({"max_depth": [3], "min_samples_leaf": [1, 5], "min_samples_split": [2]}).scores(df, df, train.f1_scorer())
    assert fitted == [distinct, distinct]


def test_logistic_grid_counts_equal_rows(spark, monkeypatch):
    """Weighted blocks give the models, figures and sizes of all rows, by counts and by ranks, and hold no row twice."""
    df = separable(spark, 200).select("label", "features")
    df = df.unionByName(df.filter("label = 1.0")).unionByName(df)
    df = df.withColumn("fold", F.pmod(F.hash("features"), F.lit(2))).persist()
    packed, seen = logistic_grid.packed, []

    def watched(part, *how):
        found = packed(part, *how)
        seen.append((found[0].agg(F.sum("n")).first()[0], found[2]))
        return found

    monkeypatch.setattr(logistic_grid, "packed", watched)
    for scorer in (train.f1_scorer(), train.auc_scorer()):
        got, _ = train.logistic_scores(df, [{"C": 1.0}, {"C": 0.01, "penalty": "l1"}], [0, 1], scorer, "fold")
        with monkeypatch.context() as plain:
            plain.setattr(train, "copies", lambda part, *by: part.withColumn("weight", F.lit(1.0)))
            want, _ = train.logistic_scores(df, [{"C": 1.0}, {"C": 0.01, "penalty": "l1"}], [0, 1], scorer, "fold")
        assert np.allclose(got, want, atol=1e-6)
    assert [n for n, _ in seen] == [df.distinct().count(), df.count()] * 2
    assert all(sizes == seen[0][1] and sum(sizes.values()) == df.count() for _, sizes in seen)


def test_no_task_holds_too_many_rows(spark, monkeypatch):
    df = spark.range(1000).coalesce(1)
    assert tables.bounded(df, ["id"]).rdd.getNumPartitions() == 1
    monkeypatch.setattr(tables, "MOST_ROWS", 100)
    dealt = tables.bounded(df, ["id"])
    assert dealt.rdd.getNumPartitions() == 10 and dealt.count() == 1000


def test_tops_of_a_forest_are_shallower_forests(spark, monkeypatch):
    """One deep fit answers for all depths: scores as those of forests fitted to each depth."""
    df = separable(spark, 400).select("label", "features").persist()
    deep = train.random_forest(8, 8).fit(df)
    got = {}
    for r in tree.prefix_scores(deep, df, [8, 3, 8], [2, 5, 8]).collect():
        got.setdefault(r.model, []).append((r.label, round(r.score, 9)))
    for k, (n, depth) in enumerate([(8, 2), (3, 5), (8, 8)]):
        trees = train.random_forest(8, depth).fit(df).trees[:n]
        want = [(r.label, round(float(sum(t.predictProbability(r.features)[1] for t in trees) / n), 9)) for r in df.collect()]
        assert sorted(got[k]) == sorted(want)
    made = []
    monkeypatch.setattr(train.Forest, "make", staticmethod(lambda **p: made.append(p) or train.random_forest(**p)))
    train.Forest({"n_estimators": [2, 4], "max_depth": [2, 3]}).scores(df, df, train.auc_scorer())
    assert made == [{"n_estimators": 4, "max_depth": 3}]
    with pytest.raises(ValueError):
        tree.prefix_scores(train.gradient_boosting(2, max_depth=2).fit(df), df, [2], [1])


def debts_like(spark, n=3000, seed=11):
    """One number of many values, one of few, a text; rows repeat in their bins only."""
    draw = random.Random(seed)
    rows = [(i, draw.gauss(0, 1), float(draw.choice([-2, 0, 5])), draw.choice("abcd")) for i in range(n)]
    rows = [(i, float(x + (c == "a") - (k == 5) + 0.3 * draw.gauss(0, 1) > 0.2), x, k, c) for i, x, k, c in rows]
    df = spark.createDataFrame(rows, "id bigint, label double, x double, k double, c string")
    wide = prepare.fit_preparation(df, ["x", "k"], ["c"]).transform(df).select("id", "label", "features")
    return stratified_folds(wide, "label", ["id"], 3).persist()


def test_cells_count_all_rows_in_their_bins(spark, monkeypatch):
    df = debts_like(spark)
    assert cells.find_cuts(df) is None  # few rows are not cut
    monkeypatch.setattr(cells, "FEW", 0)
    cuts = cells.find_cuts(df)
    assert {s: len(e) for s, e in cuts.edges.items()} == {0: 31, 1: 2}  # the slots of the text are no numbers
    got = {(tuple(r.features.toArray()), r.label): r.weight for r in cells.cells(df, cuts).collect()}
    want = {}
    for r in df.collect():
        x = r.features.toArray()
        code = tuple([np.searchsorted(cuts.edges[s], x[s]) - cuts.zero(s) for s in (0, 1)] + list(x[2:]))
        want[code, r.label] = want.get((code, r.label), 0) + 1
    assert got == want and len(got) < 3000 and sum(got.values()) == 3000
    shares = np.bincount([np.searchsorted(cuts.edges[0], r.features[0]) for r in df.collect()]) / 3000
    assert shares.max() < 1.5 / 32
    dense = df.select(array_to_vector(F.expr("array(0.0D, 1.5D)")).alias("features"), "label")
    both = cells.Cuts({0: np.array([-1.0]), 1: np.array([0.0, 1.0])})
    assert [tuple(r.features.toArray()) for r in cells.coded(dense.limit(1), both).collect()] == [(0.0, 2.0)]


def test_forest_of_cells_is_one_of_all_rows(spark, monkeypatch, tmp_path):
    """Every tree's nodes count the drawn rows that reach them, and the forest is as good as one fitted to rows."""
    df = debts_like(spark)
    want = train.Forest({"n_estimators": [20, 40], "max_depth": [2, 6]})
    by_rows, _ = want.scores(df.filter("fold > 0"), df.filter("fold = 0"), train.auc_scorer())
    monkeypatch.setattr(cells, "FEW", 0)
    fitted = []
    monkeypatch.setattr(train.RandomForestClassifier, "_fit", lambda self, part, f=train.RandomForestClassifier._fit: fitted.append(part.count()) or f(self, part))
    by_cells, _ = want.scores(df.filter("fold > 0"), df.filter("fold = 0"), train.auc_scorer())
    assert by_cells == pytest.approx(by_rows, abs=0.02) and min(by_cells) > 0.85
    model = want.fit(df, {"n_estimators": 30, "max_depth": 6})
    assert fitted and max(fitted) <= 2  # no forest is fitted to the rows, only its frame to two
    assert model.getNumTrees == 30 and {t.depth for t in model.trees} <= set(range(7)) and model.numFeatures == 6
    monkeypatch.setattr(cells, "FEW", 10_000)
    plain = train.random_forest(30, 6).fit(df)
    assert accuracy(model.transform(df)) == pytest.approx(accuracy(plain.transform(df)), abs=0.02)
    assert model.featureImportances.toArray() == pytest.approx(plain.featureImportances.toArray(), abs=0.1)
    roots = [r.nodeData.rawCount for r in _nodes(spark, model, tmp_path / "m").filter("nodeData.id = 0").collect()]
    assert all(abs(n - 3000) < 5 * 3000**0.5 for n in roots) and len(set(roots)) > 10  # Poisson(1) draws of every row
    model.write().overwrite().save(str(tmp_path / "again"))
    again = type(model).load(str(tmp_path / "again")).transform(df)
    assert [r.prediction for r in again.collect()] == [r.prediction for r in model.transform(df).collect()]


def test_trees_of_large_tables_are_fitted_to_cells(spark, monkeypatch):
    """No fit sees more rows than there are cells, and the chosen tree splits numbers as its figures say."""
    df = debts_like(spark)
    grid = {"max_depth": [3], "min_samples_split": [2, 100], "min_samples_leaf": [5]}
    by_rows = train.search_tree(df, grid, 3)
    monkeypatch.setattr(cells, "FEW", 0)
    cuts = cells.find_cuts(df)
    most = cells.cells(df, cuts).count()
    fitted, grow = [], train.Tree._grow
    monkeypatch.setattr(train.Tree, "_grow", lambda self, part, *how: fitted.append(part.count()) or grow(self, part, *how))
    found = train.search_tree(df, grid, 3)
    assert len(fitted) == 4 and max(fitted) <= most < df.count()
    assert found.best_score == pytest.approx(by_rows.best_score, abs=0.02)
    family = train.Tree(grid)
    point = {"max_depth": 6, "min_samples_split": 2, "min_samples_leaf": 5}
    on_codes = family.of_cells(cells.cells(df, cuts), None, point)
    on_rows = family.fit(df, point)
    want = [r.prediction for r in on_codes.transform(cells.coded(df.select("label", "features"), cuts)).collect()]
    assert [r.prediction for r in on_rows.transform(df).collect()] == want and len(set(want)) == 2
    assert on_rows.featureImportances == on_codes.featureImportances


def test_logistic_grid_begins_at_the_models_of_the_cells(spark, monkeypatch):
    """Few passes over the rows, and the models of a search that begins at zero."""
    df = debts_like(spark).select("label", "features", "fold")
    grid = [{"C": 1.0, "penalty": p, "tol": 1e-6} for p in ("l1", "l2")]
    fit_all, seen = logistic_grid.fit_all, []
    monkeypatch.setattr(logistic_grid, "fit_all", lambda data, *how: seen.append((data.agg(F.sum("n")).first()[0], fit_all(data, *how))) or seen[-1][1])
    want, _ = train.logistic_scores(df, grid, [0, 1, 2], train.auc_scorer(), "fold")
    monkeypatch.setattr(cells, "FEW", 0)
    monkeypatch.setattr(train, "SHARE", 1)
    monkeypatch.setattr(train, "MANY", 6)
    got, _ = train.logistic_scores(df, grid, [0, 1, 2], train.auc_scorer(), "fold")
    (rows, plain), (few, _), (again, begun) = seen
    assert rows == again > few and begun.passes < plain.passes / 2
    # one category more and the constant less say the same, and an L1 penalty may not care either
    said = lambda fit: np.c_[fit.coefficients[:, :2], fit.coefficients[:, 2:] + fit.intercepts[:, None]]
    assert said(begun) == pytest.approx(said(plain), abs=1e-3)
    assert np.allclose(got, want, atol=1e-4)


def test_tree_grown_on_held_cells_takes_the_best_splits(spark, monkeypatch):
    """With all features looked at and no draws, the nodes are those of Spark's tree on the same cells."""
    df = debts_like(spark)
    monkeypatch.setattr(cells, "FEW", 0)
    cuts = cells.find_cuts(df)
    counted = cells.cells(df, cuts)
    data = forest.held(counted, cuts, raw=False)
    assert (data.neg + data.pos).sum() == 3000
    monkeypatch.setattr(forest.np.random, "default_rng", lambda seed: NoDraws())
    monkeypatch.setattr(forest.math, "sqrt", lambda n: n)
    for chunk in (forest.HISTOGRAMS, 1):
        monkeypatch.setattr(forest, "HISTOGRAMS", chunk)
        got = forest.grow_tree(data, 1, 0, 5)
        want = tree.read_nodes(train.decision_tree(5, weightCol="weight").fit(counted))
        assert [n[3:5] for n in got] == [tuple(want[k]["impurityStats"]) for k in range(len(want))]
        assert [(n[1], n[6], n[7]) for n in got] == [(v["prediction"], v["leftChild"], v["rightChild"]) for _, v in sorted(want.items())]


class NoDraws:
    def poisson(self, n):
        return n

    def random(self, shape):
        return np.zeros(shape)


def test_logistic_models_side_by_side_equal_single_fits(spark):
    """Sparse and dense vectors, L1 and L2, with and without a fold left out."""
    draw = np.random.default_rng(4)
    rows = []
    for i in range(400):
        x = np.round(draw.normal(size=4), 3) * [1, 1, 1, draw.random() < 0.5]
        y = float(x @ [2, -1, 0, 0.5] + draw.normal() > 0.3)
        rows.append((i % 3, y, Vectors.sparse(4, [(k, v) for k, v in enumerate(x) if v]) if i % 2 else Vectors.dense(x)))
    df = spark.createDataFrame(rows, ["fold", "label", "features"]).repartition(3)
    problems = [
        logistic_grid.Problem(f, reg, l1, 500, 1e-8) for f in (None, 0, 2) for reg, l1 in ((0.01, 0.0), (0.02, 1.0), (0.1, 0.5))
    ]
    data, features, sizes = logistic_grid.packed(df, "fold")
    assert (features, sum(sizes.values())) == (4, 400)
    many = [400 - sizes.get(p.fold, 0) for p in problems]
    fitted = logistic_grid.fit_all(data, problems, many, features)
    for k, p in enumerate(problems):
        part = df if p.fold is None else df.filter(F.col("fold") != p.fold)
        one = train.logistic(1, tol=1e-12, max_iter=500).copy()
        one = one.setRegParam(p.reg).setElasticNetParam(p.l1_share).fit(part)
        assert fitted.coefficients[k] == pytest.approx(one.coefficients.toArray(), abs=1e-4)
        assert fitted.intercepts[k] == pytest.approx(one.intercept, abs=1e-4)
    held = logistic_grid.held_out(data, problems, fitted)
    assert dict(held.groupBy("model").count().collect()) == {k: sizes[p.fold] for k, p in enumerate(problems) if p.fold is not None}
    for scorer in (train.f1_scorer(), train.weighted_f1_scorer(), train.accuracy_scorer()):
        mine = held.filter("model = 4")
        assert train.evaluate_all(mine.withColumn("model", F.lit(0)), 1, scorer) == [pytest.approx(scorer.evaluate(mine))]
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        logistic_grid.packed(df.withColumn("label", F.lit(2.0)), "fold")


def test_families_share_the_preparation_of_a_fold(spark):
    """Three kinds of models, one fit of the preparation a fold and one for the end; balancing leaves the fold alone."""
    draw = random.Random(6)
    rows = [(i, draw.random(), draw.choice("abc")) for i in range(300)]
    rows = [(i, float(x + (c == "a") > 0.9), x, c) for i, x, c in rows]
    df = spark.createDataFrame(rows, "id bigint, label double, x double, c string")
    folded = stratified_folds(df, "label", ["id"], 2)
    fits, evened = [], []

    class Counted(Pipeline):
        def _fit(self, dataset):
            fits.append(1)
            return super()._fit(dataset)

    def even(part):
        evened.append(part.count())
        return part

    steps = Counted(stages=prepare.feature_preparation(["x"], ["c"], impute=True).getStages())
    families = [
        train.Logistic({"C": [0.1, 10]}),
        train.Forest({"n_estimators": [3, 6], "max_depth": [2]}),
        train.Boosting({"n_estimators": [2, 4], "learning_rate": [0.1], "max_depth": [2]}),
    ]
    found = train.search_families(folded, families, 2, preparation=steps, balance=even)
    assert len(fits) == 3 and evened[2] == 300 and sum(evened[:2]) == 300
    for family in families:
        search = found[family.name]
        assert [r["params"] for r in search.table] == family.points and search.best_params in family.points
        assert 0.7 < search.best_score <= 1.0
        assert search.model.transform(df).filter("prediction = label").count() > 230
    sizes = {p["n_estimators"]: p["mean_score"] for p in [r["params"] | r for r in found["gradient_boosting"].table]}
    assert set(sizes) == {2, 4}


def test_families_run_side_by_side_on_rows_in_order(spark):
    """Both families of a fold are at work at once, and like rows stand together in what they are fitted on."""
    draw = random.Random(8)
    rows = [(i, float(i % 2), draw.random(), draw.choice("abcdef")) for i in range(400)]
    folded = stratified_folds(spark.createDataFrame(rows, "id bigint, label double, x double, c string"), "label", ["id"], 2)
    both, runs_of_slots = threading.Barrier(2, timeout=60), []

    class Stub:
        points = [{}]

        def __init__(self, name):
            self.name = name

        def scores(self, fit_part, held, scorer):
            both.wait()
            for part in fit_part.rdd.map(lambda r: tuple(r["features"].indices.tolist())).glom().collect():
                runs_of_slots.append((sum(a != b for a, b in zip(part, part[1:])), len(set(part)) - 1))
            return [1.0], [0.0]

        def fit(self, df, point):
            return train.logistic(df.count()).fit(df)

    steps = prepare.feature_preparation(["x"], ["c"], impute=True)
    train.search_families(folded, [Stub("one"), Stub("two")], 2, preparation=steps)
    assert any(kinds > 0 for _, kinds in runs_of_slots)
    assert all(changes == max(kinds, 0) for changes, kinds in runs_of_slots)


# --- neighbours and synthetic rows ------------------------------------------


def brute(points, k):
    """Squared distance of the numbers, and one for each slot that only one of both has."""
    out = {}
    for i, (x, own) in points.items():
        near = sorted(
            (sum((a - b) ** 2 for a, b in zip(x, y)) + len(own ^ other), j) for j, (y, other) in points.items() if j != i
        )
        out[i] = [(j, d) for d, j in near[:k]]
    return out


@pytest.mark.parametrize(
    "dims, categories, band, gaps",
    [(1, (4, 3), 8, False), (2, (), 7, False), (3, (3, 5, 2), 256, True), (0, (5, 5, 4), 4, False)],
)
def test_neighbours_match_brute_force(spark, dims, categories, band, gaps):
    """Few numbers and categories, some of them unset: patterns with one row, and with many bands."""
    draw = random.Random(dims * 100 + band)
    points = {}
    for _ in range(150):
        x = tuple(float(draw.randint(0, 30)) for _ in range(dims))
        starts = [dims + sum(categories[:i]) for i in range(len(categories))]
        own = [s + max(0, draw.randrange(-2, c)) for s, c in zip(starts, categories) if not gaps or draw.random() > 0.2]
        points[x, tuple(own)] = None
    points = {i: (x, set(own)) for i, (x, own) in enumerate(points)}
    rows = [(i, list(x), sorted(own), 1) for i, (x, own) in points.items()]
    vectors = spark.createDataFrame(rows, "vid bigint, x array<double>, slots array<int>, times bigint")
    got = {}
    for r in neighbours.nearest(vectors, 4, F.col("vid") % 2 == 0, band=band).orderBy("vid", "place").collect():
        got.setdefault(r["vid"], []).append((r["nn"], r["d2"]))
        assert (tuple(r["nn_x"]), set(r["nn_slots"])) == points[r["nn"]]
    assert got == {i: near for i, near in brute(points, 4).items() if i % 2 == 0}


def test_neighbours_look_at_a_bounded_number_of_rows(spark):
    """Ten times the rows, hardly more candidates a question: what is compared follows the bands, not the table."""
    compared = []
    for n in (400, 4000):
        rows = [(i, [((i * 7919) % n) * 1.0], [1 + i % 2], 1) for i in range(n)]
        vectors = spark.createDataFrame(rows, "vid bigint, x array<double>, slots array<int>, times bigint")
        index = neighbours._Bands(vectors.withColumn("asks", F.lit(True)), 16)
        asks = index.bands.select("band", F.col("lo").alias("ask_lo"), F.col("hi").alias("ask_hi"), F.lit(64.0).alias("reach"), "slots")
        visits = asks.select("band", "slots").join(index.runs, "slots").withColumn("cost", F.lit(0.0))
        assert index.top >= 1
        compared.append(index.descend(visits, asks, False).count() * 16 / (n / 16))
    assert compared[1] <= 1.5 * compared[0]


def test_neighbours_with_text_keys_and_few_vectors(spark):
    vectors = spark.createDataFrame(
        [("a", [0.0], 1), ("b", [1.0], 1), ("c", [3.0], 1)], "vid string, x array<double>, times bigint"
    )
    got = neighbours.nearest(vectors, 5).orderBy("vid", "place").collect()
    assert [(r["vid"], r["nn"]) for r in got] == [("a", "b"), ("a", "c"), ("b", "a"), ("b", "c"), ("c", "b"), ("c", "a")]


def test_smote_evens_the_classes(spark):
    """A hot group of copies, a few lonely rows, vector features."""
    rows = [(i, 1.0, [1.0, 2.0]) for i in range(30)] + [(30 + i, 1.0, [float(i), 9.0]) for i in range(8)]
    rows += [(100 + i, 0.0, [float(i), 0.0]) for i in range(100)]
    df = spark.createDataFrame(rows, "id bigint, label double, x array<double>").select(
        "id", "label", array_to_vector("x").alias("features")
    )
    out = smote.smote(df, "id").collect()
    new = [r for r in out if r["id"] is None]
    assert len(new) == 62 and {r["label"] for r in new} == {1.0} and len(out) == 200
    assert {r["draw"] for r in new} == set(range(62))
    for r in new:
        x, y = r["features"].toArray()
        assert (x, y) == (1.0, 2.0) or 0.0 <= x <= 7.0 and 2.0 <= y <= 9.0


def test_smote_of_encoded_rows_is_sparse_and_lies_between_rows(spark):
    draw = random.Random(3)
    rows = [(i, float(i % 4 == 0), draw.random() * 9, draw.choice("abc"), draw.choice("xy")) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, label double, n double, p string, q string")
    wide = prepare.fit_preparation(df, ["n"], ["p", "q"]).transform(df).select("id", "label", "features")
    out = smote.smote(wide, "id").collect()
    kept = {r["id"]: r for r in out if r["id"] is not None}
    assert kept == {r["id"]: r for r in wide.withColumn("draw", F.lit(None).cast("bigint")).collect()}
    few = [r["features"].toArray() for r in kept.values() if r["label"] == 1.0]
    new = [r["features"] for r in out if r["id"] is None]
    assert len(new) == 100 and all(type(v).__name__ == "SparseVector" for v in new)
    for v in new:
        x = v.toArray()
        assert x[1:4].sum() == pytest.approx(1.0) and x[4:].sum() == pytest.approx(1.0)  # shares of two categories
        pairs = (abs(((x - a) * (b - a)).sum() - ((x - a) ** 2).sum() ** 0.5 * ((b - a) ** 2).sum() ** 0.5) for a in few for b in few)
        assert min(pairs) < 1e-9  # on a line between two rows


@pytest.mark.parametrize(
    "sizes",
    [{1.0: 50, 0.0: 52}, {1.0: 5, 0.0: 50}, {1.0: 20}, {0.0: 9, 1.0: 20, 2.0: 40}],
)
def test_smote_leaves_other_tables_alone(spark, sizes):
    rows = [(i, label, [float(i)]) for label, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "id bigint, label double, features array<double>")
    assert smote.smote(df, "id").count() == len(rows)


# --- metrics ------------------------------------------------------------------


def scored(spark, n=300, seed=5):
    draw = random.Random(seed)
    rows = [(float(draw.random() < 0.3), round(draw.random(), 2)) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "label double, score double")


def test_auc_matches_pair_counting(spark):
    rows, df = scored(spark)
    pos = [s for y, s in rows if y == 1.0]
    neg = [s for y, s in rows if y == 0.0]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    assert evaluate.roc_auc(df).first()["auc"] == pytest.approx(wins / (len(pos) * len(neg)))


def test_curves_cover_every_score(spark):
    rows, df = scored(spark)
    roc = {r["threshold"]: (r["fpr"], r["tpr"]) for r in evaluate.roc_points(df).collect()}
    pr = {r["threshold"]: (r["precision"], r["recall"]) for r in evaluate.pr_points(df).collect()}
    p = sum(y for y, _ in rows)
    for cut in {s for _, s in rows}:
        tp = sum(1 for y, s in rows if s >= cut and y == 1.0)
        fp = sum(1 for y, s in rows if s >= cut and y == 0.0)
        assert roc[cut] == pytest.approx((fp / (len(rows) - p), tp / p))
        assert pr[cut] == pytest.approx((tp / (tp + fp), tp / p))
    assert roc[float("inf")] == (0.0, 0.0) and pr[None] == (1.0, 0.0)


def test_one_class_only(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.2), (0.0, 1.0, 0.4)], "label double, prediction double, score double")
    assert evaluate.roc_auc(df).first()["auc"] is None
    row = evaluate.binary_metrics(df).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (0.5, 0.0, 0.0, 0.0)
    assert evaluate.hit_rate(df, "SIM").first()["hit_rate"] == 0.0
    assert evaluate.hit_rate(df, "nao").first()["hit_rate"] == 0.5
    assert len(evaluate.confusion(df).collect()) == 4


def test_champion_keeps_the_first_on_a_tie(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("b", 2, 0.9), ("c", 3, 0.9)], "name string, place int, score double")
    assert evaluate.champion(df).first()["name"] == "b"
