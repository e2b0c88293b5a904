from __future__ import annotations

import random
import re
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from arrears.operators import balance, joins, profile, ranking, sampling
from arrears.operators.quantiles import medians, modes, value_ranges


@pytest.fixture(scope="module")
def uneven(spark):
    return spark.range(1000).select(
        "id", F.when(F.col("id") < 130, 1.0).when(F.col("id") < 990, 0.0).alias("label")
    ).cache()


def pairs(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_split_is_exact_and_stable(uneven):
    one = sampling.split_stratified(uneven, "label", ["id"])
    two = sampling.split_stratified(uneven.repartition(7), "label", ["id"])
    assert pairs(one, "id", "is_test") == pairs(two, "id", "is_test")
    counts = Counter((r["label"], r["is_test"]) for r in one.collect())
    assert counts[1.0, True] + counts[0.0, True] == 297  # ceil(0.3 * 990)
    assert counts[1.0, True] == 39 and counts[0.0, True] == 258
    assert counts[None, False] == 10  # no label, no test row


def test_split_seed_matters(uneven):
    assert pairs(sampling.split_stratified(uneven, "label", ["id"], seed=1), "id", "is_test") != pairs(
        sampling.split_stratified(uneven, "label", ["id"], seed=2), "id", "is_test"
    )


@pytest.mark.parametrize("k", [2, 5, 7])
def test_folds_are_even(uneven, k):
    folded = sampling.stratified_folds(uneven, "label", ["id"], k)
    counts = Counter((r["label"], r["fold"]) for r in folded.collect() if r["label"] is not None)
    for label in (0.0, 1.0):
        sizes = [counts[label, f] for f in range(k)]
        assert max(sizes) - min(sizes) <= 1


def test_folds_with_fewer_rows_than_folds(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 0.0), (3, 0.0)], "id int, label double")
    folds = [r["fold"] for r in sampling.stratified_folds(df, "label", ["id"], 5).collect()]
    assert all(0 <= f < 5 for f in folds)


def test_undersample(uneven):
    kept = balance.undersample(uneven, "label", ["id"])
    assert Counter(r["label"] for r in kept.collect()) == {0.0: 130, 1.0: 130}
    assert kept.select("id").distinct().count() == 260


def test_oversample(uneven):
    grown = balance.oversample(uneven, "label", ["id"]).collect()
    assert Counter(r["label"] for r in grown) == {0.0: 860, 1.0: 860}
    assert len({(r["id"], r["copy"]) for r in grown}) == len(grown)
    assert {r["id"] for r in grown if r["label"] == 1.0} <= set(range(130))


def test_balance_strategy_is_checked(uneven):
    with pytest.raises(ValueError):
        balance.balance_random(uneven, "label", ["id"], "other")


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_dense_positions(spark, digits):
    df = spark.range(500).select("id", (F.col("id") > 30).alias("g"), F.md5(F.col("id").cast("string")).alias("d"))
    got = ranking.dense_positions(df, "g", "d", digits=digits).collect()
    for g in (True, False):
        rows = sorted((r for r in got if r["g"] == g), key=lambda r: r["d"])
        assert [r["position"] for r in rows] == list(range(len(rows)))


def operators_below(plan: str, marker: str) -> list[str]:
    """What feeds each occurrence of ``marker``: the next operator line that is no projection."""
    lines = [re.sub(r"^[\s:+\-*()0-9]+", "", line) for line in plan.splitlines()]
    found = []
    for i, line in enumerate(lines):
        if line.startswith(marker):
            found.append(next(x for x in lines[i + 1 :] if not x.startswith(("Project", "Sort"))))
    return found


@pytest.mark.parametrize("operator", ["split", "folds", "undersample", "oversample"])
def test_rows_are_never_gathered_in_one_task(uneven, operator):
    """Only aggregated counts pass through a single partition or a broadcast."""
    df = {
        "split": lambda: sampling.split_stratified(uneven, "label", ["id"]),
        "folds": lambda: sampling.stratified_folds(uneven, "label", ["id"]),
        "undersample": lambda: balance.undersample(uneven, "label", ["id"]),
        "oversample": lambda: balance.oversample(uneven, "label", ["id"]),
    }[operator]()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert all(x.startswith("HashAggregate") for x in operators_below(plan, "Exchange SinglePartition"))


@pytest.mark.parametrize("split", [5, 10_000])
def test_hot_key_join_keeps_every_row(spark, split):
    left = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 != 1, F.col("id")).alias("k"))
    right = spark.createDataFrame([(7, "a"), (8, "b"), (8, "c"), (1000, "d")], "k bigint, v string")
    got = joins.join_spread(left, right, ["k"], ["id"], rows_per_split=split)
    assert pairs(got, "id", "k", "v") == pairs(left.join(right, "k", "left"), "id", "k", "v")


def test_hot_key_is_shared_out(spark):
    """A third of the rows under one key, a third without a key: no partition gets them all."""
    left = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 3 == 1, F.col("id")).alias("k")
    )
    right = left.filter("k IS NOT NULL").select("k").distinct().withColumn("v", F.lit(1))
    off = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(off)
    spark.conf.set(off, -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = joins.join_spread(left, right, ["k"], ["id"], rows_per_split=500)
        parts = joined.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in parts) == 30_000
        assert max(r["count"] for r in parts) < 4_000
    finally:
        spark.conf.set(off, before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_inner_join_spread(spark):
    left = spark.createDataFrame([(1, "x", 5), (2, None, 6), (3, "z", 7)], "id int, k string, w int")
    right = spark.createDataFrame([("x", 1), ("x", 2), (None, 3)], "k string, w int")
    got = joins.join_spread(left, right, ["k"], ["id"], "inner", rows_per_split=1)
    assert pairs(got, "id", "k", "w_x", "w_y") == [(1, "x", 5, 1), (1, "x", 5, 2)]
    with pytest.raises(ValueError):
        joins.join_spread(left, right, ["k"], ["id"], "full")


def test_null_keys(spark):
    left = spark.createDataFrame([(1, None), (2, "x")], "a int, k string")
    right = spark.createDataFrame([(None, "n"), ("x", "y")], "k string, v string")
    assert pairs(joins.merge(left, right, ["k"]), "a", "v") == [(1, None), (2, "y")]
    assert pairs(joins.merge(left, right, ["k"], null_safe=True), "a", "v") == [(1, "n"), (2, "y")]


@pytest.mark.parametrize("n", [1, 2, 9, 400])
@pytest.mark.parametrize("small", [1, 20, 1000])
def test_medians(spark, n, small):
    draw = random.Random(n)
    rows = [(draw.random() * 100, float(draw.randint(0, 3)), None) for _ in range(n)]
    df = spark.createDataFrame([*rows, (None, float("nan"), None)], "a double, b double, c double")
    got = medians(df, ["a", "b", "c"], small=small)
    assert "c" not in got
    assert got["a"] == pytest.approx(statistics.median(r[0] for r in rows))
    assert got["b"] == pytest.approx(statistics.median(r[1] for r in rows))


def test_modes_take_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("b", "y"), ("a", None)], "p string, q string")
    assert modes(df, ["p", "q"]) == {"p": "a", "q": "x"}


def test_value_ranges(spark):
    edges = value_ranges(spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS s"), "s", 10)
    assert len(edges) == 9 and edges == sorted(edges)


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (2, "x", 1.0)], "a int, b string, c double")
    rows = {r["column_name"]: (r["nulls"], r["null_share"]) for r in profile.null_profile(df).collect()}
    assert rows == {"a": (0, 0.0), "b": (1, 0.5), "c": (1, 0.5)}


def test_imbalance_needs_two_classes(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "label double")
    assert profile.imbalance(df, "label").first()["ratio"] is None
