"""Bucketed snapshots: no exchange where quarters meet."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from arrears.operators import features
from arrears.sources import snapshots


@pytest.fixture()
def plain_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def quarters(spark, n=500):
    ids = spark.range(n).withColumnRenamed("id", "debt")
    return (
        ids.withColumn("tri", F.explode(F.array(*map(F.lit, (1, 2, 4)))))
        .filter("pmod(hash(debt, tri), 5) > 0")
        .select("debt", "tri", (F.col("debt") * F.col("tri")).alias("value"), F.when(F.col("debt") % 3 == 0, "SIM").alias("sued"))
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_number_of_buckets():
    assert [snapshots.buckets_for(n, 10) for n in (0, 1, 10, 11, 35, 81)] == [1, 1, 1, 2, 4, 16]


def test_quarters_meet_without_an_exchange(spark, tmp_path, plain_joins):
    df = quarters(spark)
    for tri in (1, 2, 4):
        landed = snapshots.land_snapshot(df.filter(F.col("tri") == tri), "snaps_a", str(tmp_path / "a"), "debt", "tri", 4)
    assert Counter(landed.select(*df.columns).collect()) == Counter(df.collect())
    for by in (features.pair_snapshots, features.target_from_snapshots):
        more = (["value"], "_4") if by is features.pair_snapshots else ("sued",)
        got = by(landed.filter("tri = 1"), landed.filter("tri = 4"), "debt", *more)
        want = by(df.filter("tri = 1"), df.filter("tri = 4"), "debt", *more)
        assert "Exchange" not in plan(got) and "SortMergeJoin" in plan(got) and "Exchange" in plan(want)
        assert Counter(got.select(*want.columns).collect()) == Counter(want.collect())
    assert "PartitionFilters: [isnotnull(tri" in landed.filter("tri = 4")._jdf.queryExecution().toString()


def test_a_quarter_landed_again_is_replaced(spark, tmp_path):
    df = quarters(spark)
    path = str(tmp_path / "b")
    snapshots.land_snapshot(df, "snaps_b", path, "debt", "tri", 2)
    again = df.filter("tri = 2").withColumn("value", F.lit(-1).cast("long"))
    for _ in range(2):
        landed = snapshots.land_snapshot(again, "snaps_b", path, "debt", "tri", 2)
    want = df.filter("tri <> 2").unionByName(again)
    assert Counter(landed.select(*df.columns).collect()) == Counter(want.collect())
    files = {f.rsplit("/", 2)[-2] for f in landed.inputFiles()}
    assert files == {"tri=1", "tri=2", "tri=4"} and len(landed.inputFiles()) == 6  # a file a bucket and quarter


def test_another_session_finds_the_table_by_its_folder(spark, tmp_path, plain_joins):
    df, path = quarters(spark), str(tmp_path / "c")
    snapshots.land_snapshot(df, "snaps_c", path, "debt", "tri", 2)
    spark.sql("DROP TABLE snaps_c")  # external: the files stay
    found = snapshots.attach(spark, "snaps_d", path, snapshots.ddl_of(df, ["tri"]), "debt", 2, "tri")
    assert Counter(found.select(*df.columns).collect()) == Counter(df.collect())
    assert "Exchange" not in plan(found.filter("tri = 1").join(found.filter("tri = 2"), "debt"))


def test_registry_is_not_exchanged(spark, tmp_path, plain_joins):
    registry = spark.range(50).select(F.col("id").alias("company"), F.concat(F.lit("n"), "id").alias("a name"))
    held = snapshots.land_registry(registry, "registry_a", str(tmp_path / "r"), "company", 4)
    debts = spark.range(300).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 60).alias("company"))
    joined = debts.join(held, "company", "left")
    assert plan(joined).count("Exchange hashpartitioning") == 1
    assert Counter(joined.collect()) == Counter(debts.join(registry, "company", "left").collect())


def test_null_keys_and_empty_tables(spark, tmp_path, plain_joins):
    df = spark.createDataFrame([(None, 1, "x"), (None, 2, "y"), (3, 1, "z")], "debt long, tri int, v string")
    landed = snapshots.land_snapshot(df, "snaps_e", str(tmp_path / "e"), "debt", "tri", 2)
    assert Counter(landed.select(*df.columns).collect()) == Counter(df.collect())
    assert landed.filter("tri = 1").join(landed.filter("tri = 2"), "debt").count() == 0
    none = snapshots.land_snapshot(df.limit(0), "snaps_f", str(tmp_path / "f"), "debt", "tri", 2)
    assert none.count() == 0
