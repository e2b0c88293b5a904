"""Samples, splits and folds that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arrears.functions.hashing import digest, falls_below
from arrears.operators.ranking import rank_cutoffs

SEED = 42


def sample_rows(df: DataFrame, share: float, key: Sequence[str], seed: object = SEED) -> DataFrame:
    """Keep each row with probability ``share``; a filter, no shuffle."""
    return df.filter(falls_below(digest(seed, *key), share))


def head_rows(df: DataFrame, key: Sequence[str], n: int = 1000) -> DataFrame:
    """The first ``n`` rows in the order of ``key``."""
    return df.orderBy(*key).limit(n)


def split_parts(df: DataFrame, n: int, key: Sequence[str], seed: object = SEED, out: str = "part") -> DataFrame:
    """Number every row with one of ``n`` even parts, 1-based."""
    number = F.conv(F.substring(digest(seed, *key), 1, 15), 16, 10).cast("bigint") % n + 1
    return df.withColumn(out, number.cast("int"))


def split_random(
    df: DataFrame, key: Sequence[str], test_share: float = 0.3, seed: object = SEED, out: str = "is_test"
) -> DataFrame:
    """Flag about ``test_share`` of the rows as test; a projection, no shuffle."""
    return df.withColumn(out, falls_below(digest(seed, *key), test_share))


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def _test_sizes(sizes: DataFrame, label: str, test_share: float) -> DataFrame:
    """(label, slot, k): test rows per class.

    The total is ``ceil(share * rows)``; classes share the training rows in
    proportion, left-over units going to the largest remainders.
    """
    everything = W.partitionBy(F.lit(1))  # one row per class
    by_remainder = W.partitionBy(F.lit(1)).orderBy(F.col("__rest").desc(), label)
    shared = (
        sizes.withColumn("__all", F.sum("n").over(everything))
        .withColumn("__train", F.col("__all") - F.ceil(F.col("__all") * F.lit(test_share)))
        .withColumn("__exact", F.col("n") * F.col("__train") / F.col("__all"))
        .withColumn("__floor", F.floor("__exact"))
        .withColumn("__rest", F.col("__exact") - F.col("__floor"))
        .withColumn("__left", F.col("__train") - F.sum("__floor").over(everything))
        .withColumn("__extra", F.when(F.row_number().over(by_remainder) <= F.col("__left"), 1).otherwise(0))
    )
    test = (F.col("n") - F.col("__floor") - F.col("__extra")).cast("bigint")
    return shared.select(label, F.lit(1).alias("slot"), test.alias("k"))


def split_stratified(
    df: DataFrame,
    label: str,
    key: Sequence[str],
    test_share: float = 0.3,
    seed: object = SEED,
    out: str = "is_test",
) -> DataFrame:
    """Flag test rows so that every class is split in the same proportion.

    Exact class sizes without ranking or moving the table: count, find the one
    digest per class at the wanted rank, compare. The wide rows meet only a
    broadcast of one row per class. Rows with a null label are train rows.
    """
    drawn = digest(seed, *key)
    narrow = df.filter(F.col(label).isNotNull()).select(label, drawn.alias("__digest"))
    cutoffs = rank_cutoffs(
        narrow, label, "__digest", lambda sizes: _test_sizes(sizes, label, test_share)
    ).select(label, "cutoff")
    return (
        df.join(F.broadcast(cutoffs), label, "left")
        .withColumn(out, F.coalesce(drawn <= F.col("cutoff"), F.lit(False)))
        .drop("cutoff")
    )


def stratified_folds(
    df: DataFrame, label: str, key: Sequence[str], k: int = 5, seed: object = SEED, out: str = "fold"
) -> DataFrame:
    """Number rows 0..k-1 so that class counts differ by at most one between folds.

    Fold edges are ``k - 1`` digests per class, so again nothing wide moves.
    """
    drawn = digest(seed, *key)
    narrow = df.filter(F.col(label).isNotNull()).select(label, drawn.alias("__digest"))
    # fold i holds ranks floor(i*n/k)+1 .. floor((i+1)*n/k)
    edges = F.transform(
        F.sequence(F.lit(1), F.lit(k - 1)),
        lambda i: F.struct(i.alias("slot"), F.floor(i * F.col("n") / k).cast("bigint").alias("k")),
    )
    cutoffs = (
        rank_cutoffs(
            narrow, label, "__digest", lambda sizes: sizes.select(label, F.inline(edges)).filter(F.col("k") > 0)
        )
        .groupBy(label)
        .agg(F.collect_list("cutoff").alias("__edges"))
    )
    passed: Column = F.size(F.filter(F.col("__edges"), lambda e: e < drawn))
    # an edge at rank 0 has no digest, yet every row lies beyond it
    lost = F.lit(k - 1) - F.size("__edges")
    fold = F.when(F.col("__edges").isNull(), k - 1).otherwise(passed + lost).cast("int")
    return (
        df.join(F.broadcast(cutoffs), label, "left")
        .withColumn(out, F.when(F.col(label).isNotNull(), fold))
        .drop("__edges")
    )
