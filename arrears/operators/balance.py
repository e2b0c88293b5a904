"""Random under- and over-sampling of classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arrears.functions.hashing import digest, position
from arrears.operators.ranking import dense_positions, rank_cutoffs
from arrears.operators.sampling import SEED, class_sizes

DRAWS_PER_TASK_ROW = 100_000


def undersample(df: DataFrame, label: str, key: Sequence[str], seed: object = SEED) -> DataFrame:
    """Every class cut to the size of the smallest, without replacement.

    The rows kept are those with the lowest digests of their class. They are
    found by one cutoff per class; the table itself is only filtered.
    """
    drawn = digest(seed, *key)
    labelled = df.filter(F.col(label).isNotNull())
    narrow = labelled.select(label, drawn.alias("__digest"))
    smallest = F.min("n").over(W.partitionBy(F.lit(1)))  # one row per class
    cutoffs = rank_cutoffs(
        narrow, label, "__digest", lambda sizes: sizes.select(label, F.lit(1).alias("slot"), smallest.alias("k"))
    ).select(label, "cutoff")
    return (
        labelled.join(F.broadcast(cutoffs), label).filter(drawn <= F.col("cutoff")).drop("cutoff")
    )


def oversample(
    df: DataFrame, label: str, key: Sequence[str], seed: object = SEED, copy_column: str = "copy"
) -> DataFrame:
    """Every class resampled with replacement to the size of the largest.

    Draw ``i`` of a class points at position ``md5(seed:label:i) mod size``.
    Draws are made by many tasks in even chunks and counted per position before
    they move; only keys travel to be ranked, and each drawn row is fetched
    once and then repeated. ``copy_column`` numbers the copies of a row from 1.
    """
    labelled = df.filter(F.col(label).isNotNull())
    sizes = class_sizes(df, label).withColumn("draws", F.max("n").over(W.partitionBy(F.lit(1))))
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("draws") - 1) / DRAWS_PER_TASK_ROW))
    # a stated number: these few bytes must not be packed into one task
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = sizes.select(label, "n", "draws", F.explode(chunks).alias("chunk")).repartition(tasks, label, "chunk")
    first = F.col("chunk") * DRAWS_PER_TASK_ROW
    last = F.least(first + DRAWS_PER_TASK_ROW, F.col("draws")) - 1
    draws = starts.select(label, "n", F.explode(F.sequence(first, last)).alias("draw"))
    times = (
        draws.select(label, position(digest(seed, label, "draw"), F.col("n")).alias("position"))
        .groupBy(label, "position")
        .agg(F.count(F.lit(1)).alias("__times"))
    )
    ranked = dense_positions(
        labelled.select(label, *key, digest(seed, *key).alias("__digest")), label, "__digest"
    )
    chosen = ranked.join(times, [label, "position"]).select(*key, "__times")
    return (
        labelled.join(chosen, list(key))
        .withColumn(copy_column, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__times"))))
        .drop("__times")
    )


def balance_random(
    df: DataFrame, label: str, key: Sequence[str], strategy: str = "undersample", seed: object = SEED
) -> DataFrame:
    if strategy == "undersample":
        return undersample(df, label, key, seed)
    if strategy == "oversample":
        return oversample(df, label, key, seed)
    raise ValueError("strategy must be 'undersample' or 'oversample'")
