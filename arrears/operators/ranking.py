"""Exact ranks inside large groups without a window over a whole group.

Two classes may hold all rows, so ``partitionBy(class)`` would put everything
in two tasks. Ranks follow a random hexadecimal digest here; its leading digits
cut each class into many even cells. Only the cell counts, a table of at most
classes x 16^digits rows, are accumulated per class.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CELL_DIGITS = 4


def _cell(digest: str, digits: int) -> Column:
    return F.substring(F.col(digest), 1, digits)


def _cell_counts(rows: DataFrame, group: str, digest: str, digits: int) -> DataFrame:
    return rows.groupBy(F.col(group), _cell(digest, digits).alias("__cell")).agg(F.count(F.lit(1)).alias("__n"))


def _with_offsets(counts: DataFrame, group: str) -> DataFrame:
    earlier = W.partitionBy(group).orderBy("__cell").rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0).cast("bigint")))


def rank_cutoffs(
    rows: DataFrame,
    group: str,
    digest: str,
    choose: Callable[[DataFrame], DataFrame],
    digits: int = CELL_DIGITS,
) -> DataFrame:
    """The digest at each wanted rank of each group: (group, slot, cutoff).

    ``choose`` turns (group, n), the group sizes, into (group, slot, k) with
    1-based ranks ``k``; a handful of rows. Rows of the cells that contain a
    wanted rank are ranked; all others are only counted.
    """
    counts = _cell_counts(rows, group, digest, digits)
    wanted = choose(counts.groupBy(group).agg(F.sum("__n").alias("n")))
    hit = (
        _with_offsets(counts, group)
        .join(F.broadcast(wanted), group)
        .filter((F.col("k") > F.col("__before")) & (F.col("k") <= F.col("__before") + F.col("__n")))
        .select(group, "slot", "__cell", (F.col("k") - F.col("__before")).alias("__within"))
    )
    inside = rows.select(group, digest, _cell(digest, digits).alias("__cell")).join(
        F.broadcast(hit), [group, "__cell"]
    )
    order = W.partitionBy(group, "slot", "__cell").orderBy(digest)
    return (
        inside.withColumn("__rank", F.row_number().over(order))
        .filter(F.col("__rank") == F.col("__within"))
        .select(group, "slot", F.col(digest).alias("cutoff"))
    )


def dense_positions(
    rows: DataFrame, group: str, digest: str, out: str = "position", digits: int = CELL_DIGITS
) -> DataFrame:
    """Zero-based position of every row in its group, in digest order."""
    offsets = _with_offsets(_cell_counts(rows, group, digest, digits), group).drop("__n")
    order = W.partitionBy(group, "__cell").orderBy(digest)
    return (
        rows.withColumn("__cell", _cell(digest, digits))
        .join(offsets, [group, "__cell"])
        .withColumn(out, F.col("__before") + F.row_number().over(order) - 1)
        .drop("__cell", "__before")
    )
