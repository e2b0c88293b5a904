"""Equi-joins of debts with registries.

No join here carries a broadcast hint on table data: Catalyst broadcasts a
side only when its measured size is below the session's threshold. Where one
key may own a large share of the left rows, ``join_spread`` splits it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.sources.tables import stage

NULL_SPLITS = 4096


def suffix_clashes(
    left: DataFrame, right: DataFrame, on: Sequence[str], suffixes: tuple[str, str] = ("_x", "_y")
) -> tuple[DataFrame, DataFrame]:
    """Rename the non-key columns both sides have."""
    clash = (set(left.columns) & set(right.columns)) - set(on)
    return (
        left.withColumnsRenamed({c: c + suffixes[0] for c in clash}),
        right.withColumnsRenamed({c: c + suffixes[1] for c in clash}),
    )


def merge(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Join on equal key names; clashing columns get suffixes.

    ``null_safe`` lets null keys meet null keys; otherwise they meet nothing. All null keys of the left then meet all
    of the right, so the right side should have one row for each key.
    """
    left, right = suffix_clashes(left, right, on, suffixes)
    if not null_safe:
        return left.join(right, list(on), how)
    renamed = right.withColumnsRenamed({k: f"{k}__right" for k in on})
    condition = None
    for k in on:
        test = F.col(k).eqNullSafe(F.col(f"{k}__right"))
        condition = test if condition is None else condition & test
    return left.join(renamed, condition, how).drop(*[f"{k}__right" for k in on])


def cast_keys(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({k: F.col(k).cast(t) for k, t in types.items()})


def only_referenced(right: DataFrame, right_key: str, left: DataFrame, left_key: str) -> DataFrame:
    """Rows of ``right`` whose key occurs in ``left``; the key list stays distributed."""
    wanted = left.select(F.col(left_key).alias(right_key)).filter(F.col(right_key).isNotNull()).distinct()
    return right.join(wanted, right_key, "left_semi")


def enrich_reduced(
    left: DataFrame, left_key: str, right: DataFrame, right_key: str, row_key: Sequence[str]
) -> DataFrame:
    """Cut the registry down to the referenced keys, rename its key, left join.

    One count of the left keys gives both the keys referenced and the hot ones.
    """
    counts = stage(left.groupBy(left_key).agg(F.count(F.lit(1)).alias("__n")), "left-keys")
    reduced = right.withColumnRenamed(right_key, left_key).join(
        counts.filter(F.col(left_key).isNotNull()).select(left_key), left_key, "left_semi"
    )
    return join_spread(left, reduced, [left_key], row_key, counts=counts)


def join_spread(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    row_key: Sequence[str],
    how: str = "left",
    rows_per_split: int = 2_000_000,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Left or inner join in which a key with many left rows is worked on by many tasks.

    One pass counts left rows by key (combined before the shuffle; or ``counts`` has
    them as ``__n``) and keeps
    the keys above ``rows_per_split``: at most ``rows / rows_per_split`` of
    them, which bounds what is broadcast. Left rows of such a key are spread by
    a hash of ``row_key``; its right rows are repeated once per split. All other
    keys go through unsplit. Left rows with a null key match nothing and are
    spread as well. Clashing columns get suffixes.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    keys = list(on)
    left, right = suffix_clashes(left, right, keys)
    hot = (
        (left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")) if counts is None else counts)
        .filter(F.col("__n") > rows_per_split)
        .select(*keys, F.ceil(F.col("__n") / rows_per_split).cast("int").alias("__splits"))
    )
    number = F.xxhash64(*[F.col(k) for k in row_key])
    unkeyed = F.lit(False)
    for k in keys:
        unkeyed = unkeyed | F.col(k).isNull()
    spread: Column = (
        F.when(unkeyed, F.pmod(number, F.lit(NULL_SPLITS)))
        .when(F.col("__splits").isNotNull(), F.pmod(number, F.col("__splits").cast("bigint")))
        .otherwise(0)
        .cast("int")
    )
    left_salted = left.join(F.broadcast(hot), keys, "left").withColumn("__salt", spread).drop("__splits")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("__splits"), F.lit(1)) - 1)
    right_salted = (
        right.join(F.broadcast(hot), keys, "left").withColumn("__salt", F.explode(copies)).drop("__splits")
    )
    return left_salted.join(right_salted, [*keys, "__salt"], how).drop("__salt")
