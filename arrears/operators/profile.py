"""Counts, null profiles, correlations and cross-tabulations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_mean(df: DataFrame, group: str, value: str, out: str = "mean") -> DataFrame:
    return df.groupBy(group).agg(F.avg(value).alias(out))


def non_null_count(df: DataFrame, name: str, out: str = "n") -> DataFrame:
    return df.agg(F.count(name).alias(out))


def null_profile(df: DataFrame, only_with_nulls: bool = False) -> DataFrame:
    """(column_name, data_type, non_null, nulls, null_share), most nulls first.

    One aggregate over all columns in one scan; NaN counts as missing.
    """
    types = dict(df.dtypes)

    def present(name: str):
        c = F.col(name)
        if types[name] in ("double", "float"):
            return F.count_if(c.isNotNull() & ~F.isnan(c))
        return F.count(c)

    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[present(c).alias(f"__c{i}") for i, c in enumerate(df.columns)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(types[c]).alias("data_type"),
                F.col(f"__c{i}").alias("non_null"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    out = (
        counts.select("__rows", F.inline(entries))
        .withColumn("nulls", F.col("__rows") - F.col("non_null"))
        .withColumn("null_share", F.when(F.col("__rows") > 0, F.col("nulls") / F.col("__rows")))
        .drop("__rows")
    )
    if only_with_nulls:
        out = out.filter(F.col("nulls") > 0)
    return out.orderBy(F.col("null_share").desc(), "column_name")


def value_counts(df: DataFrame, name: str, out: str = "n") -> DataFrame:
    return df.groupBy(name).agg(F.count(F.lit(1)).alias(out))


def imbalance(df: DataFrame, label: str) -> DataFrame:
    """(n_classes, min_count, max_count, ratio); the ratio is for two classes only."""
    sizes = value_counts(df.filter(F.col(label).isNotNull()), label)
    return sizes.agg(
        F.count(F.lit(1)).alias("n_classes"),
        F.min("n").alias("min_count"),
        F.max("n").alias("max_count"),
    ).withColumn(
        "ratio",
        F.when(
            F.col("n_classes") == 2,
            (F.col("max_count") - F.col("min_count")) / (F.col("max_count") + F.col("min_count")),
        ),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_a, column_b, corr) for every ordered pair; null pairs are skipped.

    Each unordered pair is computed once, all in one aggregate.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"__p{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            entries.append(F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.col(f"__p{i}").alias("corr")))
    return row.select(F.inline(F.array(*entries)))


def correlation_with(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """(column_name, corr) against ``target``, highest first."""
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"__p{i}") for i, c in enumerate(columns)])
    entries = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"__p{i}").alias("corr")) for i, c in enumerate(columns)]
    )
    return row.select(F.inline(entries)).orderBy(F.col("corr").desc_nulls_last(), "column_name")


def crosstab(df: DataFrame, rows: str, cols: str, values: Sequence[object]) -> DataFrame:
    """Counts of ``rows`` by the listed ``values`` of ``cols``; absent pairs are 0."""
    return df.groupBy(rows).agg(
        *[F.count_if(F.col(cols) == F.lit(v)).alias(str(v)) for v in values]
    )


def rank_by_size(df: DataFrame, value: str, name: str) -> DataFrame:
    """Largest absolute value first."""
    return df.orderBy(F.abs(F.col(value)).desc(), name)
