"""Features built from dated debts and quarterly snapshots.

Debtors can be very uneven, so per-debtor values are aggregated first and
joined back with hot debtors spread; no window runs over a debtor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arrears.functions.dates import age_in_days
from arrears.operators.joins import join_spread
from arrears.sources.tables import stage

LIMIT_DAYS = 5 * 365
BANDS = (100.0, 1_000.0, 10_000.0, 100_000.0, 1_000_000.0)


def debt_age(df: DataFrame, day: str, reference: str) -> DataFrame:
    """Age in days and whether it is beyond the five-year limit."""
    age = age_in_days(F.col(day), reference)
    return df.withColumns({"idade_divida_dias": age, "acima_do_limite": age > LIMIT_DAYS})


def value_band(value: Column, edges: Sequence[float] = BANDS) -> Column:
    """Number of edges at or below the value."""
    number = F.lit(0)
    for edge in edges:
        number = number + F.when(value >= edge, 1).otherwise(0)
    return F.when(value.isNotNull(), number)


def debtor_totals(df: DataFrame, debtor: str, period: Sequence[str], value: str, row_key: Sequence[str], rows_per_split: int = 2_000_000) -> DataFrame:
    """Each debt with its debtor's total, count and the debt's share in the period."""
    keys = [debtor, *period]
    totals = stage(
        df.groupBy(*keys).agg(F.sum(value).alias("ttl_divida"), F.count(F.lit(1)).alias("ttl_inscricoes")), "debtor-totals"
    )
    counts = totals.select(*keys, F.col("ttl_inscricoes").alias("__n"))  # they tell hot debtors too
    joined = join_spread(df, totals, keys, row_key, rows_per_split=rows_per_split, counts=counts)
    share = F.when(F.col("ttl_divida") != 0, F.col(value) / F.col("ttl_divida"))
    return joined.withColumn("perc_inscricao", share)


def pair_snapshots(first: DataFrame, later: DataFrame, key: str, columns: Sequence[str], suffix: str) -> DataFrame:
    """Rows of ``first`` with ``columns`` of the same debt in ``later``, suffixed."""
    renamed = later.select(key, *[F.col(c).alias(f"{c}{suffix}") for c in columns])
    return first.join(renamed, key, "left")


def target_from_snapshots(first: DataFrame, later: DataFrame, key: str, status: str, out: str = "target") -> DataFrame:
    """Debts not sued in ``first`` that occur in ``later``, with the later status as target.

    A missing status in ``first`` is not SIM, so such debts are open.
    """
    open_debts = first.filter(~F.col(status).eqNullSafe(F.lit("SIM")))
    return open_debts.join(later.select(key, F.col(status).alias(out)), key)


def status_flips(df: DataFrame, key: str, order: str, status: str) -> DataFrame:
    """(key, order) of every snapshot that turns from SIM to something else.

    A debt has one row per snapshot, so the window groups stay small.
    """
    before = F.lag(status).over(W.partitionBy(key).orderBy(order))
    return df.withColumn("__before", before).filter((F.col("__before") == "SIM") & (F.col(status) != "SIM")).drop("__before")


def sued_before(df: DataFrame, debtor: str, order: str, status: str, row_key: Sequence[str], out: str = "ja_ajuizado", rows_per_split: int = 2_000_000) -> DataFrame:
    """Whether the debtor had a sued debt in an earlier snapshot.

    The first sued snapshot per debtor decides, so one aggregate is enough.
    """
    first = df.filter(F.col(status) == "SIM").groupBy(debtor).agg(F.min(order).alias("__first"))
    joined = join_spread(df, first, [debtor], row_key, rows_per_split=rows_per_split)
    return joined.withColumn(out, F.coalesce(F.col("__first") < F.col(order), F.lit(False))).drop("__first")


def leakage(df: DataFrame, column: str, label: str) -> DataFrame:
    """(value, n, labels, one_label): levels of a feature that fix the label."""
    counts = df.groupBy(column, label).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(F.col(column).alias("value")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("labels"), (F.count(F.lit(1)) == 1).alias("one_label")
    )
