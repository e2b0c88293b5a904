"""Exact quantiles and modes that stay distributed.

Spark's exact ``median`` and ``mode`` keep every distinct value of a column in
one buffer. Here values are counted first, so copies collapse before they move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

EDGES = 512


def _long(df: DataFrame, columns: Sequence[str], cast: str) -> DataFrame:
    entries = [F.struct(F.lit(c).alias("name"), F.col(c).cast(cast).alias("value")) for c in columns]
    rows = df.select(F.inline(F.array(*entries))).filter(F.col("value").isNotNull())
    return rows.filter(~F.isnan("value")) if cast == "double" else rows


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent text per column, the smallest on a tie; one pass for all."""
    counts = _long(df, columns, "string").groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("name").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    return {r["name"]: r["mode"] for r in best.collect()}  # one row per column


def medians(df: DataFrame, columns: Sequence[str], small: int = 1_000_000) -> dict[str, float]:
    """Exact median per numeric column: the mean of the two middle values.

    While more than ``small`` values may hold the middle, a sketch proposes
    edges, all values are counted between them, and only the range around the
    middle is kept; each round narrows a column about ten-thousandfold. What is
    left is counted by value and accumulated. Only counts reach the driver.
    """
    columns = list(columns)
    if not columns:
        return {}
    long = _long(df, columns, "double")
    totals = {r["name"]: r["n"] for r in long.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}
    # per column: bounds, values below them, values inside them
    state = {c: (float("-inf"), float("inf"), 0, n) for c, n in totals.items()}
    open_columns = {c for c, n in totals.items() if n > small}
    while open_columns:
        progress = _narrow(_between(long, state), {c: state[c] for c in open_columns}, totals)
        for c in list(open_columns):
            stuck = progress[c][3] >= state[c][3]
            state[c] = progress[c]
            if stuck or progress[c][3] <= small:
                open_columns.discard(c)
    counts = _between(long, state).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = W.partitionBy("name").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    middle = df.sparkSession.createDataFrame(
        [(c, (n - 1) // 2 - state[c][2], n // 2 - state[c][2]) for c, n in totals.items()],
        "name string, lower bigint, upper bigint",
    )
    reach = counts.withColumn("upto", F.sum("n").over(upto)).join(F.broadcast(middle), "name")  # one row per column
    result = reach.groupBy("name").agg(
        F.min(F.when(F.col("upto") > F.col("lower"), F.col("value"))).alias("low"),
        F.min(F.when(F.col("upto") > F.col("upper"), F.col("value"))).alias("high"),
    )
    return {r["name"]: (r["low"] + r["high"]) / 2.0 for r in result.collect()}


def _between(long: DataFrame, state: dict[str, tuple]) -> DataFrame:
    """Values inside their column's bounds: lower edge included, upper edge not."""
    test = F.lit(False)
    for c, (low, high, _, _) in state.items():
        inside = F.col("name") == c
        if low != float("-inf"):
            inside = inside & (F.col("value") >= low)
        if high != float("inf"):
            inside = inside & (F.col("value") < high)
        test = test | inside
    return long.filter(test)


def _narrow(inside: DataFrame, state: dict[str, tuple], totals: dict[str, int]) -> dict[str, tuple]:
    """New bounds around the middle ranks of every column in ``state``."""
    wanted = inside.filter(F.col("name").isin(*state))
    probs = [i / EDGES for i in range(1, EDGES)]
    first = {c for c in state if state[c][0] == float("-inf") and state[c][1] == float("inf")}
    if first:  # nothing known yet: look closely at the middle
        probs = [0.495 + 0.01 * i / EDGES for i in range(EDGES + 1)]
    listed = ", ".join(f"{p!r}D" for p in probs)
    cuts = wanted.groupBy("name").agg(F.expr(f"percentile_approx(value, array({listed}), 10000)").alias("edges")).collect()
    edges = {r["name"]: sorted(set(r["edges"])) for r in cuts}
    table = inside.sparkSession.createDataFrame(list(edges.items()), "name string, edges array<double>")
    number = (
        F.when(F.col("value") < F.col("edges")[0], 0)
        .when(F.col("value") >= F.element_at("edges", -1), F.size("edges"))
        .otherwise(F.size(F.filter("edges", lambda e: e <= F.col("value"))))
    )
    sizes: dict[str, dict[int, int]] = {}
    counted = (
        wanted.join(F.broadcast(table), "name")  # one row per column
        .groupBy("name", number.alias("range"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    for r in counted:
        sizes.setdefault(r["name"], {})[r["range"]] = r["n"]
    result = {}
    for c, (low, high, below, _) in state.items():
        n = totals[c]
        lower, upper = (n - 1) // 2 - below, n // 2 - below
        before, start, stop, held = 0, None, None, 0
        for number_ in sorted(sizes[c]):
            size = sizes[c][number_]
            if start is None and lower < before + size:
                start, below = number_, below + before
            if start is not None and stop is None:
                held += size
                if upper < before + size:
                    stop = number_
            before += size
        bounds = [low, *edges[c], high]
        result[c] = (bounds[start], bounds[stop + 1], below, held)
    return result


def approximate_medians(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> dict[str, float]:
    """One-pass sketch; an actual value near the middle."""
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns if row[c] is not None}


def value_ranges(df: DataFrame, column: str, ranges: int = 4096) -> list[float]:
    """Sorted edges that cut a column into about even ranges; at most ``ranges`` numbers."""
    probs = ", ".join(f"{i / ranges!r}D" for i in range(1, ranges))
    row = df.agg(F.expr(f"percentile_approx({column}, array({probs}), 10000)").alias("e")).first()
    return sorted(set(row["e"])) if row["e"] else []
