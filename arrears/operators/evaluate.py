"""Metrics and curves of binary and multi-class predictions.

Everything starts from one grouping of the scored rows; what follows is as
small as the number of classes, or of distinct scores for the curves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arrears.functions.labels import target_class
from arrears.operators.quantiles import value_ranges
from arrears.sources.tables import stage


def _ratio(top: Column, bottom: Column) -> Column:
    """0 where the ratio is undefined."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def confusion(
    df: DataFrame, classes: Sequence[float] | None = None, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """(label, prediction, n) for every pair of classes, 0 where none occur.

    The classes are 0, 1 and all that occur on either side, null among them, so every row is counted; or only those
    listed, for a matrix of these alone.
    """
    cells = df.groupBy(F.col(label).cast("double").alias("l"), F.col(prediction).cast("double").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    seen = F.concat(F.array(F.lit(0.0), F.lit(1.0)), F.flatten(F.collect_list(F.array("l", "p"))))
    wanted = F.array_sort(F.array_distinct(seen)) if classes is None else F.array(*[F.lit(float(c)) for c in classes])
    # one row: as large as the matrix
    whole = cells.agg(
        F.map_from_entries(F.collect_list(F.struct(F.struct("l", "p"), "n"))).alias("counts"), wanted.alias("classes")
    )

    def cell(a: Column, b: Column) -> Column:
        n = F.element_at("counts", F.struct(a.alias("l"), b.alias("p")))
        return F.struct(a.alias("label"), b.alias("prediction"), F.coalesce(n, F.lit(0)).cast("bigint").alias("n"))

    pairs = F.flatten(F.transform("classes", lambda a: F.transform("classes", lambda b: cell(a, b))))
    return whole.select(F.inline(pairs))


def per_class(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(class, precision, recall, f1, support) for every class seen on either side."""
    cells = df.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = F.array(
        F.struct(F.col("l").alias("class"), F.col("n").alias("true_n"), F.lit(0).cast("bigint").alias("said_n"), F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("hit_n")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("true_n"), F.col("n").alias("said_n"), F.lit(0).cast("bigint").alias("hit_n")),
    )
    sums = cells.select(F.inline(sides)).groupBy("class").agg(
        F.sum("true_n").alias("support"), F.sum("said_n").alias("said"), F.sum("hit_n").alias("hits")
    )
    precision = _ratio(F.col("hits"), F.col("said"))
    recall = _ratio(F.col("hits"), F.col("support"))
    return sums.select("class", precision.alias("precision"), recall.alias("recall"), "support", "hits").select(
        "class",
        "precision",
        "recall",
        _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")).alias("f1"),
        "support",
        "hits",
    )


def weighted_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy, and precision, recall and F1 weighted by support."""
    total = F.sum("support")
    return per_class(df, label, prediction).agg(
        _ratio(F.sum("hits"), total).alias("accuracy"),
        *[_ratio(F.sum(F.col(m) * F.col("support")), total).alias(m) for m in ("precision", "recall", "f1")],
    )


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(row, precision, recall, f1, support): each class, accuracy, macro and weighted means."""
    classes = per_class(df, label, prediction)
    one = classes.agg(
        F.sum("support").alias("support"),
        _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")],
        *[_ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")],
    )

    def line(name: str, *values: Column) -> Column:
        parts = [v.cast("double").alias(n) for v, n in zip(values, ("precision", "recall", "f1"))]
        return F.struct(F.lit(name).alias("row"), *parts, F.col("support"))

    means = one.select(
        F.inline(
            F.array(
                line("accuracy", F.col("accuracy"), F.col("accuracy"), F.col("accuracy")),
                *[line(f"{k} avg", *[F.col(f"{k}_{m}") for m in ("precision", "recall", "f1")]) for k in ("macro", "weighted")],
            )
        )
    )
    return classes.select(F.col("class").cast("string").alias("row"), "precision", "recall", "f1", "support").unionByName(means)


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", positive: float = 1.0) -> DataFrame:
    """One row: accuracy, precision, recall and F1 of the positive class."""
    is_true, said = F.col(label) == positive, F.col(prediction) == positive
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(label) == F.col(prediction)).alias("right"),
        F.count_if(is_true & said).alias("tp"),
        F.count_if(said).alias("said"),
        F.count_if(is_true).alias("real"),
    )
    return counts.select(
        _ratio(F.col("right"), F.col("n")).alias("accuracy"),
        _ratio(F.col("tp"), F.col("said")).alias("precision"),
        _ratio(F.col("tp"), F.col("real")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("said") + F.col("real")).alias("f1"),
    )


def log_loss(df: DataFrame, label: str = "label", probability: str = "prediction", eps: float = 2.220446049250313e-16) -> DataFrame:
    """Mean negative log likelihood; takes probabilities or hard 0/1 values, clipped by ``eps``."""
    p = F.least(F.greatest(F.col(probability).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    loss = -F.when(F.col(label) == 1.0, F.log(p)).otherwise(F.log(1.0 - p))
    return df.agg(F.avg(loss).alias("log_loss"))


def hit_rate(df: DataFrame, target: str = "SIM", label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of the target class that was predicted right; 0 when it has no rows."""
    wanted = F.col(label) == target_class(target)
    return df.agg(
        _ratio(
            F.count_if(wanted & (F.col(prediction) == F.col(label))), F.count_if(wanted)
        ).alias("hit_rate")
    )


def _missing(score: str) -> Column:
    return F.col(score).isNull() | F.isnan(F.col(score).cast("double"))


def unscored(df: DataFrame, score: str = "score") -> DataFrame:
    """(rows, unscored): all rows, and those that curves leave out because their score is null or NaN."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(_missing(score)).alias("unscored"))


def _score_steps(df: DataFrame, label: str, score: str) -> DataFrame:
    """(score, tp, fp, positives, negatives): rows scoring at least ``score``.

    Rows collapse to distinct scores first, which are written once; null and NaN
    scores are left out (``unscored`` counts them). Distinct scores are cut into even
    ranges; each range is accumulated on its own and shifted by the sum of the
    ranges above it, so no window spans them all.
    """
    points = df.filter(~_missing(score)).groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1.0).alias("pos"), F.count_if(F.col(label) == 0.0).alias("neg")
    )
    points = stage(points, "score-points")
    edges = value_ranges(points, "score")
    if len(edges) >= 1:
        cut = Bucketizer(
            splits=[float("-inf"), *edges, float("inf")], inputCol="score", outputCol="range"
        )
        points = cut.transform(points)
    else:
        points = points.withColumn("range", F.lit(0.0))
    sums = points.groupBy("range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    above = W.partitionBy(F.lit(1)).orderBy(F.col("range").desc()).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(F.lit(1))  # one row per range
    shifts = sums.select(
        "range",
        F.coalesce(F.sum("p").over(above), F.lit(0)).alias("p0"),
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n0"),
        F.sum("p").over(whole).alias("positives"),
        F.sum("n").over(whole).alias("negatives"),
    )
    inside = W.partitionBy("range").orderBy(F.col("score").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    return points.join(F.broadcast(shifts), "range").select(
        "score",
        "pos",
        "neg",
        (F.col("p0") + F.sum("pos").over(inside)).alias("tp"),
        (F.col("n0") + F.sum("neg").over(inside)).alias("fp"),
        "positives",
        "negatives",
    )


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, and the start at (0, 0).

    With hard predictions as score this is the three-point curve.
    """
    steps = _score_steps(df, label, score).select(
        F.col("score").alias("threshold"),
        _ratio(F.col("fp"), F.col("negatives")).alias("fpr"),
        _ratio(F.col("tp"), F.col("positives")).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return steps.unionByName(start)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve, by trapezoids over the distinct scores.

    Null when a class has no rows.
    """
    area = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2.0))
    return _score_steps(df, label, score).agg(
        F.try_divide(area, F.max("positives").cast("double") * F.max("negatives")).alias("auc")
    )


def pr_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, precision, recall) for every distinct score, and the end at (1, 0)."""
    steps = _score_steps(df, label, score).select(
        F.col("score").alias("threshold"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("positives")).alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return steps.unionByName(end)


def champion(scores: DataFrame, name: str = "name", score: str = "score", place: str = "place") -> DataFrame:
    """The best-scored name; the one listed first wins a tie."""
    best = F.max_by(F.struct(name, score), F.struct(F.col(score), -F.col(place)))
    return scores.agg(best.alias("best")).select(f"best.{name}", f"best.{score}")


def actual_and_predicted(df: DataFrame, key: str, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.select(key, label, prediction)
