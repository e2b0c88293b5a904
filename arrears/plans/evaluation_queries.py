"""Metrics and curves over a rule-based score, so that they need no training."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrears.operators import evaluate
from arrears.plans.model_table import KEY, LABELLED_SQL
from arrears.plans.registry import query, table
from arrears.plans.sampling_queries import labelled


def scored(spark, folder):
    """Score grows with age; the hard prediction cuts it."""
    df = labelled(spark, folder)
    return df.select(
        KEY,
        "label",
        (F.col("idade_divida_dias") / 2500.0).alias("score"),
        F.when(F.col("idade_divida_dias") > 1700.0, 1.0).otherwise(0.0).alias("prediction"),
    )


SCORED_SQL = (
    LABELLED_SQL
    + """,
scored AS (
  SELECT numero_inscricao, label, idade_divida_dias / 2500.0::DOUBLE AS score,
         CASE WHEN idade_divida_dias > 1700 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM labelled),
counts AS (
  SELECT count(*)::DOUBLE AS n, count(*) FILTER (WHERE label = 1 AND prediction = 1)::DOUBLE AS tp,
         count(*) FILTER (WHERE label = 0 AND prediction = 1)::DOUBLE AS fp,
         count(*) FILTER (WHERE label = 1 AND prediction = 0)::DOUBLE AS fn,
         count(*) FILTER (WHERE label = 0 AND prediction = 0)::DOUBLE AS tn FROM scored),
sides AS (
  SELECT 1.0::DOUBLE AS class, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, tp + fn AS support FROM counts
  UNION ALL SELECT 0.0, tn / (tn + fn), tn / (tn + fp), tn + fp FROM counts),
classes AS (SELECT *, 2 * precision * recall / (precision + recall) AS f1 FROM sides)
"""
)


@query(
    "confusion_matrix",
    f"WITH {SCORED_SQL} SELECT label, prediction, count(*)::BIGINT AS n FROM scored GROUP BY 1, 2",
)
def confusion_matrix(spark, folder):
    return evaluate.confusion(scored(spark, folder))


THREE_SQL = """WITH t AS (SELECT (o_orderkey % 3)::DOUBLE AS label, (o_custkey % 3)::DOUBLE AS prediction FROM orders),
c AS (SELECT * FROM (VALUES (0.0::DOUBLE), (1.0::DOUBLE), (2.0::DOUBLE)) v(c))
SELECT l.c AS label, p.c AS prediction, (SELECT count(*) FROM t WHERE t.label = l.c AND t.prediction = p.c)::BIGINT AS n FROM c l, c p"""


@query("confusion_three_classes", THREE_SQL)
def confusion_three_classes(spark, folder):
    """Classes found in the data: none is left out."""
    return evaluate.confusion(
        table(spark, folder, "orders").select(
            (F.col("o_orderkey") % 3).alias("label"), (F.col("o_custkey") % 3).alias("prediction")
        )
    )


@query(
    "metrics_weighted",
    f"""WITH {SCORED_SQL} SELECT (SELECT round((tp + tn) / n, 6) FROM counts) AS accuracy,
        {", ".join(f"round(sum({m} * support) / sum(support), 6) AS {m}" for m in ("precision", "recall", "f1"))} FROM classes""",
)
def metrics_weighted(spark, folder):
    row = evaluate.weighted_metrics(scored(spark, folder))
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


@query(
    "class_report",
    f"""WITH {SCORED_SQL}
        SELECT CASE class WHEN 1 THEN '1.0' ELSE '0.0' END AS row, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support FROM classes
        UNION ALL SELECT 'accuracy', round((tp + tn) / n, 6), round((tp + tn) / n, 6), round((tp + tn) / n, 6), n::BIGINT FROM counts
        UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM classes
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                         round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM classes""",
)
def class_report(spark, folder):
    report = evaluate.class_report(scored(spark, folder))
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    "f1_binary",
    f"""WITH {SCORED_SQL} SELECT round((tp + tn) / n, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
        round(200 * tp / (2 * tp + fp + fn), 6) AS f1_percent FROM counts""",
)
def f1_binary(spark, folder):
    row = evaluate.binary_metrics(scored(spark, folder))
    return row.select(
        *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall")],
        F.round(F.col("f1") * 100, 6).alias("f1_percent"),
    )


@query(
    "log_loss",
    f"""WITH {SCORED_SQL}, p AS (SELECT label, least(greatest(prediction, 2.220446049250313e-16::DOUBLE), 1::DOUBLE - 2.220446049250313e-16::DOUBLE) AS hard,
             least(greatest(score, 2.220446049250313e-16::DOUBLE), 1::DOUBLE - 2.220446049250313e-16::DOUBLE) AS soft FROM scored)
        SELECT round(avg(-CASE WHEN label = 1 THEN ln(hard) ELSE ln(1 - hard) END), 6) AS hard_loss,
               round(avg(-CASE WHEN label = 1 THEN ln(soft) ELSE ln(1 - soft) END), 6) AS soft_loss FROM p""",
)
def log_loss(spark, folder):
    df = scored(spark, folder)
    soft = evaluate.log_loss(df, probability="score").select(F.round("log_loss", 6).alias("soft_loss"))
    hard = evaluate.log_loss(df).select(F.round("log_loss", 6).alias("hard_loss"))
    one = F.lit(1).alias("one")
    return hard.select("*", one).join(soft.select("*", one), "one").drop("one")


@query("hit_rate", f"WITH {SCORED_SQL} SELECT round(tp / (tp + fn), 6) AS hit_rate FROM counts")
def hit_rate(spark, folder):
    return evaluate.hit_rate(scored(spark, folder), "sim").withColumn("hit_rate", F.round("hit_rate", 6))


@query(
    "roc_hard",
    f"""WITH {SCORED_SQL} SELECT 1.0::DOUBLE AS threshold, round(fp / (fp + tn), 6) AS fpr, round(tp / (tp + fn), 6) AS tpr FROM counts
        UNION ALL SELECT 0.0, 1.0, 1.0 UNION ALL SELECT 'Infinity'::DOUBLE, 0.0, 0.0""",
)
def roc_hard(spark, folder):
    points = evaluate.roc_points(scored(spark, folder), score="prediction")
    return points.withColumns({"fpr": F.round("fpr", 6), "tpr": F.round("tpr", 6)})


CURVE_SQL = (
    SCORED_SQL
    + """,
steps AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1),
curve AS (
  SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
         sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM steps)
"""
)


@query(
    "roc_auc",
    f"WITH {CURVE_SQL} SELECT round(sum(neg * (tp - pos / 2)) / (max(p) * max(n)), 6) AS auc FROM curve",
)
def roc_auc(spark, folder):
    return evaluate.roc_auc(scored(spark, folder)).withColumn("auc", F.round("auc", 6))


@query(
    "roc_curve",
    f"""WITH {CURVE_SQL} SELECT round(score, 6) AS threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM curve
        UNION ALL SELECT 'Infinity'::DOUBLE, 0.0, 0.0""",
)
def roc_curve(spark, folder):
    points = evaluate.roc_points(scored(spark, folder))
    return points.withColumns(
        {"threshold": F.when(F.col("threshold") < 1e300, F.round("threshold", 6)).otherwise(F.col("threshold")),
         "fpr": F.round("fpr", 6), "tpr": F.round("tpr", 6)}
    )


@query(
    "pr_curve",
    f"""WITH {CURVE_SQL} SELECT round(score, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / p, 6) AS recall FROM curve
        UNION ALL SELECT NULL, 1.0, 0.0""",
)
def pr_curve(spark, folder):
    points = evaluate.pr_points(scored(spark, folder))
    return points.withColumns({c: F.round(c, 6) for c in points.columns})


@query(
    "champion",
    f"""WITH {SCORED_SQL}, cut AS (
          SELECT name, place, count(*) FILTER (WHERE label = 1 AND score > c) AS tp, count(*) FILTER (WHERE label = 0 AND score > c) AS fp,
                 count(*) FILTER (WHERE label = 1 AND score <= c) AS fn
          FROM scored, (VALUES ('early', 1, 0.5), ('middle', 2, 0.7), ('late', 3, 0.8)) v(name, place, c) GROUP BY 1, 2)
        SELECT name, round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 6) AS score FROM cut ORDER BY 2 DESC, place LIMIT 1""",
)
def champion(spark, folder):
    """The best of three score cuts by F1."""
    df = scored(spark, folder)
    rules = (("early", 1, 0.5), ("middle", 2, 0.7), ("late", 3, 0.8))
    scores = None
    for name, place, cut in rules:
        hard = df.withColumn("prediction", F.when(F.col("score") > cut, 1.0).otherwise(0.0))
        row = evaluate.binary_metrics(hard).select(
            F.lit(name).alias("name"), F.lit(place).alias("place"), F.col("f1").alias("score")
        )
        scores = row if scores is None else scores.unionByName(row)
    return evaluate.champion(scores).withColumn("score", F.round("score", 6))


@query("actual_vs_pred", f"WITH {SCORED_SQL} SELECT numero_inscricao, label, prediction FROM scored")
def actual_vs_pred(spark, folder):
    return evaluate.actual_and_predicted(scored(spark, folder), KEY)
