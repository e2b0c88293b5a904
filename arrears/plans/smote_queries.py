"""Synthetic oversampling of the debt table."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrears.operators import evaluate, smote, train
from arrears.operators.profile import value_counts
from arrears.plans.model_table import KEY, LABELLED_SQL
from arrears.plans.registry import query
from arrears.plans.sampling_queries import SPLIT_SQL, labelled
from arrears.plans.training_queries import above_majority, prepared

SMOTE_SQL = f"""WITH {LABELLED_SQL},
f AS (SELECT numero_inscricao AS id, label, idade_divida_dias AS a, floor(valor_consolidado / 1000) AS b FROM labelled),
m AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || id)) - 1 AS pos, min(id) OVER (PARTITION BY a, b) AS vid,
             count(*) OVER (PARTITION BY a, b) AS times FROM f WHERE label = 1),
v AS (SELECT DISTINCT vid, a, b, times FROM m),
pairs AS (
  SELECT p.vid, p.times, q.vid AS nn, q.a AS na, q.b AS nb, q.times AS nn_times,
         (p.a - q.a) * (p.a - q.a) + (p.b - q.b) * (p.b - q.b) AS d2
  FROM v p JOIN v q ON p.vid <> q.vid WHERE p.times <= 5),
near AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY vid ORDER BY d2, nn) <= 5),
slots AS (SELECT *, times - 1 + sum(nn_times) OVER (PARTITION BY vid ORDER BY d2, nn) AS upto FROM near),
d AS (
  SELECT i AS draw, ('0x' || substr(md5('42:base:' || i), 1, 15))::BIGINT % (SELECT count(*) FROM m) AS pos,
         ('0x' || substr(md5('42:near:' || i), 1, 15))::BIGINT % 5 + 1 AS place,
         ('0x' || substr(md5('42:step:' || i), 1, 13))::BIGINT::DOUBLE / 4503599627370496::DOUBLE AS step
  FROM range((SELECT (count(*) FILTER (WHERE label = 0) - count(*) FILTER (WHERE label = 1))::BIGINT FROM f)) r(i)),
based AS (SELECT * FROM d JOIN m USING (pos))
SELECT id AS numero_inscricao, NULL::BIGINT AS draw, label, round(a, 6) AS a, round(b, 6) AS b FROM f
UNION ALL SELECT NULL, draw, 1.0, round(a, 6), round(b, 6) FROM based WHERE place < times
UNION ALL SELECT NULL, draw, 1.0, round(g.a + step * (s.na - g.a), 6), round(g.b + step * (s.nb - g.b), 6)
  FROM based g JOIN slots s USING (vid) WHERE g.place >= g.times AND place > upto - nn_times AND place <= upto
"""


@query("smote", SMOTE_SQL)
def smote_two_features(spark, folder):
    """Age and amount as whole numbers, so that distances are exact in both engines."""
    df = labelled(spark, folder).select(
        KEY, "label", F.array("idade_divida_dias", F.floor(F.col("valor_consolidado") / 1000).cast("double")).alias("features")
    )
    grown = smote.smote(df, KEY)
    return grown.select(
        KEY, "draw", "label", F.round(F.col("features")[0], 6).alias("a"), F.round(F.col("features")[1], 6).alias("b")
    )


@query(
    "smote_prepared",
    f"""WITH {LABELLED_SQL}, {SPLIT_SQL}, c AS (SELECT label, count(*) AS k FROM split WHERE NOT is_test GROUP BY 1)
        SELECT label, (SELECT max(k) FROM c) AS n FROM c""",
)
def smote_prepared(spark, folder):
    """Class sizes of the encoded train part after oversampling."""
    fit_part, _, _ = prepared(spark, folder)
    return value_counts(smote.smote(fit_part, KEY), "label")


BINARY = ("accuracy", "precision", "recall", "f1")


@query("train_balanced", "SELECT * FROM (VALUES " + ", ".join(f"('{n}', true)" for n in BINARY) + ") v(metric, above)")
def train_balanced(spark, folder):
    """Logistic regression on the oversampled train part; each metric of the test part against the majority share."""
    figures, test = balanced_figures(spark, folder)
    return above_majority(figures, test, BINARY)


def balanced_figures(spark, folder):
    fit_part, test, _ = prepared(spark, folder)
    grown = smote.smote(fit_part, KEY).select("label", "features").persist()
    model = train.logistic(grown.count()).fit(grown)
    grown.unpersist()
    return evaluate.binary_metrics(model.transform(test)), test
