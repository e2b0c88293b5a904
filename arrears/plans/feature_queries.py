"""Features over the debts; line items stand for the snapshots of a debt."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrears.functions.labels import encode_label
from arrears.operators import features
from arrears.plans.model_table import LABELLED_SQL, REFERENCE_DAY, debts
from arrears.plans.registry import query, table
from arrears.session import fresh_path
from arrears.sources import snapshots
from arrears.sources.tables import stage


@query(
    "debt_age",
    """SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-09-01')::INTEGER AS idade_divida_dias,
              date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-09-01') > 1825 AS acima_do_limite FROM orders""",
)
def debt_age(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return features.debt_age(df, "o_orderdate", REFERENCE_DAY).drop("o_orderdate")


@query(
    "debtor_totals",
    """WITH t AS (SELECT o_custkey, quarter(o_orderdate) AS trimestre, o_orderkey, o_totalprice FROM orders)
       SELECT o_orderkey, round(sum(o_totalprice) OVER w, 2) AS ttl_divida, count(*) OVER w AS ttl_inscricoes,
              round(o_totalprice / sum(o_totalprice) OVER w, 6) AS perc_inscricao
       FROM t WINDOW w AS (PARTITION BY o_custkey, trimestre)""",
)
def debtor_totals(spark, folder):
    df = table(spark, folder, "orders").select(
        "o_custkey", F.quarter("o_orderdate").alias("trimestre"), "o_orderkey", "o_totalprice"
    )
    out = features.debtor_totals(df, "o_custkey", ["trimestre"], "o_totalprice", ["o_orderkey"])
    return out.select(
        "o_orderkey", F.round("ttl_divida", 2).alias("ttl_divida"), "ttl_inscricoes",
        F.round("perc_inscricao", 6).alias("perc_inscricao"),
    )


# one row per debt and quarter of the year, from the line items
SNAPSHOTS_SQL = """snapshots AS (
  SELECT l_orderkey AS inscricao, quarter(l_shipdate) AS tri, sum(l_quantity) AS valor,
         CASE WHEN max(l_returnflag) = 'R' THEN 'SIM' ELSE 'NAO' END AS ajuizado
  FROM lineitem GROUP BY 1, 2)"""


def _snapshots(spark, folder):
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("inscricao"), F.quarter("l_shipdate").alias("tri"))
        .agg(
            F.sum("l_quantity").alias("valor"),
            F.when(F.max("l_returnflag") == "R", "SIM").otherwise("NAO").alias("ajuizado"),
        )
    )


@query(
    "quarter_pair",
    f"""WITH {SNAPSHOTS_SQL} SELECT a.inscricao, a.valor, b.valor AS valor_4
        FROM snapshots a LEFT JOIN snapshots b ON a.inscricao = b.inscricao AND b.tri = 4 WHERE a.tri = 1""",
)
def quarter_pair(spark, folder):
    df = _snapshots(spark, folder)
    first, later = df.filter("tri = 1"), df.filter("tri = 4")
    return features.pair_snapshots(first, later, "inscricao", ["valor"], "_4").select("inscricao", "valor", "valor_4")


@query(
    "target_from_snapshots",
    f"""WITH {SNAPSHOTS_SQL} SELECT a.inscricao, b.ajuizado AS target
        FROM snapshots a JOIN snapshots b ON a.inscricao = b.inscricao AND b.tri = 4 WHERE a.tri = 1 AND a.ajuizado <> 'SIM'""",
)
def target_from_snapshots(spark, folder):
    df = _snapshots(spark, folder)
    first, later = df.filter("tri = 1"), df.filter("tri = 4")
    return features.target_from_snapshots(first, later, "inscricao", "ajuizado").select("inscricao", "target")


def _landed(spark, folder):
    """The snapshots, landed quarter after quarter in a bucketed table."""
    df = stage(_snapshots(spark, folder), "snapshots")
    path, buckets = fresh_path(spark, "snapshots-by-debt"), snapshots.buckets_for(df.count(), 100_000)
    name = path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")
    for quarter in (1, 2, 3, 4):
        landed = snapshots.land_snapshot(df.filter(F.col("tri") == quarter), name, path, "inscricao", "tri", buckets)
    return landed


@query(
    "quarter_pair_bucketed",
    f"""WITH {SNAPSHOTS_SQL} SELECT a.inscricao, a.valor, b.valor AS valor_4
        FROM snapshots a LEFT JOIN snapshots b ON a.inscricao = b.inscricao AND b.tri = 4 WHERE a.tri = 1""",
)
def quarter_pair_bucketed(spark, folder):
    df = _landed(spark, folder)
    first, later = df.filter("tri = 1"), df.filter("tri = 4")
    return features.pair_snapshots(first, later, "inscricao", ["valor"], "_4").select("inscricao", "valor", "valor_4")


@query(
    "target_bucketed",
    f"""WITH {SNAPSHOTS_SQL} SELECT a.inscricao, b.ajuizado AS target
        FROM snapshots a JOIN snapshots b ON a.inscricao = b.inscricao AND b.tri = 4 WHERE a.tri = 1 AND a.ajuizado <> 'SIM'""",
)
def target_bucketed(spark, folder):
    df = _landed(spark, folder)
    first, later = df.filter("tri = 1"), df.filter("tri = 4")
    return features.target_from_snapshots(first, later, "inscricao", "ajuizado").select("inscricao", "target")


@query(
    "value_bands",
    """SELECT (CASE WHEN o_totalprice >= 1000000 THEN 5 WHEN o_totalprice >= 100000 THEN 4 WHEN o_totalprice >= 10000 THEN 3
                    WHEN o_totalprice >= 1000 THEN 2 WHEN o_totalprice >= 100 THEN 1 ELSE 0 END)::INTEGER AS faixa,
              count(*)::BIGINT AS n FROM orders GROUP BY 1""",
)
def value_bands(spark, folder):
    banded = table(spark, folder, "orders").select(features.value_band(F.col("o_totalprice")).alias("faixa"))
    return banded.groupBy("faixa").agg(F.count(F.lit(1)).alias("n"))


@query(
    "status_flips",
    f"""WITH {SNAPSHOTS_SQL}, w AS (SELECT *, lag(ajuizado) OVER (PARTITION BY inscricao ORDER BY tri) AS before FROM snapshots)
        SELECT inscricao, tri::INTEGER AS tri FROM w WHERE before = 'SIM' AND ajuizado <> 'SIM'""",
)
def status_flips(spark, folder):
    return features.status_flips(_snapshots(spark, folder), "inscricao", "tri", "ajuizado").select("inscricao", "tri")


@query(
    "sued_before",
    """WITH t AS (SELECT o_custkey, o_orderkey, year(o_orderdate) AS ano, CASE WHEN o_orderstatus = 'F' THEN 'SIM' ELSE 'NAO' END AS ajuizado FROM orders),
       f AS (SELECT o_custkey, min(ano) AS first_year FROM t WHERE ajuizado = 'SIM' GROUP BY 1)
       SELECT o_orderkey, coalesce(first_year < ano, FALSE) AS ja_ajuizado FROM t LEFT JOIN f USING (o_custkey)""",
)
def sued_before(spark, folder):
    df = table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", F.year("o_orderdate").alias("ano"),
        F.when(F.col("o_orderstatus") == "F", "SIM").otherwise("NAO").alias("ajuizado"),
    )
    return features.sued_before(df, "o_custkey", "ano", "ajuizado", ["o_orderkey"]).select("o_orderkey", "ja_ajuizado")


@query(
    "leakage_check",
    f"""WITH {LABELLED_SQL}, b AS (SELECT floor(idade_divida_dias / 400)::BIGINT AS value, label FROM labelled)
        SELECT value, count(*)::BIGINT AS n, count(DISTINCT label)::BIGINT AS labels, count(DISTINCT label) = 1 AS one_label FROM b GROUP BY 1""",
)
def leakage_check(spark, folder):
    """Age classes in which only one label occurs."""
    df = debts(spark, folder).select(
        F.floor(F.col("idade_divida_dias") / 400).alias("age_class"), encode_label("target").alias("label")
    )
    return features.leakage(df, "age_class", "label")


