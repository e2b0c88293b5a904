"""The debt and registry tables, read from orders and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.functions.dates import age_in_days
from arrears.functions.hashing import digest, unit
from arrears.plans.registry import table

REFERENCE_DAY = "2001-09-01"

# The attributes of the model table.
NUMERIC = ["idade_divida_dias"]
CATEGORICAL = [
    "tipo_devedor",
    "nm_porte",
    "origem",
    "situacao_inscricao",
    "nm_situacao_cadastral",
    "nm_regiao_politica",
]
KEY = "numero_inscricao"
TARGET = "target"


def debts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per debt with a learnable text target."""
    age = age_in_days(F.col("o_orderdate"), REFERENCE_DAY).cast("double")
    u = unit(digest("label", "o_orderkey"))
    target = (
        F.when(F.col("idade_divida_dias") + F.lit(600.0) * u > 2000.0, "SIM")
        .when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "NAO")
        .otherwise("não")
    )
    return (
        table(spark, folder, "orders")
        .withColumn("idade_divida_dias", age)
        .select(
            F.col("o_orderkey").alias("numero_inscricao"),
            F.col("o_custkey").alias("cpf_cnpj"),
            "idade_divida_dias",
            F.col("o_totalprice").alias("valor_consolidado"),
            F.col("o_orderpriority").alias("origem"),
            F.col("o_orderstatus").alias("situacao_inscricao"),
            F.to_date("o_orderdate").alias("data_inscricao"),
            target.alias("target"),
        )
    )


def companies(spark: SparkSession, folder: str) -> DataFrame:
    """Company registry: one row per id."""
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("c_custkey").alias("cd_cnpj"),
            F.col("c_name").alias("nm_empresarial"),
            F.col("c_acctbal").alias("vl_capital_social"),
            F.col("c_mktsegment").alias("nm_porte"),
            F.col("n_name").alias("tipo_devedor"),
            F.col("r_name").alias("nm_regiao_politica"),
            F.when(F.col("c_acctbal") < 0, "INAPTA").otherwise("ATIVA").alias("nm_situacao_cadastral"),
        )
    )


def model_table(spark: SparkSession, folder: str) -> DataFrame:
    """Debts with the registry attributes: key, one number, six texts, target."""
    joined = debts(spark, folder).join(companies(spark, folder), F.col("cpf_cnpj") == F.col("cd_cnpj"))
    return joined.select(KEY, *NUMERIC, *CATEGORICAL, TARGET)


# The same tables as SQL, for the comparison queries.
DEBTS_SQL = """
debts0 AS (
  SELECT *, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-09-01')::DOUBLE AS age,
         ('0x' || substr(md5('label:' || o_orderkey), 1, 13))::BIGINT::DOUBLE / 4503599627370496::DOUBLE AS u
  FROM orders),
debts AS (
  SELECT o_orderkey AS numero_inscricao, o_custkey AS cpf_cnpj, age AS idade_divida_dias,
         o_totalprice AS valor_consolidado, o_orderpriority AS origem, o_orderstatus AS situacao_inscricao,
         CAST(o_orderdate AS DATE) AS data_inscricao,
         CASE WHEN age + 600::DOUBLE * u > 2000::DOUBLE THEN 'SIM'
              WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'NAO' ELSE 'não' END AS target
  FROM debts0)
"""
COMPANIES_SQL = """
companies AS (
  SELECT c_custkey AS cd_cnpj, c_name AS nm_empresarial, c_acctbal AS vl_capital_social,
         c_mktsegment AS nm_porte, n_name AS tipo_devedor, r_name AS nm_regiao_politica,
         CASE WHEN c_acctbal < 0 THEN 'INAPTA' ELSE 'ATIVA' END AS nm_situacao_cadastral
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""
LABELLED_SQL = (
    DEBTS_SQL
    + """,
labelled AS (
  SELECT *, CASE WHEN target = 'SIM' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM debts)
"""
)
MODEL_SQL = (
    LABELLED_SQL
    + ","
    + COMPANIES_SQL
    + """,
model AS (
  SELECT numero_inscricao, idade_divida_dias, tipo_devedor, nm_porte, origem, situacao_inscricao,
         nm_situacao_cadastral, nm_regiao_politica, target, label
  FROM labelled JOIN companies ON cpf_cnpj = cd_cnpj)
"""
)
