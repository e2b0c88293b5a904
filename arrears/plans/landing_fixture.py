"""Zipped quarterly files made from the orders table, for the ingest queries.

Layouts drift by origin: columns come and go, half of the files are latin1.
Spark writes them; one archive holds at most about ``ROWS_PER_ARCHIVE`` rows,
so their number grows with the table.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.functions.hashing import digest, position
from arrears.plans.registry import table
from arrears.session import fresh_path
from arrears.sources.archives import DEBT_COLUMNS, _place, store_options

ROWS_PER_ARCHIVE = 100_000

# ending of the archive name -> (columns, encoding)
LAYOUTS = {
    "FGTS": ([c for c in DEBT_COLUMNS if c != "TIPO_DEVEDOR"] + ["ENTIDADE_RESPONSAVEL"], "utf-8"),
    "Nao_Previdenciario": (["TIPO_CREDITO", *DEBT_COLUMNS], "utf-8"),
    "Previdenciario": ([c for c in DEBT_COLUMNS if c != "UNIDADE_RESPONSAVEL"], "latin1"),
    "Outros": (list(reversed(DEBT_COLUMNS)), "latin1"),
}

_DONE: dict[tuple[str, str, bool], str] = {}


def _fields() -> dict:
    key, debtor = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    return {
        "CPF_CNPJ": F.concat(debtor, F.lit("."), F.lpad(key, 9, "0"), F.lit("/0001-07")),
        "DATA_INSCRICAO": F.date_format("o_orderdate", "dd/MM/yyyy"),
        "INDICADOR_AJUIZADO": F.when(F.col("o_orderstatus") == "F", "SIM").otherwise("NÃO"),
        "NOME_DEVEDOR": F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.concat(F.lit("Construção "), debtor)),
        "NUMERO_INSCRICAO": key,
        "SITUACAO_INSCRICAO": F.concat(F.lit('"EM; COBRANÇA '), F.col("o_orderstatus"), F.lit('"')),
        "TIPO_DEVEDOR": F.lit("PRINCIPAL"),
        "TIPO_PESSOA": F.when(F.col("o_orderstatus") == "P", "Pessoa física").otherwise("Pessoa jurídica"),
        "TIPO_SITUACAO_INSCRICAO": F.lit("Em cobrança"),
        "UNIDADE_RESPONSAVEL": F.lit("UNIÃO"),
        "VALOR_CONSOLIDADO": F.floor(F.col("o_totalprice") * 100 + 0.5).cast("bigint").cast("string"),
        "ENTIDADE_RESPONSAVEL": F.lit("CAIXA"),
        "TIPO_CREDITO": F.lit("TRIBUTÁRIO"),
    }


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """(archive, member, ending, key, line) of every order."""
    ending = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "FGTS")
        .when(F.col("o_orderpriority") == "2-HIGH", "Nao_Previdenciario")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Previdenciario")
        .otherwise("Outros")
    )
    orders = table(spark, folder, "orders").withColumns(
        {"ending": ending, "ano": F.year("o_orderdate"), "tri": F.quarter("o_orderdate")}
    )
    group = ["ano", "tri", "ending"]
    sizes = orders.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    fields = _fields()
    line = F.lit(None)
    for name, (columns, _) in LAYOUTS.items():
        line = F.when(F.col("ending") == name, F.concat_ws(";", *[fields[c] for c in columns])).otherwise(line)
    lot = position(digest("lote", "o_orderkey"), F.ceil(F.col("n") / ROWS_PER_ARCHIVE)).cast("string")
    prefix = F.concat(F.col("ano").cast("string"), F.lit("T"), F.col("tri").cast("string"))
    return orders.join(F.broadcast(sizes), group).select(  # one row per quarter and ending
        F.concat(prefix, F.lit("_lote"), lot, F.lit("_"), F.col("ending"), F.lit(".zip")).alias("archive"),
        F.concat(F.lit("arquivo_"), lot, F.lit(".csv")).alias("member"),
        "ending",
        F.col("o_orderkey").alias("key"),
        line.alias("line"),
    )


def landed(spark: SparkSession, folder: str, damaged: bool = False) -> str:
    """Folder with the archives; written once per session and input.

    ``damaged``: each archive also has an empty member, those of FGTS one that breaks off inside quotes, and for each
    of the latter there is a file that is no archive.
    """
    known = (spark.sparkContext.applicationId, folder, damaged)
    if known in _DONE:
        return _DONE[known]
    target = fresh_path(spark, "landing")
    options = store_options(spark)
    system, inner = _place(target, options)
    system.create_dir(inner, recursive=True)
    layouts = dict(LAYOUTS)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        system, inner = _place(target, options)
        stamp = uuid.uuid4().hex  # a retried task never shares a half-written file
        name, zipped, entry, out, done = None, None, None, None, []

        def close():
            entry.close()
            if damaged:
                zipped.writestr("vazio.csv", b"")
                if name.endswith("FGTS.zip"):
                    zipped.writestr("quebrado.csv", 'CPF_CNPJ;TIPO_PESSOA\r\n1;J\r\n2;"J\r\n'.encode())
                    with system.open_output_stream(f"{inner}/avulso_{name}") as loose:
                        loose.write(b"no archive")
            zipped.close()
            out.close()
            system.move(f"{inner}/{name}.{stamp}", f"{inner}/{name}")
            done.append(name)

        for batch in batches:
            for archive, part in batch.groupby("archive", sort=False):
                columns, encoding = layouts[part["ending"].iloc[0]]
                if archive != name:
                    if name is not None:
                        close()
                    name = archive
                    out = system.open_output_stream(f"{inner}/{name}.{stamp}")
                    zipped = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                    entry = zipped.open(part["member"].iloc[0], "w")
                    entry.write((";".join(f' "{c}"' for c in columns).strip() + "\r\n").encode(encoding))
                entry.write(("\r\n".join(part["line"]) + "\r\n").encode(encoding))
        if name is not None:
            close()
        yield pd.DataFrame({"archive": done}, dtype=object)

    tasks = spark.sparkContext.defaultParallelism * 4
    rows = _lines(spark, folder).repartition(tasks, "archive").sortWithinPartitions("archive", "key")
    rows.mapInPandas(write, "archive string").count()
    _DONE[known] = target
    return target


LANDED_SQL = """
parts AS (
  SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 'FGTS' WHEN '2-HIGH' THEN 'Nao_Previdenciario'
                 WHEN '3-MEDIUM' THEN 'Previdenciario' ELSE 'Outros' END AS ending,
         year(o_orderdate) AS ano, quarter(o_orderdate) AS tri FROM orders),
lots AS (
  SELECT *, (('0x' || substr(md5('lote:' || o_orderkey), 1, 15))::BIGINT
             % ceil(count(*) OVER (PARTITION BY ano, tri, ending) / 100000.0)::BIGINT)::VARCHAR AS lot FROM parts),
files AS (
  SELECT *, ano || 'T' || tri || '_lote' || lot || '_' || ending || '.zip' AS archive, 'arquivo_' || lot || '.csv' AS member FROM lots)
"""
