"""Archives to one table, schema survey, page links and file-once landing."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrears.plans.landing_fixture import LANDED_SQL, LAYOUTS, landed
from arrears.plans.registry import query, table
from arrears.session import fresh_path
from arrears.sources import archives, pages
from arrears.streaming.landing import land_new_archives, land_new_files, landed_rows

COLUMNS = sorted({c for names, _ in LAYOUTS.values() for c in names})


def _members(spark, folder):
    return archives.list_members(spark, landed(spark, folder))


RAW_SQL = f"""WITH {LANDED_SQL},
raw AS (
  SELECT archive, member, ano, tri, ending,
         o_custkey || '.' || lpad(o_orderkey::VARCHAR, 9, '0') || '/0001-07' AS CPF_CNPJ,
         strftime(o_orderdate, '%d/%m/%Y') AS DATA_INSCRICAO,
         CASE WHEN o_orderstatus = 'F' THEN 'SIM' ELSE 'NÃO' END AS INDICADOR_AJUIZADO,
         CASE WHEN o_orderpriority <> '5-LOW' THEN 'Construção ' || o_custkey END AS NOME_DEVEDOR,
         o_orderkey::VARCHAR AS NUMERO_INSCRICAO,
         'EM; COBRANÇA ' || o_orderstatus AS SITUACAO_INSCRICAO,
         CASE WHEN ending <> 'FGTS' THEN 'PRINCIPAL' END AS TIPO_DEVEDOR,
         CASE WHEN o_orderstatus = 'P' THEN 'Pessoa física' ELSE 'Pessoa jurídica' END AS TIPO_PESSOA,
         'Em cobrança' AS TIPO_SITUACAO_INSCRICAO,
         CASE WHEN ending <> 'Previdenciario' THEN 'UNIÃO' END AS UNIDADE_RESPONSAVEL,
         floor(o_totalprice * 100 + 0.5)::BIGINT::VARCHAR AS VALOR_CONSOLIDADO
  FROM files)
"""


@query(
    "ingest_delimited",
    RAW_SQL + f"SELECT {', '.join(archives.DEBT_COLUMNS)}, archive, member FROM raw",
)
def ingest_delimited(spark, folder):
    raw = archives.read_members(_members(spark, folder))
    return raw.withColumn("archive", F.substring_index("archive", "/", -1))


@query(
    "ingest_large",
    RAW_SQL + f"SELECT {', '.join(archives.DEBT_COLUMNS)}, archive, member FROM raw",
)
def ingest_large(spark, folder):
    """The same rows where each member is inflated by one task and parsed, block by block, in many."""
    raw, _ = archives.load_large_members(_members(spark, folder), block_bytes=1 << 14)
    return raw.withColumn("archive", F.substring_index("archive", "/", -1))


HARMONISED_SQL = (RAW_SQL
    + f"""SELECT {', '.join(archives.DEBT_COLUMNS)},
            CASE WHEN length(regexp_replace(CPF_CNPJ, '[-./]', '', 'g')) < 14 THEN lpad(regexp_replace(CPF_CNPJ, '[-./]', '', 'g'), 14, '0')
                 ELSE regexp_replace(CPF_CNPJ, '[-./]', '', 'g') END AS CNPJ,
            member AS FILE_NAME, ano::VARCHAR AS ANO, tri::VARCHAR AS TRIMESTRE,
            CASE ending WHEN 'FGTS' THEN 'FGTS' WHEN 'Nao_Previdenciario' THEN 'SIDA' WHEN 'Previdenciario' THEN 'PREV' ELSE 'DESCONHECIDO' END AS ORIGEM
          FROM raw WHERE TIPO_PESSOA = 'Pessoa jurídica'"""
)


@query("harmonise", HARMONISED_SQL)
def harmonise(spark, folder):
    return archives.harmonise(archives.read_members(_members(spark, folder)))


@query("ingest_written", HARMONISED_SQL)
def ingest_written(spark, folder):
    """The ingest job from archives, damaged ones among them, to the table by year and quarter, read back."""
    return archives.ingest(spark, landed(spark, folder, damaged=True), fresh_path(spark, "debts"))[0]


@query(
    "ingest_errors",
    f"""WITH {LANDED_SQL}, a AS (SELECT DISTINCT archive, ending FROM files)
        SELECT archive, 'vazio.csv' AS member, 0::BIGINT AS rows_read, 'empty' AS problem FROM a
        UNION ALL SELECT archive, 'quebrado.csv', 1, 'parse' FROM a WHERE ending = 'FGTS'
        UNION ALL SELECT 'avulso_' || archive, NULL, 0, 'archive' FROM a WHERE ending = 'FGTS'""",
)
def ingest_errors(spark, folder):
    """What the ingest job could not read: one row for each bad archive or member, none of whose rows are kept."""
    _, problems = archives.ingest(spark, landed(spark, folder, damaged=True), fresh_path(spark, "debts"), chunk_rows=1)
    return problems.withColumn("archive", F.substring_index("archive", "/", -1))


@query(
    "ingest_counts",
    f"WITH {LANDED_SQL} SELECT archive || '::' || member AS file, count(*)::BIGINT AS n FROM files GROUP BY 1",
)
def ingest_counts(spark, folder):
    return archives.rows_by_file(archives.read_members(_members(spark, folder)))


def _has(column: str) -> str:
    held = [e for e, (names, _) in LAYOUTS.items() if column in names]
    listed = ", ".join(f"'{e}'" for e in held)
    return f"max(CASE WHEN ending IN ({listed}) THEN 1 ELSE 0 END)::INTEGER AS {column}"


@query(
    "column_matrix",
    f"WITH {LANDED_SQL} SELECT archive || '::' || member AS file, {', '.join(_has(c) for c in COLUMNS)} FROM files GROUP BY 1",
)
def column_matrix(spark, folder):
    return archives.column_matrix(archives.member_columns(_members(spark, folder)), COLUMNS)


@query(
    "common_columns",
    f"""WITH {LANDED_SQL}, layouts(ending, names) AS (VALUES {", ".join(f"('{e}', {names!r})" for e, (names, _) in LAYOUTS.items())}),
        held AS (SELECT DISTINCT archive, unnest(names) AS name FROM files JOIN layouts USING (ending))
        SELECT name AS "column" FROM held GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT archive) FROM files)""",
)
def common_columns(spark, folder):
    return archives.common_columns(archives.member_columns(_members(spark, folder)))


# --- pages and manifests ---------------------------------------------------

SUFFIXES = (".", "ent", "tion", "en")

LINKS_SQL = r"""WITH a AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '(?i)<a\s(?:[^>]*?\s)?href\s*=\s*"([^"]*)"', 1)) AS raw FROM pages),
h AS (SELECT page_id, url, replace(raw, '&amp;', '&') AS href FROM a),
links AS (
  SELECT page_id, href, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1) || href AS file_url,
         list_last(string_split(href, '/')) AS file_name FROM h
  WHERE lower(href) LIKE '%.' OR lower(href) LIKE '%ent' OR lower(href) LIKE '%tion' OR lower(href) LIKE '%en')
"""


@query("page_links", LINKS_SQL + "SELECT * FROM links")
def page_links(spark, folder):
    return pages.page_links(table(spark, folder, "pages"), SUFFIXES)


@query(
    "manifest_pending",
    LINKS_SQL
    + "SELECT DISTINCT file_name, file_url FROM links WHERE file_name NOT IN (SELECT file_name FROM links WHERE lower(href) LIKE '%tion')",
)
def manifest_pending(spark, folder):
    """Of all links, those whose file is not among the ones fetched before."""
    manifest = pages.page_links(table(spark, folder, "pages"), SUFFIXES).select("file_name", "file_url").distinct()
    fetched = pages.page_links(table(spark, folder, "pages"), ["tion"]).select("file_name").distinct()
    return pages.pending(manifest, fetched)


@query(
    "land_once",
    "SELECT event_type, count(*)::BIGINT AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY 1",
)
def land_once(spark, folder):
    """Two runs over the landed events; the second finds nothing new."""
    schema = table(spark, folder, "events").schema
    target, checkpoint = fresh_path(spark, "landed_events"), fresh_path(spark, "landed_state")
    for _ in range(2):
        land_new_files(spark, folder, schema, target, checkpoint, pattern="events.parquet")
    return spark.read.schema(schema).parquet(target).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


@query("land_archives", HARMONISED_SQL)
def land_archives(spark, folder):
    """Two runs over the landed archives; the second finds nothing new."""
    source = landed(spark, folder, damaged=True)
    target, problems, checkpoint = (fresh_path(spark, f"landed_{n}") for n in ("debts", "problems", "archives_state"))
    for _ in range(2):
        land_new_archives(spark, source, target, problems, checkpoint)
    return landed_rows(spark, target)
