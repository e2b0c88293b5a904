"""Scans, sinks, projections, joins, aggregates and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.functions import dates, labels, text
from arrears.functions.hashing import digest, position, unit
from arrears.operators import joins, profile, sampling, shaping
from arrears.plans.model_table import COMPANIES_SQL, DEBTS_SQL, LABELLED_SQL, MODEL_SQL, companies, debts, model_table
from arrears.plans.registry import query, table
from arrears.session import fresh_path
from arrears.sources import tables

ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


# --- scans and sinks -------------------------------------------------------


@query("scan_parquet", ORDERS)
def scan_parquet(spark, folder):
    return tables.read_parquet(spark, f"{folder}/orders.parquet").withColumn("o_orderdate", F.to_date("o_orderdate"))


@query("scan_pruned", "SELECT o_orderkey, o_custkey FROM orders")
def scan_pruned(spark, folder):
    return tables.read_parquet(spark, f"{folder}/orders.parquet", ["o_orderkey", "o_custkey"])


@query("parquet_roundtrip", ORDERS)
def parquet_roundtrip(spark, folder):
    return tables.stage(_orders(spark, folder), "parquet_roundtrip")


@query(
    "partition_roundtrip",
    "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority = '2-HIGH'",
)
def partition_roundtrip(spark, folder):
    """Partitioned write, then a read that opens one partition folder."""
    path = fresh_path(spark, "partition_roundtrip")
    tables.write_parquet(
        _orders(spark, folder).select("o_orderkey", "o_totalprice", "o_orderpriority"), path, ["o_orderpriority"]
    )
    return spark.read.parquet(path).filter(F.col("o_orderpriority") == "2-HIGH")


@query(
    "csv_roundtrip",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem",
)
def csv_roundtrip(spark, folder):
    path = fresh_path(spark, "csv_roundtrip")
    cut = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    tables.write_csv(cut, path)
    return tables.read_csv(spark, path, cut.schema)


@query(
    "sorted_write",
    """SELECT count(*)::BIGINT AS n, TRUE AS in_order, min(o_custkey) AS lowest, max(o_custkey) AS highest FROM orders""",
)
def sorted_write(spark, folder):
    """Range-partitioned write; then every file is checked to hold one key range in order."""
    path = fresh_path(spark, "sorted_write")
    tables.write_sorted(_orders(spark, folder).select("o_custkey", "o_orderkey", "o_totalprice"), path, ["o_custkey", "o_orderkey"])
    return _key_ranges(spark.read.parquet(path))


def _key_ranges(written: DataFrame) -> DataFrame:
    from pyspark.sql import Window as W

    per_file = (
        written.withColumn("file", F.input_file_name())
        .groupBy("file")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct("o_custkey", "o_orderkey")).alias("first"),
            F.max(F.struct("o_custkey", "o_orderkey")).alias("last"),
        )
    )
    after = F.lag("last").over(W.partitionBy(F.lit(1)).orderBy("first"))  # one row per file
    return per_file.withColumn("follows", F.coalesce(after < F.col("first"), F.lit(True))).agg(
        F.sum("n").alias("n"),
        F.bool_and("follows").alias("in_order"),
        F.min("first.o_custkey").alias("lowest"),
        F.max("last.o_custkey").alias("highest"),
    )


@query(
    "split_n_ways",
    """SELECT (('0x' || substr(md5('42:' || o_orderkey), 1, 15))::BIGINT % 3 + 1)::INTEGER AS part,
              count(*)::BIGINT AS n, sum(o_orderkey)::BIGINT AS key_sum
       FROM orders GROUP BY 1""",
)
def split_n_ways(spark, folder):
    """Three even parts, one partition folder each, counted after reading back."""
    path = fresh_path(spark, "split_n_ways")
    tables.write_parquet(sampling.split_parts(_orders(spark, folder), 3, ["o_orderkey"]), path, ["part"])
    return spark.read.parquet(path).groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum")
    )


@query(
    "synth_frame",
    """SELECT o_orderkey AS id,
              ['A','B','C','D'][('0x' || substr(md5('categoria:' || o_orderkey), 1, 15))::BIGINT % 4 + 1] AS categoria,
              ('0x' || substr(md5('valor:' || o_orderkey), 1, 13))::BIGINT::DOUBLE / 4503599627370496::DOUBLE * 1000::DOUBLE AS valor
       FROM orders""",
)
def synth_frame(spark, folder):
    return _demo(spark, folder)


def _demo(spark, folder):
    """A random category and value for every order key."""
    ids = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"))
    choice = position(digest("categoria", "id"), F.lit(4)).cast("int")
    return ids.select(
        "id",
        F.element_at(F.array(*[F.lit(c) for c in "ABCD"]), choice + 1).alias("categoria"),
        (unit(digest("valor", "id")) * F.lit(1000.0)).alias("valor"),
    )


@query(
    "synth_mean",
    """SELECT round(avg(('0x' || substr(md5('valor:' || o_orderkey), 1, 13))::BIGINT::DOUBLE / 4503599627370496::DOUBLE * 1000::DOUBLE), 6) AS mean
       FROM orders""",
)
def synth_mean(spark, folder):
    return _demo(spark, folder).agg(F.round(F.avg("valor"), 6).alias("mean"))


@query(
    "hash_sample",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE md5('42:' || o_orderkey) < '1999999999999'",
)
def hash_sample(spark, folder):
    """A tenth of the rows."""
    return sampling.sample_rows(table(spark, folder, "orders"), 0.1, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


# --- projections and filters ----------------------------------------------


@query("drop_cols", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def drop_cols(spark, folder):
    """Absent names are ignored."""
    return table(spark, folder, "customer").drop("c_name", "c_acctbal", "not_there")


def _with_gaps(spark, folder):
    """Orders in which low-priority rows miss the price and finished ones the status."""
    return _orders(spark, folder).select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("o_totalprice"),
        F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(float("nan"))).otherwise(F.lit(1.0)).alias("factor"),
    )


GAPS_SQL = """
gaps AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS o_totalprice,
         nullif(o_orderstatus, 'F') AS o_orderstatus,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'NaN'::DOUBLE ELSE 1.0::DOUBLE END AS factor
  FROM orders)
"""


@query(
    "dropna_any",
    f"""WITH {GAPS_SQL} SELECT * FROM gaps
        WHERE o_totalprice IS NOT NULL AND o_orderstatus IS NOT NULL AND NOT isnan(factor)""",
)
def dropna_any(spark, folder):
    return shaping.drop_incomplete(_with_gaps(spark, folder))


@query("null_rows", f"WITH {GAPS_SQL} SELECT o_orderkey, o_totalprice FROM gaps WHERE o_orderstatus IS NULL")
def null_rows(spark, folder):
    return shaping.rows_missing(_with_gaps(spark, folder), "o_orderstatus").select("o_orderkey", "o_totalprice")


@query(
    "filter_isin",
    "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_totalprice > 250000 AND o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def filter_isin(spark, folder):
    kept = shaping.above_and_in(
        table(spark, folder, "orders"), "o_totalprice", 250000.0, "o_orderpriority", ["1-URGENT", "2-HIGH"]
    )
    return kept.select("o_orderkey", "o_totalprice", "o_orderpriority")


COLUMN_KINDS_SQL = f"""WITH {MODEL_SQL}
SELECT count(idade_divida_dias)::BIGINT AS filled, 'idade_divida_dias' AS column_name, 'numeric' AS kind FROM model
""" + "".join(
    f"UNION ALL SELECT count({c})::BIGINT, '{c}', 'text' FROM model\n"
    for c in ("tipo_devedor", "nm_porte", "origem", "situacao_inscricao", "nm_situacao_cadastral", "nm_regiao_politica")
)


@query("columns_by_type", COLUMN_KINDS_SQL)
def columns_by_type(spark, folder):
    """Feature columns by kind, with the number of filled rows."""
    df = model_table(spark, folder)
    numeric, texts = shaping.columns_by_type(df, exclude=["numero_inscricao", "target"])
    kinds = {**{c: "numeric" for c in numeric}, **{c: "text" for c in texts}}
    filled = profile.null_profile(df.select(*kinds)).select("column_name", F.col("non_null").alias("filled"))
    chain = F.lit(None).cast("string")
    for name, kind in kinds.items():
        chain = F.when(F.col("column_name") == name, kind).otherwise(chain)
    return filled.withColumn("kind", chain)


@query(
    "feature_hook",
    """SELECT p_partkey, p_size / 365.0::DOUBLE AS p_size, replace(lower(p_brand || '.' || p_type), '.', '_') AS p_label FROM part""",
)
def feature_hook(spark, folder):
    parts = table(spark, folder, "part").select(
        "p_partkey", "p_size", F.concat_ws(".", "p_brand", "p_type").alias("p_label")
    )
    return shaping.apply_features(parts, shaping.years_and_clean_text("p_size", "p_label"))


# --- joins -----------------------------------------------------------------

REGISTRY_SQL = f"{COMPANIES_SQL}, registry AS (SELECT cd_cnpj, nm_porte, nm_regiao_politica FROM companies WHERE vl_capital_social >= 0)"


def _registry(spark, folder):
    """Companies with a non-negative capital; debts of the others find no match."""
    return (
        companies(spark, folder)
        .filter(F.col("vl_capital_social") >= 0)
        .select("cd_cnpj", "nm_porte", "nm_regiao_politica")
    )


def _debtor_keys(spark, folder):
    """Debts whose debtor is unknown when the priority was never given."""
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey")).alias("cd_cnpj"),
        "o_totalprice",
    )


KEYS_SQL = """debtor_keys AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS cd_cnpj, o_totalprice FROM orders)"""


@query(
    "join_left",
    f"WITH {REGISTRY_SQL}, {KEYS_SQL} SELECT * FROM debtor_keys LEFT JOIN registry USING (cd_cnpj)",
)
def join_left(spark, folder):
    """The debtor key may be hot, so its rows are spread."""
    return joins.join_spread(_debtor_keys(spark, folder), _registry(spark, folder), ["cd_cnpj"], ["o_orderkey"])


@query(
    "join_semi_reduced",
    f"""WITH {REGISTRY_SQL}, {KEYS_SQL}
        SELECT o_orderkey, cd_cnpj AS cnpj, o_totalprice, nm_porte, nm_regiao_politica
        FROM debtor_keys LEFT JOIN registry USING (cd_cnpj)""",
)
def join_semi_reduced(spark, folder):
    left = _debtor_keys(spark, folder).withColumnRenamed("cd_cnpj", "cnpj")
    return joins.enrich_reduced(left, "cnpj", _registry(spark, folder), "cd_cnpj", ["o_orderkey"])


@query(
    "join_cast_keys",
    f"""WITH {REGISTRY_SQL}, {KEYS_SQL}
        SELECT d.o_orderkey, d.cd_cnpj::VARCHAR AS cd_cnpj, r.nm_porte
        FROM debtor_keys d LEFT JOIN registry r ON d.cd_cnpj::VARCHAR = r.cd_cnpj::VARCHAR""",
)
def join_cast_keys(spark, folder):
    left = joins.cast_keys(_debtor_keys(spark, folder), {"cd_cnpj": "string"})
    right = joins.cast_keys(_registry(spark, folder), {"cd_cnpj": "string"})
    return joins.join_spread(
        left.select("o_orderkey", "cd_cnpj"), right.select("cd_cnpj", "nm_porte"), ["cd_cnpj"], ["o_orderkey"]
    )


@query(
    "join_inner",
    f"""WITH {REGISTRY_SQL}, {KEYS_SQL} SELECT o_orderkey, cd_cnpj, nm_porte FROM debtor_keys JOIN registry USING (cd_cnpj)""",
)
def join_inner(spark, folder):
    joined = joins.join_spread(
        _debtor_keys(spark, folder), _registry(spark, folder), ["cd_cnpj"], ["o_orderkey"], "inner"
    )
    return joined.select("o_orderkey", "cd_cnpj", "nm_porte")


@query(
    "join_semi",
    f"""WITH {REGISTRY_SQL}, {KEYS_SQL} SELECT * FROM registry WHERE cd_cnpj IN (SELECT cd_cnpj FROM debtor_keys)""",
)
def join_semi(spark, folder):
    return joins.only_referenced(_registry(spark, folder), "cd_cnpj", _debtor_keys(spark, folder), "cd_cnpj")


@query(
    "join_suffix",
    """SELECT c_nationkey AS nationkey, c_name AS name_x, c_acctbal AS acctbal_x, n_name AS name_y
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def join_suffix(spark, folder):
    left = table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("nationkey"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal_x")
    )
    right = table(spark, folder, "nation").select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("name"))
    return joins.merge(left, right, ["nationkey"], "inner")


# --- aggregates ------------------------------------------------------------


@query("group_mean", "SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1")
def group_mean(spark, folder):
    return profile.group_mean(table(spark, folder, "orders"), "o_orderpriority", "o_totalprice").withColumn(
        "mean", F.round("mean", 4)
    )


@query("count_nonnull", f"WITH {GAPS_SQL} SELECT count(o_orderstatus)::BIGINT AS n FROM gaps")
def count_nonnull(spark, folder):
    return profile.non_null_count(_with_gaps(spark, folder), "o_orderstatus")


@query(
    "null_profile",
    f"""WITH {GAPS_SQL}, counts AS (
          SELECT 'o_totalprice' AS column_name, 'double' AS data_type, count(o_totalprice) AS non_null, count(*) AS n FROM gaps
          UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus), count(*) FROM gaps
          UNION ALL SELECT 'factor', 'double', count(*) FILTER (WHERE NOT isnan(factor)), count(*) FROM gaps)
        SELECT column_name, data_type, non_null::BIGINT AS non_null, (n - non_null)::BIGINT AS nulls,
               round((n - non_null) / n::DOUBLE, 9) AS null_share FROM counts""",
)
def null_profile(spark, folder):
    return profile.null_profile(_with_gaps(spark, folder), only_with_nulls=True).withColumn(
        "null_share", F.round("null_share", 9)
    )


@query("class_counts", f"WITH {DEBTS_SQL} SELECT target, count(*)::BIGINT AS n FROM debts GROUP BY 1")
def class_counts(spark, folder):
    return profile.value_counts(debts(spark, folder), "target")


@query(
    "imbalance_ratio",
    f"""WITH {LABELLED_SQL}, c AS (SELECT label, count(*) AS n FROM labelled GROUP BY 1)
        SELECT count(*)::BIGINT AS n_classes, min(n)::BIGINT AS min_count, max(n)::BIGINT AS max_count,
               round((max(n) - min(n)) / (max(n) + min(n))::DOUBLE, 9) AS ratio FROM c""",
)
def imbalance_ratio(spark, folder):
    df = debts(spark, folder).withColumn("label", labels.encode_label("target"))
    return profile.imbalance(df, "label").withColumn("ratio", F.round("ratio", 9))


@query("distinct_keys", "SELECT DISTINCT o_custkey FROM orders")
def distinct_keys(spark, folder):
    return table(spark, folder, "orders").select("o_custkey").distinct()


_CORR = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "corr_target",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(corr({c}, l_extendedprice), 6) AS corr FROM lineitem" for c in _CORR
    ),
)
def corr_target(spark, folder):
    df = table(spark, folder, "lineitem").select(*_CORR)
    return profile.correlation_with(df, "l_extendedprice", _CORR).withColumn("corr", F.round("corr", 6))


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
        for a in _CORR
        for b in _CORR
    ),
)
def corr_matrix(spark, folder):
    df = table(spark, folder, "lineitem").select(*_CORR)
    return profile.correlation_matrix(df, _CORR).withColumn("corr", F.round("corr", 6))


@query(
    "crosstab",
    f"""WITH {LABELLED_SQL}
        SELECT situacao_inscricao, count(*) FILTER (WHERE label = 0)::BIGINT AS "0.0", count(*) FILTER (WHERE label = 1)::BIGINT AS "1.0"
        FROM labelled GROUP BY 1""",
)
def crosstab(spark, folder):
    df = debts(spark, folder).withColumn("label", labels.encode_label("target"))
    return profile.crosstab(df, "situacao_inscricao", "label", [0.0, 1.0])


@query(
    "rank_importance",
    f"""WITH c AS ({" UNION ALL ".join(f"SELECT '{c}' AS name, corr({c}, l_quantity) AS value FROM lineitem" for c in _CORR)})
        SELECT name, round(value, 6) AS value, (row_number() OVER (ORDER BY abs(value) DESC, name))::BIGINT AS place FROM c""",
)
def rank_importance(spark, folder):
    """Columns by absolute correlation with the quantity, with their place."""
    from pyspark.sql import Window as W

    found = profile.correlation_with(table(spark, folder, "lineitem").select(*_CORR), "l_quantity", _CORR)
    ranked = profile.rank_by_size(found.withColumnsRenamed({"column_name": "name", "corr": "value"}), "value", "name")
    order = W.partitionBy(F.lit(1)).orderBy(F.abs("value").desc(), "name")  # one row per column
    return ranked.select(
        "name", F.round("value", 6).alias("value"), F.row_number().over(order).cast("bigint").alias("place")
    )


# --- scalar functions ------------------------------------------------------


def _label_words(spark, folder):
    """Targets in mixed case, with an unknown word and nulls among them."""
    return debts(spark, folder).select(
        "numero_inscricao",
        F.when(F.col("origem") == "3-MEDIUM", F.lower("target"))
        .when(F.col("origem") == "4-NOT SPECIFIED", "talvez")
        .when(F.col("origem") == "5-LOW", F.lit(None))
        .otherwise(F.col("target"))
        .alias("word"),
    )


@query(
    "label_encode",
    f"""WITH {DEBTS_SQL}, words AS (
          SELECT numero_inscricao, CASE WHEN origem = '3-MEDIUM' THEN lower(target) WHEN origem = '4-NOT SPECIFIED' THEN 'talvez'
                 WHEN origem = '5-LOW' THEN NULL ELSE target END AS word FROM debts),
        coded AS (
          SELECT *, CASE WHEN upper(word) = 'SIM' THEN 1.0::DOUBLE WHEN upper(word) IN ('NAO', 'NÃO') THEN 0.0::DOUBLE END AS code FROM words)
        SELECT numero_inscricao, code AS as_null, coalesce(code, 0.0::DOUBLE) AS as_zero,
               CASE WHEN word = 'SIM' THEN 1.0::DOUBLE WHEN word = 'NÃO' THEN 0.0::DOUBLE ELSE -1.0::DOUBLE END AS as_minus_one
        FROM coded""",
)
def label_encode(spark, folder):
    return _label_words(spark, folder).select(
        "numero_inscricao",
        labels.encode_label("word").alias("as_null"),
        labels.encode_label("word", "zero").alias("as_zero"),
        labels.encode_label("word", "minus_one", exact=True).alias("as_minus_one"),
    )


@query(
    "normalise_id",
    """WITH raw AS (
         SELECT o_orderkey, o_custkey || '.' || o_orderkey || '/0001-' || o_orderstatus || repeat('9', (o_custkey % 9)::INT) AS raw_id,
                CASE o_orderpriority WHEN '1-URGENT' THEN 'Pessoa jurídica' WHEN '2-HIGH' THEN 'J' WHEN '3-MEDIUM' THEN 'F'
                     WHEN '4-NOT SPECIFIED' THEN 'FISICA' END AS person FROM orders),
       bare AS (SELECT *, regexp_replace(raw_id, '[-./]', '', 'g') AS b FROM raw)
       SELECT o_orderkey, CASE WHEN coalesce(contains(upper(person), 'J'), FALSE)
                               THEN CASE WHEN length(b) < 14 THEN lpad(b, 14, '0') ELSE b END END AS company_id FROM bare""",
)
def normalise_id(spark, folder):
    raw = F.concat(
        F.col("o_custkey").cast("string"), F.lit("."), F.col("o_orderkey").cast("string"), F.lit("/0001-"),
        F.col("o_orderstatus"), F.repeat(F.lit("9"), (F.col("o_custkey") % 9).cast("int")),
    )
    person = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Pessoa jurídica")
        .when(F.col("o_orderpriority") == "2-HIGH", "J")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "F")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "FISICA")
    )
    return table(spark, folder, "orders").select("o_orderkey", text.company_id(raw, person).alias("company_id"))


@query(
    "parse_filename",
    """WITH f AS (
         SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'avulso_' ELSE year(o_orderdate) || 'T' || quarter(o_orderdate) || '_' END
                || CASE o_orderpriority WHEN '1-URGENT' THEN 'FGTS.zip' WHEN '2-HIGH' THEN 'Nao_Previdenciario.zip'
                        WHEN '3-MEDIUM' THEN 'Previdenciario.zip' ELSE 'outros.zip' END AS file_name FROM orders)
       SELECT o_orderkey, file_name, nullif(regexp_extract(file_name, '(\\d{4})T([1-4])', 1), '') AS ano,
              nullif(regexp_extract(file_name, '(\\d{4})T([1-4])', 2), '') AS trimestre,
              CASE WHEN contains(file_name, 'FGTS.zip') THEN 'FGTS' WHEN contains(file_name, 'Nao_Previdenciario.zip') THEN 'SIDA'
                   WHEN contains(file_name, 'Previdenciario.zip') THEN 'PREV' ELSE 'DESCONHECIDO' END AS origem FROM f""",
)
def parse_filename(spark, folder):
    ending = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "FGTS.zip")
        .when(F.col("o_orderpriority") == "2-HIGH", "Nao_Previdenciario.zip")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Previdenciario.zip")
        .otherwise("outros.zip")
    )
    start = F.when(F.col("o_orderstatus") == "P", "avulso_").otherwise(
        F.concat(F.year("o_orderdate").cast("string"), F.lit("T"), F.quarter("o_orderdate").cast("string"), F.lit("_"))
    )
    name = F.col("file_name")
    return (
        table(spark, folder, "orders")
        .select("o_orderkey", F.concat(start, ending).alias("file_name"))
        .select(
            "o_orderkey",
            "file_name",
            text.snapshot_year(name).alias("ano"),
            text.snapshot_quarter(name).alias("trimestre"),
            text.origin_of(name).alias("origem"),
        )
    )


@query(
    "prev_month",
    "SELECT o_orderkey, strftime(date_trunc('month', o_orderdate) - INTERVAL 1 DAY, '%Y-%m') AS month FROM orders",
)
def prev_month(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", dates.previous_month(F.col("o_orderdate")).alias("month"))


@query("run_stamp", "SELECT event_id, strftime(ts, '%Y%m%d%H%M') AS stamp FROM events")
def run_stamp(spark, folder):
    return table(spark, folder, "events").select("event_id", dates.run_stamp(F.col("ts")).alias("stamp"))


@query(
    "head_n",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000",
)
def head_n(spark, folder):
    """The first thousand rows by key; the limit is the feature."""
    return sampling.head_rows(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])


@query(
    "join_null_safe",
    """SELECT o_orderkey, o.k, c.c_name FROM (SELECT o_orderkey, nullif(o_custkey, 2) AS k FROM orders) o
       LEFT JOIN (SELECT nullif(c_custkey, 1) AS k, c_name FROM customer) c ON o.k IS NOT DISTINCT FROM c.k""",
)
def join_null_safe(spark, folder):
    """Null keys meet null keys; the right side has one row for each key, null too."""
    left = table(spark, folder, "orders").select("o_orderkey", F.expr("nullif(o_custkey, 2)").alias("k"))
    right = table(spark, folder, "customer").select(F.expr("nullif(c_custkey, 1)").alias("k"), "c_name")
    return joins.merge(left, right, ["k"], null_safe=True)


@query(
    "decode_fallback",
    "SELECT doc_id, text AS from_utf8, CASE WHEN regexp_full_match(text, '[\\x{0000}-\\x{00FF}]*') THEN text END AS from_latin1 FROM documents",
)
def decode_fallback(spark, folder):
    """Whole texts, encoded both ways and decoded again; null where latin1 cannot hold the text.

    Plain ASCII reads the same either way; accented latin1 bytes are not valid
    UTF-8 and take the fallback.
    """
    held = F.col("text").rlike(r"^[\x{0000}-\x{00FF}]*\z")
    return table(spark, folder, "documents").select(
        "doc_id",
        text.decode_with_fallback(F.encode("text", "UTF-8")).alias("from_utf8"),
        F.when(held, text.decode_with_fallback(F.encode("text", "ISO-8859-1"))).alias("from_latin1"),
    )
