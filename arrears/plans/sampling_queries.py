"""Splits, folds, balancing and feature preparation."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from arrears.functions.labels import encode_label
from arrears.operators import balance, prepare, sampling
from arrears.operators.quantiles import medians, modes
from arrears.plans.model_table import (
    CATEGORICAL,

    KEY,
    LABELLED_SQL,
    MODEL_SQL,
    NUMERIC,
    debts,
    model_table,
)
from arrears.plans.registry import query, table
from arrears.session import fresh_path


def labelled(spark, folder):
    """Key, age and numeric label."""
    return debts(spark, folder).select(KEY, "idade_divida_dias", "valor_consolidado", encode_label("target").alias("label"))


SPLIT_SQL = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || numero_inscricao)) AS rk FROM labelled),
sizes AS (SELECT label, count(*) AS n FROM labelled GROUP BY 1),
totals AS (SELECT sum(n) AS total, sum(n) - ceil(sum(n) * 0.3::DOUBLE) AS train FROM sizes),
parts AS (
  SELECT label, n, floor(n * train / total::DOUBLE) AS whole, n * train / total::DOUBLE - floor(n * train / total::DOUBLE) AS rest, train
  FROM sizes, totals),
quota AS (
  SELECT label, n - whole - CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= train - sum(whole) OVER () THEN 1 ELSE 0 END AS k FROM parts),
split AS (SELECT ranked.*, rk <= k AS is_test FROM ranked JOIN quota USING (label))
"""


@query("split_stratified", f"WITH {LABELLED_SQL}, {SPLIT_SQL} SELECT numero_inscricao, label, is_test FROM split")
def split_stratified(spark, folder):
    return sampling.split_stratified(labelled(spark, folder), "label", [KEY]).select(KEY, "label", "is_test")


@query(
    "split_random",
    f"""WITH {LABELLED_SQL} SELECT numero_inscricao, md5('42:' || numero_inscricao) < '4cccccccccccc' AS test_30,
        md5('42:' || numero_inscricao) < '3333333333333' AS test_20 FROM labelled""",
)
def split_random(spark, folder):
    df = sampling.split_random(labelled(spark, folder), [KEY], 0.3, out="test_30")
    return sampling.split_random(df, [KEY], 0.2, out="test_20").select(KEY, "test_30", "test_20")


@query(
    "stratified_folds",
    f"""WITH {LABELLED_SQL}, r AS (
          SELECT numero_inscricao, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || numero_inscricao)) AS rk,
                 count(*) OVER (PARTITION BY label) AS n FROM labelled)
        SELECT numero_inscricao, label,
               ((rk > n * 1 // 5)::INT + (rk > n * 2 // 5)::INT + (rk > n * 3 // 5)::INT + (rk > n * 4 // 5)::INT)::INTEGER AS fold FROM r""",
)
def stratified_folds(spark, folder):
    return sampling.stratified_folds(labelled(spark, folder), "label", [KEY], 5).select(KEY, "label", "fold")


@query(
    "undersample",
    f"""WITH {LABELLED_SQL}, r AS (
          SELECT numero_inscricao, label, idade_divida_dias, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || numero_inscricao)) AS rk FROM labelled)
        SELECT numero_inscricao, label, idade_divida_dias FROM r
        WHERE rk <= (SELECT min(n) FROM (SELECT count(*) AS n FROM labelled GROUP BY label))""",
)
def undersample(spark, folder):
    kept = balance.balance_random(labelled(spark, folder), "label", [KEY], "undersample")
    return kept.select(KEY, "label", "idade_divida_dias")


@query(
    "oversample",
    f"""WITH {LABELLED_SQL}, r AS (
          SELECT numero_inscricao, label, idade_divida_dias,
                 row_number() OVER (PARTITION BY label ORDER BY md5('42:' || numero_inscricao)) - 1 AS pos FROM labelled),
        s AS (SELECT label, count(*) AS n FROM labelled GROUP BY 1),
        d AS (SELECT label, n, unnest(range((SELECT max(n) FROM s))) AS draw FROM s),
        t AS (SELECT label, ('0x' || substr(md5('42:' || label || ':' || draw), 1, 15))::BIGINT % n AS pos, count(*) AS times FROM d GROUP BY 1, 2)
        SELECT numero_inscricao, label, idade_divida_dias, unnest(range(1, times + 1))::BIGINT AS copy FROM r JOIN t USING (label, pos)""",
)
def oversample(spark, folder):
    grown = balance.balance_random(labelled(spark, folder), "label", [KEY], "oversample")
    return grown.select(KEY, "label", "idade_divida_dias", "copy")


# --- preparation -----------------------------------------------------------


@query(
    "standard_scale",
    """SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER (), 6) AS price_scaled,
              0.0::DOUBLE AS constant_scaled FROM orders""",
)
def standard_scale(spark, folder):
    """A constant column is centred and not divided by zero."""
    df = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", F.lit(3).alias("three"))
    scaler = prepare.PopulationScaler(["o_totalprice", "three"], ["price", "constant"]).fit(df)
    return scaler.transform(df).select(
        "o_orderkey", F.round("price", 6).alias("price_scaled"), F.col("constant").alias("constant_scaled")
    )


@query(
    "one_hot",
    f"""WITH {MODEL_SQL}
        SELECT numero_inscricao, {", ".join(f"CASE WHEN nm_regiao_politica = '{r}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {r.lower().replace(' ', '_')}" for r in ("AFRICA", "AMERICA", "EUROPE", "MIDDLE EAST"))},
               (nm_regiao_politica <> 'ASIA')::INTEGER AS slots_set FROM model""",
)
def one_hot(spark, folder):
    """Fitted without one region, whose rows then set no slot."""
    df = model_table(spark, folder).select(KEY, "nm_regiao_politica")
    model = prepare.Pipeline(stages=prepare.one_hot(["nm_regiao_politica"])).fit(df.filter("nm_regiao_politica <> 'ASIA'"))
    slots = vector_to_array("nm_regiao_politica__hot")
    names = ("africa", "america", "europe", "middle_east")
    return model.transform(df).select(
        KEY,
        *[slots[i].alias(n) for i, n in enumerate(names)],
        F.aggregate(slots, F.lit(0.0), lambda a, x: a + x).cast("int").alias("slots_set"),
    )


@query(
    "ordinal_encode",
    f"""WITH {MODEL_SQL}, codes AS (
          SELECT nm_regiao_politica, row_number() OVER (ORDER BY nm_regiao_politica) - 1 AS code
          FROM (SELECT DISTINCT nm_regiao_politica FROM model WHERE nm_regiao_politica <> 'ASIA'))
        SELECT numero_inscricao, coalesce(code, -1)::DOUBLE AS code FROM model LEFT JOIN codes USING (nm_regiao_politica)""",
)
def ordinal_encode(spark, folder):
    df = model_table(spark, folder).select(KEY, "nm_regiao_politica")
    coder = prepare.OrdinalCoder(["nm_regiao_politica"], ["code"]).fit(df.filter("nm_regiao_politica <> 'ASIA'"))
    return coder.transform(df).select(KEY, "code")


@query(
    "categorise",
    f"WITH {MODEL_SQL} SELECT numero_inscricao, nullif(nm_regiao_politica, 'ASIA') AS region FROM model",
)
def categorise(spark, folder):
    df = model_table(spark, folder).select(KEY, "nm_regiao_politica")
    fixed = prepare.Categoriser(["nm_regiao_politica"], ["region"]).fit(df.filter("nm_regiao_politica <> 'ASIA'"))
    return fixed.transform(df).select(KEY, "region")


PRICE_GAPS_SQL = """price_gaps AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price,
         nullif(o_orderpriority, '3-MEDIUM') AS priority FROM orders)"""


def _price_gaps(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price"),
        F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")).alias("priority"),
    )


@query(
    "impute_median",
    f"WITH {PRICE_GAPS_SQL} SELECT o_orderkey, round(coalesce(price, (SELECT median(price) FROM price_gaps)), 6) AS price FROM price_gaps",
)
def impute_median(spark, folder):
    df = _price_gaps(spark, folder)
    filled = prepare.MedianImputer(["price"], ["filled"]).fit(df).transform(df)
    return filled.select("o_orderkey", F.round("filled", 6).alias("price"))


@query(
    "impute_mode",
    f"""WITH {PRICE_GAPS_SQL} SELECT o_orderkey, coalesce(priority,
          (SELECT priority FROM price_gaps WHERE priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, priority LIMIT 1)) AS priority FROM price_gaps""",
)
def impute_mode(spark, folder):
    df = _price_gaps(spark, folder)
    filled = prepare.ModeImputer(["priority"], ["filled"]).fit(df).transform(df)
    return filled.select("o_orderkey", F.col("filled").alias("priority"))


@query(
    "median_and_mode",
    """SELECT round(median(l_extendedprice), 6) AS price_median, round(median(l_quantity), 6) AS quantity_median,
              (SELECT l_returnflag FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS flag_mode FROM lineitem""",
)
def median_and_mode(spark, folder):
    """The narrowing search, forced on by a low limit."""
    df = table(spark, folder, "lineitem").select("l_extendedprice", "l_quantity", "l_returnflag")
    mid = medians(df, ["l_extendedprice", "l_quantity"], small=1000)
    top = modes(df, ["l_returnflag"])
    return spark.range(1).select(
        F.round(F.lit(mid["l_extendedprice"]), 6).alias("price_median"),
        F.round(F.lit(mid["l_quantity"]), 6).alias("quantity_median"),
        F.lit(top["l_returnflag"]).alias("flag_mode"),
    )


@query(
    "scale_fit_train_apply_test",
    f"""WITH {LABELLED_SQL}, {SPLIT_SQL}, fit AS (
          SELECT avg(idade_divida_dias) AS m, stddev_pop(idade_divida_dias) AS s FROM split WHERE NOT is_test)
        SELECT numero_inscricao, round((idade_divida_dias - m) / s, 6) AS age_scaled FROM split, fit WHERE is_test""",
)
def scale_fit_train_apply_test(spark, folder):
    df = sampling.split_stratified(labelled(spark, folder), "label", [KEY])
    scaler = prepare.PopulationScaler(["idade_divida_dias"], ["scaled"]).fit(df.filter(~F.col("is_test")))
    return scaler.transform(df.filter("is_test")).select(KEY, F.round("scaled", 6).alias("age_scaled"))


@query(
    "feature_matrix",
    f"""WITH {MODEL_SQL}, fit AS (SELECT avg(idade_divida_dias) AS m, stddev_pop(idade_divida_dias) AS s FROM model)
        SELECT numero_inscricao, round((idade_divida_dias - m) / s, 6) AS idade_divida_dias,
               {", ".join(f"(situacao_inscricao = '{v}')::INT::DOUBLE AS situacao_inscricao_{v}" for v in "FOP")},
               {", ".join(f"(nm_situacao_cadastral = '{v}')::INT::DOUBLE AS nm_situacao_cadastral_{v}" for v in ("ATIVA", "INAPTA"))}
        FROM model, fit""",
)
def feature_matrix(spark, folder):
    """Vector slots back as columns, named from the vector's metadata."""
    texts = ["situacao_inscricao", "nm_situacao_cadastral"]
    df = model_table(spark, folder).select(KEY, *NUMERIC, *texts)
    wide = prepare.fit_preparation(df, NUMERIC, texts).transform(df)
    names = prepare.feature_names(wide)
    slots = vector_to_array("features")
    columns = [F.round(slots[i], 6).alias(n) if n in NUMERIC else slots[i].alias(n) for i, n in enumerate(names)]
    return wide.select(KEY, *columns)


@query(
    "ordinal_wide",
    "SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN -1.0 ELSE (dense_rank() OVER (PARTITION BY o_custkey % 10 = 0 ORDER BY o_custkey::VARCHAR) - 1) END::DOUBLE AS code FROM orders",
)
def ordinal_wide(spark, folder):
    """Codes of the debtors as texts, fitted without one debtor in ten, by a table of codes and not a list."""
    rows = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("debtor"))
    codes = prepare.category_codes(rows.filter(F.col("debtor").cast("bigint") % 10 != 0), "debtor")
    return prepare.join_codes(rows, "debtor", codes, "code", ["o_orderkey"]).select("o_orderkey", "code")


@query(
    "categorise_wide",
    "SELECT o_orderkey, CASE WHEN o_custkey % 10 > 0 THEN o_custkey::VARCHAR END AS known, CASE WHEN o_custkey % 10 = 0 THEN -1.0 ELSE (dense_rank() OVER (PARTITION BY o_custkey % 10 = 0 ORDER BY o_custkey::VARCHAR) - 1) END::DOUBLE AS code FROM orders",
)
def categorise_wide(spark, folder):
    """A preparation that indexes the debtors by a table, saved and loaded before it is applied."""
    rows = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("debtor"))
    index = prepare.TableIndex.fitted(rows.filter(F.col("debtor").cast("bigint") % 10 != 0), "debtor", "place")
    path = fresh_path(spark, "wide_preparation")
    prepare.PipelineModel(stages=[index]).write().save(path)
    placed = prepare.PipelineModel.load(path).transform(rows)
    seen = F.col("place") < index.size
    return placed.select(
        "o_orderkey", F.when(seen, F.col("debtor")).alias("known"), F.when(seen, F.col("place")).otherwise(-1.0).alias("code")
    )


@query(
    "prepared_texts",
    f"""WITH {MODEL_SQL} SELECT {", ".join(f"count(DISTINCT {c}) AS {c}" for c in CATEGORICAL)}, count(*) AS n FROM model""",
)
def prepared_texts(spark, folder):
    """Slots per text column after one-hot encoding the whole model table."""
    df = model_table(spark, folder)
    wide = prepare.fit_preparation(df, NUMERIC, CATEGORICAL, encoding="categorise").transform(df)
    names = prepare.feature_names(wide)
    return wide.agg(
        *[F.lit(sum(n.startswith(c + "_") for n in names)).cast("bigint").alias(c) for c in CATEGORICAL],
        F.count("features").alias("n"),
    )


