"""Mixing sources to target weights by hierarchical budgeting.

Tokens are budgeted down a tree (domain, language, source). A node's budget is divided among its children by weight; a
child that cannot hold its share (its tokens times the number of epochs allowed) is filled, and what it leaves goes to
its siblings by weight. Only what a whole subtree cannot hold goes up to the subtree's siblings. As every node knows
the capacity below it, one pass from the root does both.

A leaf's budget is a prefix of its seeded epochs: in each epoch its documents come in another order, fixed by a hash.
Whole epochs take every document; the last one is cut within a document. The place of the cut is found in two steps,
by ranges of the hash and then inside one range, so no leaf is ever sorted as a whole.

Only DataFrame operations; weights and budgets are whole numbers, so results do not depend on the order of sums.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.common import keyed, pack, staged, with_verdicts
from arrears.llm.registry import query, table

WORD = r"[^\x20\x09-\x0D]+"
RANGE_DIGITS = 3  # hex digits of the hash: 4096 ranges for each leaf
SEED = 20240
EPOCHS = 2  # a document is taken at most so often
SHARE = (4, 5)  # budget as a share of all tokens

#: Domain of a source, and weights of nodes by name; 1 where nothing is said.
DOMAINS = {
    "web": [f"src{i}" for i in range(10)],
    "books": [f"src{i}" for i in range(10, 15)],
    "forum": [f"src{i}" for i in range(15, 18)],
}
OTHER_DOMAIN = "other"
WEIGHTS = (
    {"web": 10, "books": 6, "forum": 3, "other": 1},
    {"en": 8, "de": 3, "fr": 3, "es": 3},
    {"src0": 4, "src10": 2},
)


def domain_of(source: Column, domains: Mapping[str, Sequence[str]], other: str) -> Column:
    out = F.lit(other)
    for name, sources in domains.items():
        out = F.when(source.isin(*sources), name).otherwise(out)
    return out


def weight_of(name: Column, weights: Mapping[str, int]) -> Column:
    out = F.lit(1)
    for k, w in weights.items():
        out = F.when(name == k, w).otherwise(out)
    return out.cast("long")


def share_out(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Add ``given`` to nodes with ``weight``, ``capacity`` and their parent's ``budget``.

    Children are taken in the order of capacity by weight: while a child's capacity is not above its share of what is
    left it is filled; from the first that is not, all others share by weight. Fractions of a token are not spent.
    """
    whole = Window.partitionBy(*parent)
    order = whole.orderBy("ratio", name)
    wide = nodes.where("weight > 0").withColumns(
        {
            "capacity": F.col("capacity").cast("decimal(38,0)"),
            "budget": F.col("budget").cast("decimal(38,0)"),
            "ratio": F.col("capacity").cast("double") / F.col("weight"),
        }
    )
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    wide = wide.withColumn("before", before.cast("decimal(38,0)")).withColumn("after", after)
    wide = wide.withColumn("full", F.expr("capacity * after <= weight * (budget - before)"))
    spent = F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(whole).cast("decimal(38,0)")
    left = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(whole)
    wide = wide.withColumn("spent", spent).withColumn("left", left)
    part = F.expr("(weight * greatest(budget - spent, cast(0 as decimal(38,0)))) div greatest(left, 1)")
    given = F.when(F.col("full"), F.col("capacity").cast("long")).otherwise(part)
    return wide.withColumn("given", given.cast("long")).drop("ratio", "before", "after", "full", "spent", "left")


def budgets(leaves: DataFrame, budget: int, weights: Sequence[Mapping[str, int]], epochs: int) -> DataFrame:
    """``given`` tokens of each leaf (a, b, c) with its ``tokens``."""
    nodes = leaves.where("tokens > 0").withColumn("capacity", F.col("tokens") * epochs)
    one = nodes.groupBy("a").agg(F.sum("capacity").alias("capacity"))
    one = one.select(
        F.lit("").alias("root"), "a", "capacity", weight_of(F.col("a"), weights[0]).alias("weight"),
        F.lit(budget).cast("long").alias("budget"),
    )
    one = share_out(one, ["root"], "a").select("a", F.col("given").alias("budget"))
    two = nodes.groupBy("a", "b").agg(F.sum("capacity").alias("capacity"))
    two = two.join(one, "a").withColumn("weight", weight_of(F.col("b"), weights[1]))
    two = share_out(two, ["a"], "b").select("a", "b", F.col("given").alias("budget"))
    three = nodes.join(two, ["a", "b"]).withColumn("weight", weight_of(F.col("c"), weights[2]))
    return share_out(three, ["a", "b"], "c").select("a", "b", "c", "tokens", "given")


def mix(
    docs: DataFrame,
    keep: Sequence[str],
    key: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    source: str = "source",
    domains: Mapping[str, Sequence[str]] = DOMAINS,
    weights: Sequence[Mapping[str, int]] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The documents of the mixture: ``row`` (struct of ``keep``), domain, language, source, n_tokens, leaf_tokens
    (the leaf's budget), epochs (whole ones) and taken_tokens (over all epochs; more than 0).

    A null language or source is one without a name. Documents without words are never taken. Repeated rows are
    documents of their own; a null key is ordered as an empty one. Weights are whole numbers; 0 leaves a node out. An
    empty table gives an empty mixture.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    read = docs.select(
        pack(keep),
        name(key).alias("id"),
        domain_of(name(source), domains, OTHER_DOMAIN).alias("a"),
        name(language).alias("b"),
        name(source).alias("c"),
        F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
    )
    read = staged(read.withColumn("owner", F.monotonically_increasing_id()), "mix-documents")
    light, rows = read.select("owner", "id", "a", "b", "c", "n_tokens"), read.count()
    leaves = staged(light.groupBy("a", "b", "c").agg(F.sum("n_tokens").alias("tokens")), "mix-leaves", rows)
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    shared = budgets(leaves, total * share[0] // share[1], weights, epochs)
    plan = staged(
        shared.select(
            "a", "b", "c", "given",
            F.expr("given div tokens").alias("whole"), F.expr("given % tokens").alias("rest"),
        ),
        "mix-budgets",
        rows,
    )
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col("whole") + 1, "id"))
    placed = (
        light.where("n_tokens > 0")
        .join(plan, ["a", "b", "c"])
        .withColumn("digest", digest)
        .withColumn("range", F.substring("digest", 1, RANGE_DIGITS))
    )
    placed = staged(placed, "mix-places", rows)
    leaf = Window.partitionBy("a", "b", "c").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = staged(
        placed.groupBy("a", "b", "c", "range")
        .agg(F.sum("n_tokens").alias("held"))
        .withColumn("start", F.coalesce(F.sum("held").over(leaf), F.lit(0))),
        "mix-ranges",
        rows,
    )
    located = placed.join(ranges, ["a", "b", "c", "range"])
    inner = Window.partitionBy("a", "b", "c", "range").orderBy("digest", "id", "n_tokens")
    inside = F.coalesce(
        F.sum("n_tokens").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    cut = (F.col("start") < F.col("rest")) & (F.col("start") + F.col("held") > F.col("rest"))
    at_cut = located.where(cut).withColumn("start", F.col("start") + inside)
    taken = F.col("whole") * F.col("n_tokens") + F.greatest(
        F.lit(0), F.least(F.col("rest") - F.col("start"), F.col("n_tokens"))
    )
    columns = ["owner", F.col("given").alias("leaf_tokens"), F.col("whole").alias("epochs"), taken.alias("taken_tokens")]
    whole = located.where(~cut).select(*columns)
    chosen = whole.unionByName(at_cut.select(*columns)).where("taken_tokens > 0")
    return read.join(chosen, "owner").select(
        "row",
        F.col("a").alias("domain"),
        F.col("b").alias("language"),
        F.col("c").alias("origin"),
        "n_tokens",
        "leaf_tokens",
        "epochs",
        "taken_tokens",
    )


def _sql() -> str:
    names = lambda d: " ".join(f"WHEN '{k}' THEN {v}" for k, v in d.items())
    domain = " ".join(f"WHEN source IN ({', '.join(repr(s) for s in of)}) THEN '{d}'" for d, of in DOMAINS.items())

    def level(name: str, nodes: str, parent: str, child: str, weights: dict) -> str:
        return f"""
{name}1 AS (SELECT *, CAST(CASE {child} {names(weights)} ELSE 1 END AS HUGEINT) AS weight FROM ({nodes})),
{name}2 AS (
  SELECT *, coalesce(sum(capacity) OVER (PARTITION BY {parent} ORDER BY CAST(capacity AS DOUBLE) / CAST(weight AS DOUBLE),
    {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(weight) OVER (PARTITION BY {parent} ORDER BY CAST(capacity AS DOUBLE) / CAST(weight AS DOUBLE), {child}
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after FROM {name}1),
{name}3 AS (SELECT *, capacity * after <= weight * (budget - before) AS filled FROM {name}2),
{name}4 AS (
  SELECT *, sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER (PARTITION BY {parent}) AS spent,
    sum(CASE WHEN filled THEN 0 ELSE weight END) OVER (PARTITION BY {parent}) AS leftw FROM {name}3),
{name} AS (
  SELECT *, CASE WHEN filled THEN capacity ELSE (weight * greatest(budget - spent, 0)) // greatest(leftw, 1) END AS given
  FROM {name}4),"""

    one = f"SELECT '' AS root, a, sum(tokens) * {EPOCHS} AS capacity, (SELECT sum(tokens) FROM leaves) * {SHARE[0]} // {SHARE[1]} AS budget FROM leaves WHERE tokens > 0 GROUP BY a"
    two = f"SELECT leaves.a, b, sum(tokens) * {EPOCHS} AS capacity, any_value(one.given) AS budget FROM leaves JOIN one ON leaves.a = one.a WHERE tokens > 0 GROUP BY leaves.a, b"
    three = f"SELECT leaves.a, leaves.b, c, tokens, tokens * {EPOCHS} AS capacity, two.given AS budget FROM leaves JOIN two ON leaves.a = two.a AND leaves.b = two.b WHERE tokens > 0"
    return rf"""
WITH d AS (
  SELECT doc_id, CASE {domain} ELSE '{OTHER_DOMAIN}' END AS a, coalesce(lang, '') AS b, coalesce(source, '') AS c,
    CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS n FROM documents),
leaves AS (SELECT a, b, c, CAST(sum(n) AS HUGEINT) AS tokens FROM d GROUP BY a, b, c),
{level("one", one, "root", "a", WEIGHTS[0])}
{level("two", two, "a", "b", WEIGHTS[1])}
{level("three", three, "a, b", "c", WEIGHTS[2])}
placed AS (
  SELECT d.*, given, given // tokens AS whole, given % tokens AS rest,
    md5(concat('{SEED}:', CAST(given // tokens + 1 AS VARCHAR), ':', coalesce(CAST(doc_id AS VARCHAR), ''))) AS digest
  FROM d JOIN three USING (a, b, c) WHERE n > 0),
located AS (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY a, b, c ORDER BY digest, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM placed),
taken AS (SELECT *, whole * n + greatest(0, least(rest - start, n)) AS t FROM located)
SELECT doc_id, a AS domain, b AS lang, c AS source, n AS n_tokens, CAST(given AS BIGINT) AS leaf_tokens,
  CAST(whole AS BIGINT) AS epochs, CAST(t AS BIGINT) AS taken_tokens
FROM taken WHERE t > 0
"""


SQL = _sql()


@query("op1_mix_sources", SQL)
def op1_mix_sources(spark, folder):
    mixed = mix(table(spark, folder, "documents"), ["doc_id"])
    return mixed.select(
        "row.doc_id", "domain", F.col("language").alias("lang"), F.col("origin").alias("source"), "n_tokens",
        "leaf_tokens", "epochs", "taken_tokens",
    )


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The columns of the documents, then the columns of ``mix``; names that clash get the ending ``_mix``."""
    names = {"key": "doc_id", "text": "text", "language": "lang", "source": "source"} | {
        k: options.pop(k) for k in ("key", "text", "language", "source") if k in options
    }
    row = F.col("row")
    rows = keyed(docs, names["key"], names["text"], names["language"], names["source"])
    plain = rows.select("id", "mark", *[row[c].alias(k) for k, c in names.items()])
    mixed = mix(plain, ["id", "mark"], **{k: k for k in names}, **options)
    own = [c for c in mixed.columns if c not in ("row", "language", "origin")]
    # equal rows are told apart by their number: the first takes the largest part
    parts = mixed.groupBy("row.id", "row.mark").agg(
        F.sort_array(F.collect_list(F.struct(*own[::-1])), False).alias("parts")
    )
    number = F.row_number().over(Window.partitionBy("id", "mark").orderBy(F.lit(0)))
    taken = with_verdicts(rows.withColumn("number", number), parts).where(F.col("number") <= F.size("parts"))
    part = F.element_at("parts", F.col("number"))
    return taken.select(row, part.alias("part")).select(
        "row.*", *[F.col("part")[c].alias(f"{c}_mix" if c in docs.columns else c) for c in own]
    )
