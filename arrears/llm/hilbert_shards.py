"""Shards along a Hilbert curve: documents that are alike in several metadata columns come into the same files.

Each column is cut into cells that hold about as many rows, so a document is a point of a grid. The Hilbert curve visits
the grid so that points near on the curve are near in every dimension; documents are put in order of the curve and cut
into runs of equal numbers. A filter on any of the columns then needs few of the files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrears.llm.common import pack, staged
from arrears.llm.crc_sql import crc32
from arrears.llm.registry import query, table

SHARDS = 24
DIMENSIONS = ("source", "lang", "n_chars")
BITS = 5  # cells of a dimension: 2 ** BITS, of which the first is for null
OVERHEAD = 8  # bytes of a document besides its text
PLACES = 1 << 33  # monotonically_increasing_id counts so far within a partition


def ranked(sorted_rows: DataFrame, name: str) -> DataFrame:
    """``at`` (place in the written table, whose order is that of the rows) and ``start`` (rows before its partition).

    The rows must be range-partitioned and sorted. What reaches the driver, and is broadcast, has one row for each
    partition.
    """
    written = staged(sorted_rows.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33).alias("part")
    weight = F.sum("n") if "n" in written.columns else F.count("*")
    starts, before = [], 0
    for p, n in sorted(written.groupBy(part).agg(weight).collect()):
        starts.append((p, before))
        before += n
    starts = written.sparkSession.createDataFrame(starts, "part long, start long")
    return written.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("rows", F.lit(before))


def cell_starts(rows: DataFrame, dimension: str, cells: int) -> list[tuple[int, object]]:
    """(cell, smallest value) of each cell that has values: at most ``cells`` - 1 of them.

    A value's cell follows from the number of rows with smaller values, so equal values share a cell and cells hold
    about as many rows. Counts are exact, whatever the number of distinct values: these are sorted in ranges.
    """
    counted = rows.where(F.col(dimension).isNotNull()).groupBy(F.col(dimension).alias("value"))
    counted = counted.agg(F.count("*").alias("n")).repartitionByRange("value").sortWithinPartitions("value")
    placed = ranked(counted, "shard-values")
    smaller = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("start") + F.coalesce(F.sum("n").over(smaller), F.lit(0))
    cell = F.expr(f"cast(1 + before * {cells - 1} div rows as int)").alias("cell")
    found = placed.select("value", "rows", before.alias("before")).select("value", cell)
    return sorted(found.groupBy("cell").agg(F.min("value")).collect())


def cell_of(value: Column, starts: Sequence[tuple[int, object]]) -> Column:
    """The cell of a value; 0 for null."""
    if not starts:  # no constant: the optimiser would copy it into all steps along the curve
        return F.when(value.isNull(), 0).otherwise(1)
    out = None
    for cell, least in sorted(starts, reverse=True):
        out = F.when(value >= F.lit(least), cell) if out is None else out.when(value >= F.lit(least), cell)
    return out.otherwise(0)


def curve_index(rows: DataFrame, axes: Sequence[str], bits: int, name: str) -> DataFrame:
    """Add the place on the Hilbert curve through a grid of ``2 ** bits`` cells along each axis.

    From the highest bit down, the curve's turns are undone by exchanging or inverting lower bits; what is left is the
    Gray code of the place.
    """
    if len(axes) * bits > 62:
        raise ValueError("too many cells for a number of 62 bits")
    x = F.col
    first = axes[0]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for axis in axes:
            bit = x(axis).bitwiseAND(1 << b) != 0
            if axis == first:
                rows = rows.withColumn(first, F.when(bit, x(first).bitwiseXOR(low)).otherwise(x(first)))
            else:
                swap = x(first).bitwiseXOR(x(axis)).bitwiseAND(low)
                rows = rows.withColumns(
                    {
                        first: x(first).bitwiseXOR(F.when(bit, low).otherwise(swap)),
                        axis: F.when(bit, x(axis)).otherwise(x(axis).bitwiseXOR(swap)),
                    }
                )
    for before, axis in zip(axes, axes[1:]):
        rows = rows.withColumn(axis, x(axis).bitwiseXOR(x(before)))
    turn = F.lit(0)
    for b in range(bits - 1, 0, -1):
        turn = turn.bitwiseXOR(F.when(x(axes[-1]).bitwiseAND(1 << b) != 0, (1 << b) - 1).otherwise(0))
    rows = rows.withColumn("turn ", turn)
    place = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for axis in axes:
            bit = F.shiftright(x(axis).bitwiseXOR(x("turn ")), b).bitwiseAND(1)
            place = F.shiftleft(place, 1).bitwiseOR(bit.cast("long"))
    return rows.withColumn(name, place).drop("turn ", *axes)


def hilbert_shards(
    docs: DataFrame,
    keep: Sequence[str],
    shards: int = SHARDS,
    key: str = "doc_id",
    text: str = "text",
    dimensions: Sequence[str] = DIMENSIONS,
    bits: int = BITS,
) -> DataFrame:
    """``row`` (struct of ``keep``), ``size``, ``text_crc32``, ``curve``, ``shard``, ``slot``: one row for each input row.

    Shards hold equally many rows, up to one (the first ones have one more), in order of the curve, the text's CRC, and
    the key; slots count from 0. A null text has no bytes, null dimensions have a cell of their own, null keys come
    first, repeated rows lie side by side in any order. With fewer rows than shards the last shards are empty; an
    empty table gives an empty result. No row count, value or copy is special: order is settled by a number each row
    gets when the table is written, so a third of equal rows is cut into ranges like all others.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    axes = [f"x{i}" for i in range(len(dimensions))]
    rows = docs.select(
        pack(keep),
        F.col(key).alias("id"),
        (F.octet_length(said) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(said, "UTF-8")).alias("text_crc32"),
        *[F.col(d).alias(a) for d, a in zip(dimensions, axes)],
        F.monotonically_increasing_id().alias("owner"),
    )
    rows = staged(rows, "shard-rows")
    starts = {a: cell_starts(rows, a, 1 << bits) for a in axes}
    rows = curve_index(rows.withColumns({a: cell_of(F.col(a), starts[a]) for a in axes}), axes, bits, "curve")
    order = ["curve", "text_crc32", "id", "owner"]
    placed = ranked(rows.repartitionByRange(*order).sortWithinPartitions(*order), "shard-order")
    wide = f"(rows % {shards}) * (rows div {shards} + 1)"  # rows in the shards that hold one more
    rank = placed.withColumn("rank", F.col("start") + F.col("at") % PLACES)
    more, less = f"(rows div {shards} + 1)", f"greatest(rows div {shards}, 1)"
    return rank.select(
        "row", "size", "text_crc32", "curve",
        F.expr(f"cast(if(rank < {wide}, rank div {more}, rows % {shards} + (rank - {wide}) div {less}) as int)").alias("shard"),
        F.expr(f"if(rank < {wide}, rank % {more}, (rank - {wide}) % {less})").alias("slot"),
    )


def _free(name: str, taken: Sequence[str]) -> str:
    while name in {c.lower() for c in taken}:
        name += "_"
    return name


def write_shards(docs: DataFrame, path: str, files: int = 1, **options) -> DataFrame:
    """Write all columns as Parquet, a folder for each shard and at least ``files`` files there, in order of slots.

    Returns the manifest, which is written too: ``shard``, ``rows``, ``bytes``, and ``least``/``most`` of each dimension
    (nulls apart, as ``nulls``). Where the documents have a column of the name, ``shard`` gets an underscore.
    """
    dims = options.get("dimensions", DIMENSIONS)
    name = _free("shard", docs.columns)
    dealt = hilbert_shards(docs, docs.columns, **options)
    row = F.col("row")
    bounds = [
        F.struct(F.min(row[d]).alias("least"), F.max(row[d]).alias("most"), F.count_if(row[d].isNull()).alias("nulls")).alias(f"d{i}")
        for i, d in enumerate(dims)
    ]
    manifest = dealt.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *bounds)
    count = options.get("shards", SHARDS) * files
    out = dealt.repartitionByRange(count, "shard", "slot").sortWithinPartitions("shard", "slot")
    out.select(*[row[c].alias(c) for c in docs.columns], F.col("shard").alias(name)).write.partitionBy(name).parquet(f"{path}/data")
    manifest.coalesce(1).write.parquet(f"{path}/manifest")
    return docs.sparkSession.read.parquet(f"{path}/manifest")


def read_shards(
    spark: SparkSession, path: str, ranges: Mapping[str, tuple], dimensions: Sequence[str] = DIMENSIONS
) -> DataFrame:
    """Rows whose dimensions lie within ``ranges`` (least and most, both included), from the shards that may have any."""
    manifest = spark.read.parquet(f"{path}/manifest")
    may = F.lit(True)
    for d, (least, most) in ranges.items():
        box = F.col(f"d{list(dimensions).index(d)}")
        may = may & (box["least"] <= F.lit(most)) & (box["most"] >= F.lit(least))
    wanted = [r[0] for r in manifest.where(may).select("shard").collect()]
    data = spark.read.parquet(f"{path}/data")
    name = data.columns[-1]
    found = data.where(F.col(name).isin(wanted)) if wanted else data.limit(0)
    for d, (least, most) in ranges.items():
        found = found.where(F.col(d).between(F.lit(least), F.lit(most)))
    return found.drop(name)


def _curve_sql(axes: Sequence[str], bits: int) -> str:
    """The curve as a chain of tables, from ``cells`` to ``curve``."""
    steps, last = [], "cells"

    def step(**new: str) -> None:
        nonlocal last
        kept = ", ".join(f"{new.get(a, a)} AS {a}" for a in axes)
        steps.append(f"s{len(steps)} AS (SELECT doc_id, {kept} FROM {last})")
        last = f"s{len(steps) - 1}"

    head = axes[0]
    for b in range(bits - 1, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        step(**{head: f"CASE WHEN {head} & {q} > 0 THEN xor({head}, {low}) ELSE {head} END"})
        for a in axes[1:]:
            swap = f"(xor({head}, {a}) & {low})"
            step(**{
                head: f"CASE WHEN {a} & {q} > 0 THEN xor({head}, {low}) ELSE xor({head}, {swap}) END",
                a: f"CASE WHEN {a} & {q} > 0 THEN {a} ELSE xor({a}, {swap}) END",
            })
    for before, a in zip(axes, axes[1:]):
        step(**{a: f"xor({a}, {before})"})
    turn = "0"
    for b in range(bits - 1, 0, -1):
        turn = f"xor({turn}, CASE WHEN {axes[-1]} & {1 << b} > 0 THEN {(1 << b) - 1} ELSE 0 END)"
    step(**{a: f"xor({a}, {turn})" for a in axes})
    total, weight = [], len(axes) * bits
    for b in range(bits - 1, -1, -1):
        for a in axes:
            weight -= 1
            total.append(f"(({a} >> {b}) & 1) * {1 << weight}")
    return ",\n".join([*steps, f"curve AS (SELECT doc_id, {' + '.join(total)} AS curve FROM {last})"])


def _cell_sql(column: str) -> str:
    rank = f"rank() OVER (PARTITION BY {column} IS NULL ORDER BY {column}) - 1"
    return f"CASE WHEN {column} IS NULL THEN 0 ELSE 1 + ({rank}) * {(1 << BITS) - 1} // count({column}) OVER () END"


SQL = f"""
WITH cells AS (
  SELECT doc_id, {", ".join(f"CAST({_cell_sql(c)} AS BIGINT) AS x{i}" for i, c in enumerate(DIMENSIONS))} FROM documents),
{_curve_sql([f"x{i}" for i in range(len(DIMENSIONS))], BITS)},
hashed AS (
  SELECT doc_id, strlen(coalesce(text, '')) + {OVERHEAD} AS size, {crc32("coalesce(text, '')")} AS text_crc32 FROM documents),
placed AS (
  SELECT *, row_number() OVER (ORDER BY curve, text_crc32, doc_id NULLS FIRST) - 1 AS r, count(*) OVER () AS n
  FROM hashed JOIN curve USING (doc_id)),
dealt AS (SELECT *, n // {SHARDS} AS per, (n % {SHARDS}) * (n // {SHARDS} + 1) AS wide FROM placed)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
       CAST(CASE WHEN r < wide THEN r // (per + 1) ELSE n % {SHARDS} + (r - wide) // greatest(per, 1) END AS INTEGER) AS shard,
       CAST(CASE WHEN r < wide THEN r % (per + 1) ELSE (r - wide) % greatest(per, 1) END AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM dealt
"""


@query("op11_hilbert_shards", SQL)
def op11_hilbert_shards(spark, folder):
    dealt = hilbert_shards(table(spark, folder, "documents"), ["doc_id"])
    return dealt.select(
        "row.doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
