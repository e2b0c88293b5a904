"""Quarterly snapshots as one table, by quarter and bucketed by debt.

Quarters are landed one at a time, each exchanged once, when it is written. Joins of quarters on the debt then read
bucket against bucket without an exchange, and only the quarters asked for. A bucket is one task, so a table is to be
bucketed by a key of few rows each, such as the debt or a registry's own id; for hot debtors there is ``join_spread``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 4_000_000
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def buckets_for(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """A power of two, so that tables of different size still fit each other's buckets."""
    wanted = max(1, -(-rows // rows_per_bucket))
    return 1 << (wanted - 1).bit_length()


def _identifier(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def attach(spark: SparkSession, name: str, path: str, schema: str, key: str, buckets: int, period: str | None = None) -> DataFrame:
    """The table at ``path`` under a name of this session's catalog; ``schema`` as DDL, with the period last.

    For a session whose catalog does not know the table, or a folder that is still empty.
    """
    parts = f"PARTITIONED BY ({_identifier(period)})" if period else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_identifier(name)} ({schema}) USING parquet {parts} "
        f"CLUSTERED BY ({_identifier(key)}) SORTED BY ({_identifier(key)}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if period and place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        spark.catalog.recoverPartitions(_identifier(name))
    return spark.table(_identifier(name))


def ddl_of(df: DataFrame, last: Sequence[str] = ()) -> str:
    """Columns and types as DDL, the given ones at the end."""
    types = dict(df.dtypes)
    return ", ".join(f"{_identifier(c)} {types[c]}" for c in [*[c for c in df.columns if c not in last], *last])


def _bucketed(spark: SparkSession, name: str) -> tuple[str, int]:
    """Key and number of buckets of a table, as the catalog has them."""
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_identifier(name)}").collect()}
    return facts["Bucket Columns"].strip("[]").strip("`"), int(facts["Num Buckets"])


def write_bucketed(df: DataFrame, name: str) -> DataFrame:
    """Replace the rows of an attached table; with periods, those of the periods that ``df`` holds.

    Running it again gives the same table. One task writes one bucket, so a bucket is one file a period. Rows without
    a key stand in a bucket of their own hash and match nothing.
    """
    spark = df.sparkSession
    key, buckets = _bucketed(spark, name)
    columns = spark.table(_identifier(name)).columns
    dealt = df.select(*[F.col(_identifier(c)) for c in columns]).repartition(buckets, F.col(_identifier(key)))
    before = spark.conf.get(OVERWRITE)
    spark.conf.set(OVERWRITE, "dynamic")  # a writer's option does not reach insertInto
    try:
        dealt.write.insertInto(_identifier(name), overwrite=True)
    finally:
        spark.conf.set(OVERWRITE, before)
    return spark.table(_identifier(name))


def land_snapshot(df: DataFrame, name: str, path: str, key: str, period: str, buckets: int) -> DataFrame:
    """Land one or more quarters in the table, made when first needed; a quarter landed again is replaced."""
    attach(df.sparkSession, name, path, ddl_of(df, [period]), key, buckets, period)
    return write_bucketed(df, name)


def land_registry(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A registry of one row a key, bucketed by it: joins exchange the other side only."""
    attach(df.sparkSession, name, path, ddl_of(df), key, buckets)
    return write_bucketed(df, name)
