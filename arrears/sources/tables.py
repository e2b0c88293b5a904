"""Parquet and CSV tables, in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from arrears.session import fresh_path


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Lazy scan; a column list reaches the reader."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",", encoding: str = "UTF-8"
) -> DataFrame:
    """CSV with a header. Without a schema Spark infers one, at the price of a pass."""
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str,
    lower: object,
    upper: object,
    partitions: int,
    **options: str,
) -> DataFrame:
    """Database query read by many connections, each taking a range of ``partition_column``."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", f"({query}) q")
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", partitions)
        .options(**options)
        .load()
    )


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], partitions: int | None = None) -> None:
    """Files that each hold one key range, rows in key order inside.

    Add a unique column to ``keys`` when the first one may be hot: ranges are
    cut on all of them, so one value can span many files.
    """
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


ROWS_PER_TASK = 50_000
MOST_ROWS = 500_000  # rows of a task that keeps much for each of them


def bounded(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """The same rows, dealt out by columns if partitions would hold more than ``MOST_ROWS`` on average."""
    tasks = -(-df.count() // MOST_ROWS)
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks, *by)


def stage(df: DataFrame, name: str, spread_by: Sequence[str] = ()) -> DataFrame:
    """Write to the shared folder and read back, which cuts the lineage.

    With ``spread_by``, a result in fewer files than its rows deserve is dealt
    out again by those columns, so that work on a small table uses more cores.
    A large one already has enough files and is left alone.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    write_parquet(df, path)
    written = spark.read.parquet(path)
    if not spread_by:
        return written
    cores = spark.sparkContext.defaultParallelism
    held = written.rdd.getNumPartitions()  # a plain scan: counts splits, runs nothing
    if held >= cores:
        return written
    tasks = min(cores, -(-written.count() // ROWS_PER_TASK))
    if held >= tasks:
        return written
    wider = fresh_path(spark, f"{name}-spread")
    write_parquet(written.repartition(tasks, *spread_by), wider)
    return spark.read.parquet(wider)
