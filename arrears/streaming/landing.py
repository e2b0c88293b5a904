"""Process each landed file exactly once.

The file source remembers finished files in its checkpoint, so a restarted job
goes on where the last one stopped; no list of done files is kept by hand.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from arrears.sources import archives
from arrears.sources.tables import write_parquet


def land_new_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    pattern: str | None = None,
    files_per_batch: int = 1000,
) -> None:
    """Append the files that arrived since the last call to ``target``."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    arriving = reader.parquet(folder)
    job = (
        (transform(arriving) if transform else arriving)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()


def land_new_archives(
    spark: SparkSession,
    folder: str,
    target: str,
    problems: str,
    checkpoint: str,
    archives_per_batch: int = 100,
    chunk_rows: int = archives.CHUNK_ROWS,
) -> None:
    """Read the zip archives that arrived since the last call; each lands once.

    The stream carries paths, not contents: members are listed and parsed in tasks of their own. A batch writes the
    folder of its number below ``target`` and ``problems``, by year and quarter, and replaces what a broken attempt
    left there, so a retry adds nothing twice. Bad archives and members become problems.
    """
    listing = spark.read.format("binaryFile").load(folder).schema
    arriving = (
        spark.readStream.format("binaryFile")
        .schema(listing)
        .option("pathGlobFilter", "*.zip")
        .option("maxFilesPerTrigger", archives_per_batch)
        .load(folder)
    )

    def land(batch: DataFrame, number: int) -> None:
        table, bad = archives.tables_of(archives.survey_archives(batch.select("path")), chunk_rows)
        write_parquet(table, f"{target}/batch={number}", ["ANO", "TRIMESTRE"])
        write_parquet(bad, f"{problems}/batch={number}")

    job = (
        arriving.select("path")
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()


def landed_rows(spark: SparkSession, target: str) -> DataFrame:
    """All rows landed so far, with the columns of the harmonised table."""
    texts = [*archives.DEBT_COLUMNS, "CNPJ", "FILE_NAME", "ANO", "TRIMESTRE", "ORIGEM"]
    fields = [T.StructField(c, T.StringType()) for c in texts]
    schema = T.StructType([*fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(schema).option("basePath", target).parquet(target).drop("batch")
