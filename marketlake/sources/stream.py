"""Streaming sources.

The collector lands snapshot files in a directory; a file stream picks them up
micro-batch by micro-batch with a fixed schema. The timed ``rate`` source is
kept for trigger-only smoke runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def landing_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(path)


def page_stream(
    spark: SparkSession, path: str, glob: str | None = None, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Landed page bodies, one file each: ``body`` and ``fetched_at`` (the file's
    modification time, which a replay of the batch sees again)."""
    reader = spark.readStream.format("text").option("wholetext", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(path).select(
        F.col("value").alias("body"), F.col("_metadata.file_modification_time").alias("fetched_at"))


def with_landing_time(source: DataFrame, name: str = "ingestion_ts") -> DataFrame:
    """A file stream's rows with the modification time of the file they landed in."""
    return source.select("*", F.col("_metadata.file_modification_time").alias(name))


def rate_trigger_stream(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
