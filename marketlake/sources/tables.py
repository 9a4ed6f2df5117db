"""Reads of the Silver / Gold tables by path, always with their schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from marketlake.session import path_exists
from marketlake.sources.bronze import filter_dates


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    dates: str | list[str] | None = None,
) -> DataFrame:
    """Parquet table read through its path (partition discovery, pruning on
    ``dt``). An absent table reads as an empty frame with the schema."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(path)
    return filter_dates(df, dates)
