"""Reader for the collector's newline-JSON batch files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, IntegerType, StructField, StructType, TimestampType

from marketlake.schema import PAYLOAD_SCHEMA

NDJSON_SCHEMA = StructType(
    PAYLOAD_SCHEMA.fields
    + [
        StructField("ingestion_ts", TimestampType()),
        StructField("dt", DateType()),
        StructField("hour", IntegerType()),
    ]
)
NDJSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def read_ndjson(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(NDJSON_SCHEMA)
        .option("timestampFormat", NDJSON_TIMESTAMP_FORMAT)
        .json(path)
    )
