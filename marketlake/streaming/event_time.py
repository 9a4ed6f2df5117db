"""Event-time streams: hourly fact and latest rows, closed by a watermark.

Both keep one state row per asset and open hour. An hour is closed once the watermark
(the greatest time seen less ``delay``) has passed its end; then its rows are given out
once, in one micro-batch, and its state is dropped, so the state holds only the hours
that fit between the watermark and the newest row. Rows of hours that are closed are
not counted any more; ``incremental_fact`` takes those up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from marketlake.functions.columns import enforce_types, processed_at
from marketlake.operators.gold import derived_measures, fact_aggregates
from marketlake.operators.silver import SILVER_COLUMNS
from marketlake.schema import BATCH_ID, FACT_SCHEMA, PAYLOAD_FIELDS, PROCESSED_AT, TRIGGER_INTERVAL
from marketlake.sinks.writers import publish
from marketlake.sources.tables import read_table
from marketlake.streaming.bronze_ingest import claim_bronze_path

#: How long rows of an hour may come after newer ones.
DELAY = "1 hour"


def _timed(snapshots: DataFrame, delay: str) -> DataFrame:
    """Typed rows with a time. Rows without one belong to no hour."""
    return enforce_types(snapshots).where(F.col("ingestion_ts").isNotNull()).withWatermark("ingestion_ts", delay)


def _hour() -> Column:
    return F.window("ingestion_ts", "1 hour").alias("_hour")


def _of_window(df: DataFrame) -> DataFrame:
    start = F.col("_hour.start")
    return df.withColumns({"dt": F.to_date(start), "hour": F.hour(start)}).drop("_hour")


def watermarked_fact(snapshots: DataFrame, delay: str = DELAY, clock: Column | None = None) -> DataFrame:
    """Hourly fact of a stream of snapshots, for output mode ``append``: the rows that
    ``operators.hourly_fact`` gives for closed hours."""
    grouped = _timed(snapshots, delay).groupBy(_hour(), "id", "symbol", "name").agg(*fact_aggregates())
    return derived_measures(_of_window(grouped), clock).select(*FACT_SCHEMA.fieldNames())


def watermarked_silver(snapshots: DataFrame, delay: str = DELAY, clock: Column | None = None) -> DataFrame:
    """Latest snapshot per asset and hour of a stream, for output mode ``append``: the
    rows that ``operators.silver_from_bronze`` gives for closed hours.

    State is one row per asset and open hour: the greatest of (time, payload), which is
    the order that the batch operator uses, nulls last."""
    payload = [c for c in PAYLOAD_FIELDS if c != "id"]
    latest = (
        _timed(snapshots, delay).groupBy(_hour(), "id")
        .agg(F.max(F.struct("ingestion_ts", *payload)).alias("_row"))
        .select("_hour", "id", "_row.*").withColumn(PROCESSED_AT, processed_at(clock))
    )
    return _of_window(latest).select(*SILVER_COLUMNS)


def _write_hours(path: str) -> Callable[[DataFrame, int], None]:
    def process(batch: DataFrame, batch_id: int) -> None:
        # All rows of an hour come in the batch that closes it, so each batch owns its
        # hours, and a replay replaces them.
        publish(batch.withColumn(BATCH_ID, F.lit(int(batch_id)).cast("long")), path, ("dt", BATCH_ID), mode="dynamic")

    return process


def read_closed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The closed hours that a stream has written (``FACT_SCHEMA`` or ``SILVER_SCHEMA``)."""
    return read_table(spark, path, schema).select(*schema.fieldNames())


def _start(rows: DataFrame, path: str, checkpoint: str, available_now: bool, interval: str) -> StreamingQuery:
    if not checkpoint:
        raise ValueError("a checkpoint location is required: it holds the state")
    claim_bronze_path(rows.sparkSession, path, checkpoint)
    writer = rows.writeStream.outputMode("append").foreachBatch(_write_hours(path)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def start_watermarked_fact(
    snapshots: DataFrame, path: str, checkpoint: str, delay: str = DELAY, available_now: bool = False,
    interval: str = TRIGGER_INTERVAL, clock: Column | None = None,
) -> StreamingQuery:
    """Write the fact rows of closed hours to ``path`` (``dt``/``batch_id`` partitions)."""
    return _start(watermarked_fact(snapshots, delay, clock), path, checkpoint, available_now, interval)


def start_watermarked_silver(
    snapshots: DataFrame, path: str, checkpoint: str, delay: str = DELAY, available_now: bool = False,
    interval: str = TRIGGER_INTERVAL, clock: Column | None = None,
) -> StreamingQuery:
    """Write the Silver rows of closed hours to ``path`` (``dt``/``batch_id`` partitions)."""
    return _start(watermarked_silver(snapshots, delay, clock), path, checkpoint, available_now, interval)
