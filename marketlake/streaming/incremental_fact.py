"""Incremental hourly fact with a recorded path for late rows.

Every micro-batch is reduced to partial aggregates (``operators.fact_state``) under its
own ``batch_id``. A row is late when the watermark, the greatest time of all earlier
batches less the delay, has passed the end of its hour. Late rows are written to a
table of their own, counted in the batch's record, and kept as partials of their own
kind, so on-time and late rows can always be told apart.

The fact of a day is merged from its partials when one of its hours closes or late rows
reach it; nothing reads the snapshots of earlier batches again, and days without news
are not touched. All tables of a batch are replaced when the batch is replayed.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake.functions.columns import enforce_types, ingestion_metadata
from marketlake.operators.fact_state import fact_of_partials, merge_facts, partial_facts, with_batch
from marketlake.schema import BATCH_ID, BRONZE_SCHEMA, FACT_KEYS, PAYLOAD_FIELDS, TRIGGER_INTERVAL
from marketlake.session import path_exists
from marketlake.sinks.writers import publish
from marketlake.streaming.bronze_ingest import claim_bronze_path

RECORD_SCHEMA = "rows long, on_time long, late long, untimed long, newest timestamp, watermark timestamp, batch_id long"
LATE_SCHEMA = BRONZE_SCHEMA
HOUR = _dt.timedelta(hours=1)


@dataclass(frozen=True)
class FactPaths:
    """Tables of an incremental fact under one root."""

    root: str

    @property
    def state(self) -> str:
        return f"{self.root.rstrip('/')}/state"

    @property
    def late(self) -> str:
        return f"{self.root.rstrip('/')}/late_rows"

    @property
    def batches(self) -> str:
        return f"{self.root.rstrip('/')}/batches"

    @property
    def fact(self) -> str:
        return f"{self.root.rstrip('/')}/fact"


def read_batches(spark: SparkSession, paths: FactPaths) -> DataFrame:
    """One row per batch: rows, on_time, late, untimed, newest time, watermark before it."""
    if not path_exists(spark, paths.batches):
        return spark.createDataFrame([], RECORD_SCHEMA)
    return spark.read.schema(RECORD_SCHEMA).parquet(paths.batches)


def read_state(spark: SparkSession, paths: FactPaths) -> DataFrame | None:
    return spark.read.parquet(paths.state) if path_exists(spark, paths.state) else None


def _newest(batches: DataFrame) -> _dt.datetime | None:
    return batches.agg(F.max("newest").alias("t")).first()["t"]


def _hour_end() -> Column:
    return F.col("dt").cast("timestamp") + F.make_interval(hours=F.col("hour") + 1)


def _by_watermark(watermark: _dt.datetime | None) -> Column:
    """Whether the row's hour is closed."""
    return F.lit(False) if watermark is None else _hour_end() <= F.lit(watermark)


def fact_batch_writer(paths: FactPaths, delay: _dt.timedelta = HOUR, clock: Column | None = None) -> Callable[[DataFrame, int], None]:
    """The micro-batch function: state, late rows, record, then the days with news."""

    def process(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        earlier = _newest(read_batches(spark, paths).where(F.col(BATCH_ID) < batch_id))
        watermark = earlier - delay if earlier else None
        rows = ingestion_metadata(enforce_types(batch.select(*PAYLOAD_FIELDS, "ingestion_ts")))
        rows = rows.withColumn("late", F.coalesce(_by_watermark(watermark), F.lit(False)))
        seen = Observation(f"fact-batch-{batch_id}")
        timed = F.col("ingestion_ts").isNotNull()
        counted = rows.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("late")).alias("late"), F.count_if(~timed).alias("untimed"),
            F.max("ingestion_ts").alias("newest"))
        publish(with_batch(partial_facts(counted.where(timed), [*FACT_KEYS, "late"]), batch_id), paths.state, ("dt", BATCH_ID))
        found = seen.get
        if found["late"] or found["untimed"]:
            # Rows without a time are kept here as well: they belong to no hour.
            aside = rows.where(F.col("late") | ~timed).select(*PAYLOAD_FIELDS, "ingestion_ts", "dt", "hour")
            publish(with_batch(aside, batch_id), paths.late, (BATCH_ID,))
        record = [(found["rows"], found["rows"] - found["late"] - found["untimed"], found["late"], found["untimed"],
                   found["newest"], watermark, batch_id)]
        publish(spark.createDataFrame(record, RECORD_SCHEMA), paths.batches, (BATCH_ID,))
        newest = max((t for t in (earlier, found["newest"]) if t is not None), default=None)
        if newest is not None:
            _refresh(spark, paths, batch_id, watermark, newest - delay, clock)

    return process


def _refresh(
    spark: SparkSession, paths: FactPaths, batch_id: int, before: _dt.datetime | None, after: _dt.datetime, clock: Column | None
) -> None:
    """Merge the days in which hours have closed since ``before``, and those that late
    rows of the batch have reached."""
    state = read_state(spark, paths)
    if state is None:
        return
    closed = F.lit(False)
    if before is None or before.replace(minute=0, second=0, microsecond=0) != after.replace(minute=0, second=0, microsecond=0):
        closed = F.col("dt") <= F.lit(after.date())
        if before is not None:
            # An hour that ends at midnight closes on the day after its own.
            closed = closed & (F.col("dt") >= F.lit((before - HOUR).date()))
    # One value per day with news: what the driver holds of any partitioned table.
    late = state.where((F.col(BATCH_ID) == batch_id) & F.col("late")).select("dt").distinct()
    days = [r["dt"] for r in late.union(state.where(closed).select("dt").distinct()).distinct().collect()]
    if days:
        publish(closed_fact(state.where(F.col("dt").isin(days)), after, clock), paths.fact, ("dt",))


def closed_fact(state: DataFrame, watermark: _dt.datetime, clock: Column | None = None) -> DataFrame:
    """Fact rows of the hours of ``state`` that have closed, on-time and late rows together."""
    return fact_of_partials(merge_facts(state.where(_by_watermark(watermark))), clock)


def start_incremental_fact(
    snapshots: DataFrame, root: str, checkpoint: str, delay: _dt.timedelta = HOUR, available_now: bool = False,
    interval: str = TRIGGER_INTERVAL, clock: Column | None = None,
) -> StreamingQuery:
    """Keep the fact under ``root`` up to date with a stream of snapshots
    (payload and ``ingestion_ts``)."""
    if not checkpoint:
        raise ValueError("a checkpoint location is required for exactly-once state")
    claim_bronze_path(snapshots.sparkSession, root, checkpoint)
    writer = snapshots.writeStream.foreachBatch(fact_batch_writer(FactPaths(root), delay, clock)).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()
