"""Bronze ingest as a micro-batch stream.

Snapshot files land in a directory; a file stream reads each new batch with a
fixed schema and ``foreachBatch`` appends it to the partitioned Bronze JSON
layer. Exactly-once output comes from three parts: the checkpoint (required)
records which files each batch consumed; every row's time comes from the source
(its own ``ingestion_ts``, the page's fetch time or the landed file's
modification time), so a replayed batch computes the same dt and hour; and each
batch writes to its own ``batch_id`` partition with dynamic overwrite, so the
replay replaces its own files rather than adding duplicates.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from marketlake.functions.columns import fill_nulls, ingestion_metadata
from marketlake.schema import PAYLOAD_FIELDS, TRIGGER_INTERVAL
from marketlake.session import path_exists
from marketlake.sinks.writers import append_bronze
from marketlake.sources.bronze import explode_pages

# Records which checkpoint feeds a Bronze path; the leading underscore hides it
# from table scans and from the file inventory.
OWNER_MARKER = "_stream_checkpoint"


def prepare_bronze(df: DataFrame, null_policy: str = "zero") -> DataFrame:
    """Payload projection + null policy + ingestion metadata (dt, hour derived
    from ``ingestion_ts``; ``ingestion_ts`` = now when the source has none)."""
    cols = PAYLOAD_FIELDS + (["ingestion_ts"] if "ingestion_ts" in df.columns else [])
    return ingestion_metadata(fill_nulls(df.select(*cols), null_policy))


def rows_of_pages(source: DataFrame, body_col: str = "body", time_col: str = "fetched_at") -> DataFrame:
    """Page bodies -> snapshot rows stamped with their page's fetch time."""
    rows = explode_pages(source, body_col, keep=[time_col])
    return rows.withColumnRenamed(time_col, "ingestion_ts")


def bronze_batch_writer(bronze_path: str, null_policy: str = "zero") -> Callable[[DataFrame, int], None]:
    def process(batch_df: DataFrame, batch_id: int) -> None:
        if "ingestion_ts" not in batch_df.columns:
            raise ValueError("rows of a replayable batch need their own ingestion_ts")
        # An empty batch writes no partition, so no emptiness check (and no
        # second pass over the batch) is needed.
        append_bronze(prepare_bronze(batch_df, null_policy), bronze_path, batch_id=batch_id)

    return process


def _norm(path: str) -> str:
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def claim_bronze_path(spark: SparkSession, bronze_path: str, checkpoint: str) -> None:
    """Bind ``bronze_path`` to ``checkpoint``; refuse any other checkpoint.

    Batch ids restart at 0 under a new checkpoint, and a new checkpoint re-reads
    the whole landing folder, so a second checkpoint on the same Bronze path
    would overwrite earlier batches (same id, same hour) or duplicate them."""
    marker = f"{bronze_path.rstrip('/')}/{OWNER_MARKER}"
    want = _norm(checkpoint)
    if path_exists(spark, marker):
        owner = spark.read.text(marker).first()
        if owner is not None and owner.value != want:
            raise ValueError(
                f"{bronze_path} is fed by checkpoint {owner.value}; a stream with another "
                "checkpoint needs its own Bronze path")
        return
    spark.createDataFrame([(want,)], "value string").coalesce(1).write.mode("overwrite").text(marker)


def start_bronze_stream(
    source: DataFrame,
    bronze_path: str,
    checkpoint: str,
    null_policy: str = "zero",
    available_now: bool = False,
    interval: str = TRIGGER_INTERVAL,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start the ingest of snapshot rows, or of page bodies (``body`` and
    ``fetched_at``, see ``sources.page_stream``).

    The source carries the time of its rows: ``ingestion_ts`` or ``fetched_at``;
    ``sources.with_landing_time`` adds it to a file stream without one.
    ``available_now=True`` drains what has landed and stops (tests, backfills);
    otherwise a processing-time trigger every ``interval``."""
    if not checkpoint:
        raise ValueError("a checkpoint location is required for exactly-once ingest")
    if {"body", "fetched_at"} <= set(source.columns):
        source = rows_of_pages(source)
    if "ingestion_ts" not in source.columns:
        raise ValueError("the source needs ingestion_ts or fetched_at; see sources.with_landing_time")
    claim_bronze_path(source.sparkSession, bronze_path, checkpoint)
    writer = (
        source.writeStream.foreachBatch(bronze_batch_writer(bronze_path, null_policy))
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
