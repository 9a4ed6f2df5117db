"""Table writers.

Every writer ends in one Spark write job. Output is rebalanced on the partition
columns first: AQE sizes the write tasks to ``advisoryPartitionSizeInBytes``,
merging small partitions and splitting a skewed day over several tasks, so the
table gets neither thousands of tiny files nor one giant task.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from marketlake.schema import BATCH_ID
from marketlake.session import SESSION_SETTINGS, child_folders, note, notes
from marketlake.sinks.rewrite import recover, rewrite_folders
from marketlake.sources.ndjson import NDJSON_TIMESTAMP_FORMAT

# Millisecond text timestamps in Bronze JSON (what the JSON writer keeps).
JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"


def _rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")


def publish(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("dt",),
    mode: str = "dynamic",
    max_records_per_file: int | None = None,
) -> None:
    """Write a layer table as Parquet.

    ``mode="dynamic"``: replace only the partitions present in ``df`` (a re-run
    of a day is idempotent, other days stay). ``mode="replace"``: replace the
    whole table. ``mode="append"``: add files.
    """
    if mode not in ("dynamic", "replace", "append"):
        raise ValueError(f"unknown publish mode {mode!r}")
    writer = _rebalanced(df, partition_by).write.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    if mode == "append":
        writer.mode("append").parquet(path)
        return
    overwrite = "dynamic" if mode == "dynamic" else "static"
    writer.mode("overwrite").option("partitionOverwriteMode", overwrite).parquet(path)


# Holds the number of the last batch that a Bronze append has begun; the leading
# underscore hides it from table scans and from the file inventory.
BEGUN = "_last_batch"


def append_bronze(
    df: DataFrame,
    base: str,
    batch_id: int | None = None,
    partition_by: Sequence[str] = ("dt", "hour"),
) -> int:
    """Append snapshot rows to the Bronze JSON layer, partitioned by dt/hour/batch_id.

    Rows go to their own ``batch_id=<n>`` partition, so replaying a batch replaces its
    earlier output instead of duplicating it (the stream sink is at-least-once).
    Micro-batches of a stream are numbered from 0; an append without a ``batch_id``
    takes a fresh negative number, so batch and stream share one layout and one layer.
    Returns the number used.

    A fresh number, and a micro-batch beyond the last one that was begun, have nothing
    to replace and are appended, which spares the file system a rename per partition.
    All others are written with dynamic partition overwrite."""
    from pyspark.sql import functions as F

    spark, begun = df.sparkSession, f"{base.rstrip('/')}/{BEGUN}"
    fresh = batch_id is None
    if fresh:
        batch_id = -1 - (uuid.uuid4().int >> 66)
    elif batch_id >= 0:
        fresh = all(int(n) < batch_id for n in notes(spark, begun))
        if fresh:
            note(spark, begun, str(int(batch_id)))
    df = df.withColumn(BATCH_ID, F.lit(int(batch_id)).cast("long"))
    writer = _rebalanced(df, partition_by).write.mode("append" if fresh else "overwrite")
    (
        writer.option("timestampFormat", JSON_TIMESTAMP_FORMAT)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by, BATCH_ID)
        .json(base)
    )
    return batch_id


def write_ndjson(df: DataFrame, out_dir: str, mode: str = "append") -> None:
    """Newline-delimited JSON batch files in ``out_dir`` (one object per line,
    nulls dropped by the JSON writer, timestamps as ISO text)."""
    (
        df.write.mode(mode)
        .option("timestampFormat", NDJSON_TIMESTAMP_FORMAT)
        .json(out_dir)
    )


def land_pages(pages: DataFrame, out_dir: str, body_col: str = "body") -> None:
    """Page bodies as text, one file each (see ``sources.page_stream``). Every write task
    fills a folder of its own, so the commit renames a folder per task, not per page, and
    the listings run over as many folders."""
    from pyspark.sql import functions as F

    (
        pages.select(F.spark_partition_id().alias("lot"), F.col(body_col).alias("value"))
        .write.partitionBy("lot")
        .option("maxRecordsPerFile", 1)
        .text(out_dir)
    )


def compact(
    spark: SparkSession,
    path: str,
    schema: StructType,
    partition_by: Sequence[str] = ("dt",),
    max_records_per_file: int | None = None,
    target_file_bytes: int = 128 * 1024 * 1024,
    min_small_files: int = 2,
    group_size: int = 32,
) -> dict:
    """Rewrite the fragmented partitions of a Parquet table into fewer files.

    A partition is rewritten when it holds at least ``min_small_files`` files
    smaller than 3/4 of ``target_file_bytes``; the others are not touched, so a
    daily run rewrites only what changed. The choice comes from the file listing
    alone (one listing, no file is opened). Chosen partitions are rewritten in
    groups of ``group_size``: a group's folders are read by their paths, so the
    plan is the same for ten and for 200,000 partitions and nothing is joined or
    broadcast. Rows are rebalanced so that AQE cuts tasks of about
    ``target_file_bytes``, in a session of its own, so that no other job sees
    that setting. Files are written beside the table, counted and swapped in
    (``sinks.rewrite``); interrupted swaps of an earlier run are recovered first.

    Returns partitions, files and small files seen, partitions rewritten, and
    files after."""
    from pyspark.sql import functions as F

    from marketlake.operators.maintenance import listed_files

    parts, path = list(partition_by), path.rstrip("/")
    recover(spark, path, len(parts))
    small = int(target_file_bytes * 3 // 4)
    files = listed_files(spark, path, parts, schema)
    if files is None:  # no partition folders yet: nothing is fragmented
        return {"partitions": 0, "files": 0, "small_files": 0, "partitions_rewritten": 0, "files_after": 0}
    depth = len(parts)
    folder = F.array_join(F.slice(F.split("file_path", "/"), -(depth + 1), depth), "/")
    stats = files.groupBy(folder.alias("folder")).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("file_size") < F.lit(small)).alias("small_files"))
    # One row per partition folder: what the driver holds of any partitioned table.
    seen = stats.collect()
    todo = sorted(r["folder"] for r in seen if r["small_files"] >= min_small_files)

    own = spark.newSession()
    for key, value in (*SESSION_SETTINGS.items(), ("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(int(target_file_bytes)))):
        own.conf.set(key, value)

    def read(base: str, folders: list[str]) -> DataFrame:
        return own.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders])

    def write(df: DataFrame, base: str) -> None:
        publish(df, base, parts, mode="replace", max_records_per_file=max_records_per_file)

    for begin in range(0, len(todo), group_size):
        rewrite_folders(spark, path, todo[begin:begin + group_size], parts, read, write)
    after = listed_files(spark, path, parts, schema) if todo else files
    return {
        "partitions": len(seen),
        "files": sum(r["files"] for r in seen),
        "small_files": sum(r["small_files"] for r in seen),
        "partitions_rewritten": len(todo),
        "files_after": after.count() if after is not None else 0,
    }


def fold_bronze(spark: SparkSession, base: str, dates: str | list[str], schema: StructType | None = None) -> int:
    """Fold the batches of closed Bronze days: every hour keeps its rows, in one
    ``batch_id`` folder instead of one per micro-batch (2,880 a day). Returns the
    number of hours folded.

    Only for days that no stream batch can be replayed into any more: a replay
    would add its rows again. ``batch_id`` becomes the fold's own negative number."""
    from pyspark.sql import functions as F

    from marketlake.schema import BRONZE_SCHEMA

    schema, base = schema or BRONZE_SCHEMA, base.rstrip("/")
    recover(spark, base, 2)
    folded = 0
    for day in [dates] if isinstance(dates, str) else list(dates):
        hours = [f"dt={day}/{h}" for h in child_folders(spark, f"{base}/dt={day}") if h.startswith("hour=")]
        hours = [h for h in hours if len(child_folders(spark, f"{base}/{h}")) > 1]
        if not hours:
            continue

        def read(root: str, folders: list[str]) -> DataFrame:
            return spark.read.schema(schema).option("basePath", root).json([f"{root}/{f}" for f in folders])

        def write(df: DataFrame, root: str) -> None:
            append_bronze(df.drop(BATCH_ID), root)

        rewrite_folders(spark, base, hours, ["dt", "hour"], read, write)
        folded += len(hours)
    return folded
