"""Deleting orphan files: the explicit step after a vacuum.

The vacuum only lists candidates. Deleting starts from the stored list, on executors,
and believes it in nothing: the warehouse is listed again, and a file goes only if it is
still unreferenced and old enough there, and if its modification time, read once more in
the task that deletes it, is still the one on the list.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.plans.jobs import LayerPaths, run_vacuum
from marketlake.schema import RETENTION_DAYS

CANDIDATE_SCHEMA = "file_path string, modified_at timestamp, size_bytes long"
RESULT_SCHEMA = "file_path string, size_bytes long, status string"

#: Files that one task deletes.
FILES_PER_TASK = 10_000


def store_candidates(found: DataFrame, path: str) -> DataFrame:
    """Write a vacuum's candidates to ``path`` and read them back."""
    found.select("file_path", "modified_at", "size_bytes").write.mode("overwrite").json(path)
    return read_candidates(found.sparkSession, path)


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CANDIDATE_SCHEMA).json(path)


def _delete(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    def location(path: str):
        if "://" not in path:
            return fs.LocalFileSystem(), path
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))

    for part in parts:
        status = []
        for path, modified_ms in zip(part.column("file_path").to_pylist(), part.column("modified_ms").to_pylist()):
            system, name = location(path)
            info = system.get_file_info(name)
            if info.type == fs.FileType.NotFound:
                status.append("missing")  # also what a repeated task finds of its own work
            elif info.type != fs.FileType.File or info.mtime_ns // 1_000_000 != modified_ms:
                status.append("kept")
            else:
                system.delete_file(name)
                status.append("deleted")
        yield pa.RecordBatch.from_arrays(
            [part.column("file_path"), part.column("size_bytes"), pa.array(status, pa.string())],
            names=["file_path", "size_bytes", "status"])


def delete_orphans(
    spark: SparkSession,
    paths: LayerPaths,
    candidates: DataFrame,
    out: str,
    now: _dt.datetime | None = None,
    retention_days: int = RETENTION_DAYS,
) -> DataFrame:
    """Delete the ``candidates`` of an earlier vacuum that are orphans still.

    Writes one row per candidate to ``out`` and returns it: file_path, size_bytes and
    status: ``deleted``; ``missing`` (gone before, or deleted by a task that was lost and
    repeated); or ``kept`` (referenced by now, too young, changed since it was listed,
    or outside the warehouse). Nothing but listed candidates is ever deleted."""
    _, still = run_vacuum(spark, paths, now, retention_days)
    # Not in the new listing: gone, or no orphan any more. The task that looks tells which.
    orphans = still.select("file_path", F.col("modified_at").alias("_now"))
    marked = candidates.join(orphans, "file_path", "left").withColumn(
        "sure", F.coalesce(F.col("_now") == F.col("modified_at"), F.lit(False)))
    # A time that no file has keeps what is not sure, and still tells what is missing.
    work = marked.select("file_path", "size_bytes", F.when(F.col("sure"), F.unix_millis("modified_at")).otherwise(-1).alias("modified_ms"))
    tasks = max(1, -(-candidates.count() // FILES_PER_TASK))
    work.repartition(tasks, "file_path").mapInArrow(_delete, RESULT_SCHEMA).write.mode("overwrite").parquet(out)
    return spark.read.schema(RESULT_SCHEMA).parquet(out)
