"""Table maintenance as data jobs.

The snapshot-based table format of the original deployment is not available
here; its maintenance calls are re-aimed at what can be computed as Spark jobs:
which snapshots a retention rule expires, which files no table references, and
how fragmented a table is. Compaction itself is a writer (``sinks.compact``).
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.columns import is_sunday
from marketlake.session import any_path


def _ts(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.to_timestamp(F.lit(value))
    return F.lit(value)


# Tasks over which the snapshots of one table are spread.
SALTS = 32


def expired_snapshots(
    log: DataFrame,
    cutoff,
    table_col: str = "table_name",
    snapshot_col: str = "snapshot_id",
    ts_col: str = "committed_at",
) -> DataFrame:
    """Snapshots committed before ``cutoff`` that are not the newest of their
    table (the current snapshot is always retained).

    The newest snapshot per table is a hash aggregate (partial per map task, one
    row per table after the shuffle). It is joined back on the table and a salt
    made of the snapshot, so a table that holds most of the log is spread over
    ``SALTS`` tasks whichever join the planner picks."""
    newest = log.groupBy(table_col).agg(
        F.max(F.struct(F.col(ts_col).alias("t"), F.col(snapshot_col).alias("s"))).alias("_newest")
    )
    newest = newest.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    is_newest = (F.col(ts_col) == F.col("_newest.t")) & (F.col(snapshot_col) == F.col("_newest.s"))
    return (
        log.filter(F.col(ts_col) < _ts(cutoff))
        .withColumn("_salt", F.pmod(F.xxhash64(snapshot_col), F.lit(SALTS)).cast("int"))
        .join(newest, on=[table_col, "_salt"], how="inner")
        .filter(~is_newest)
        .drop("_newest", "_salt")
    )


def orphan_files(
    inventory: DataFrame,
    referenced: DataFrame,
    older_than,
    key_col: str = "file_path",
    ref_col: str | None = None,
    modified_col: str = "modified_at",
) -> DataFrame:
    """Files in ``inventory`` that no table references and that were last
    modified before ``older_than`` (young files may belong to a running write).

    The referenced keys are de-duplicated first (partial aggregation), so a file
    referenced by millions of rows costs one row in the shuffle; the anti-join
    then shuffles on the file key (or broadcasts, if AQE measures it small)."""
    ref_col = ref_col or key_col
    refs = referenced.select(F.col(ref_col).alias(key_col)).distinct()
    return inventory.filter(F.col(modified_col) < _ts(older_than)).join(refs, on=key_col, how="left_anti")


def normalize_path(col: str | Column) -> Column:
    """``file:/a``, ``file:///a`` and ``/a`` name the same local file."""
    col = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(col, r"^file:/+", "/")


def plain_path(path: str) -> str:
    """``normalize_path`` for a path the driver holds."""
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def file_inventory(spark: SparkSession, prefix: str) -> DataFrame:
    """Every data file below ``prefix`` with size and modification time.
    Uses the ``binaryFile`` listing without its ``content`` column, so no file
    is opened."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(prefix)
        .select(
            normalize_path("path").alias("file_path"),
            F.col("modificationTime").alias("modified_at"),
            F.col("length").alias("size_bytes"),
        )
    )


# Hidden folders that a failed or crashed write leaves in the folder it wrote to,
# and that the normal file listing skips: dynamic-overwrite staging and the output
# committer's temporary tree (job attempt and task attempt levels).
LEFTOVER_PATTERNS = (".spark-staging-*", "_temporary/*", "_temporary/*/_temporary/*")


def leftover_inventory(spark: SparkSession, root: str, tables: list[str] = ()) -> DataFrame | None:
    """Files below the hidden write leftovers of ``root``, of its direct
    subfolders, and of every table path (same columns as ``file_inventory``), or
    ``None`` when there are none. No table ever reads them, so once older than
    the retention cutoff they are orphans; a running write is younger than the
    cutoff and is never reported."""
    # A folder between the root and a table may have been written to as well.
    top = plain_path(root)
    places = {_literal(root.rstrip("/")), _literal(root.rstrip("/")) + "/*"}
    for path in tables:
        places.add(_literal(path.rstrip("/")))
        below = plain_path(path).removeprefix(top + "/").split("/") if plain_path(path).startswith(top + "/") else []
        for depth in range(1, len(below)):
            places.add(_literal("/".join([root.rstrip("/"), *below[:depth]])))
    found = None
    for place in sorted(places):
        for pattern in LEFTOVER_PATTERNS:
            if any_path(spark, f"{place}/{pattern}"):
                part = file_inventory(spark, f"{place}/{pattern}")
                found = part if found is None else found.unionByName(part)
    return None if found is None else found.dropDuplicates(["file_path"])


def _literal(path: str) -> str:
    """``path`` with the characters of glob patterns escaped."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def listed_files(
    spark: SparkSession, path: str, partition_cols: list[str], schema
) -> DataFrame | None:
    """One row per data file of a partitioned table: partition values (typed as
    in ``schema``), ``file_path`` and ``file_size``, from the file listing
    alone; no file is opened. ``None`` when the listing holds no partition
    folders (an empty table)."""
    listing = spark.read.format("binaryFile").load(path)
    if any(c not in listing.columns for c in partition_cols):
        return None
    return listing.select(
        *[F.col(c).cast(schema[c].dataType).alias(c) for c in partition_cols],
        normalize_path("path").alias("file_path"),
        F.col("length").alias("file_size"),
    )


def table_files(inventory: DataFrame, path: str, partition_cols: list[str]) -> DataFrame:
    """The files of ``inventory`` that belong to the table at ``path``: those in
    its partition folders. Decided by their paths alone, so a file without rows
    and a file that cannot be read belong to the table as well, and no file is
    opened."""
    prefix = plain_path(path) + "/"
    below = F.substr("file_path", F.lit(len(prefix) + 1))
    layout = "^" + "".join(f"{re.escape(c)}=[^/]*/" for c in partition_cols) + "[^/]+$"
    return inventory.where(F.startswith("file_path", F.lit(prefix)) & below.rlike(layout)).select("file_path")


def file_stats(table: DataFrame, partition_cols: list[str], small_file_bytes: int | None = None) -> DataFrame:
    """Fragmentation per partition: files, bytes, rows, smallest / largest file
    and (with ``small_file_bytes``) the number of small files.

    Two aggregates: first per file (rows; size is a per-file constant), then per
    partition, so each stage is a map-side-combined hash aggregate. Only the
    hidden ``_metadata`` column is read, not the data columns."""
    per_file = table.groupBy(
        *partition_cols,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
    ).agg(F.count(F.lit(1)).alias("rows"))
    aggs = [
        F.count(F.lit(1)).alias("files"),
        F.sum("file_size").alias("bytes"),
        F.sum("rows").alias("rows"),
        F.min("file_size").alias("min_file_bytes"),
        F.max("file_size").alias("max_file_bytes"),
    ]
    if small_file_bytes is not None:
        aggs.append(F.count_if(F.col("file_size") < F.lit(int(small_file_bytes))).alias("small_files"))
    return per_file.groupBy(*partition_cols).agg(*aggs)


def vacuum_days(df: DataFrame, day_col: str = "dt") -> DataFrame:
    """Distinct days on which the weekly vacuum runs (Sundays)."""
    return df.select(F.col(day_col).alias("dt")).filter(is_sunday("dt")).distinct()


def is_vacuum_day(day: _dt.date | str) -> bool:
    """Driver-side branch of the daily sequence (one date, not data)."""
    if isinstance(day, str):
        day = _dt.date.fromisoformat(day)
    return day.weekday() == 6
