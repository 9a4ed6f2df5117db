"""Batch jobs of the pipeline.

Each job reads a layer through its path with an explicit schema, runs the
operators and publishes with dynamic partition overwrite: re-running a day
replaces that day only. Row counts come from ``Observation`` metrics collected
in the same pass as the write, never from re-running the plan. Between jobs the
data is on storage, which also cuts lineage: a lost executor re-runs only tasks
of the current job.
"""

from __future__ import annotations

import datetime as _dt
import logging
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.gold import daily_dimension, hourly_fact
from marketlake.operators.gold_views import Gold
from marketlake.operators.maintenance import (
    file_inventory,
    is_vacuum_day,
    leftover_inventory,
    orphan_files,
    plain_path,
    table_files,
)
from marketlake.operators.silver import silver_from_bronze
from marketlake.schema import (
    DIMENSION_SCHEMA,
    DIMENSION_TABLE,
    FACT_SCHEMA,
    FACT_TABLE,
    BATCH_ID,
    RETENTION_DAYS,
    SILVER_SCHEMA,
    SILVER_TABLE,
    BRONZE_TABLE,
    TRIGGER_INTERVAL,
)
from marketlake.session import configure, path_exists, qualified
from marketlake.sinks.rewrite import recover
from marketlake.sinks.writers import append_bronze, compact, fold_bronze, publish, write_ndjson
from marketlake.sources.bronze import days_present, explode_pages, read_bronze, untimed_rows
from marketlake.sources.tables import read_table
from marketlake.functions.columns import fill_nulls, ingestion_metadata, retention_cutoff

log = logging.getLogger("marketlake")

Dates = str | list[str] | None


@dataclass(frozen=True)
class LayerPaths:
    """Locations of the four tables under one warehouse root."""

    root: str
    bronze: str = field(default="")
    silver: str = field(default="")
    fact: str = field(default="")
    dimension: str = field(default="")

    def __post_init__(self):
        root = self.root.rstrip("/")
        object.__setattr__(self, "root", root)
        for name, table in (("bronze", BRONZE_TABLE), ("silver", SILVER_TABLE),
                            ("fact", FACT_TABLE), ("dimension", DIMENSION_TABLE)):
            if not getattr(self, name):
                object.__setattr__(self, name, f"{root}/{table}")

    def tables(self) -> list[tuple[str, str, object]]:
        return [
            (SILVER_TABLE, self.silver, SILVER_SCHEMA),
            (FACT_TABLE, self.fact, FACT_SCHEMA),
            (DIMENSION_TABLE, self.dimension, DIMENSION_SCHEMA),
        ]


def open_gold(spark: SparkSession, paths: LayerPaths) -> Gold:
    """The published Gold tables of a warehouse, to be queried."""
    return Gold(spark, paths.fact, paths.dimension)


def _metrics(obs: Observation) -> dict:
    return dict(obs.get)


def run_silver(
    spark: SparkSession,
    paths: LayerPaths,
    dates: Dates = None,
    clock: Column | None = None,
) -> dict:
    """Bronze (JSON, given days) -> typed, deduplicated Silver (Parquet by dt).

    Returns counts before / after de-duplication, observed during the write.
    A day with no Bronze data is a no-op. Rows without a time have no day and are
    left out (``sources.bronze.untimed_rows``)."""
    configure(spark)
    raw = read_bronze(spark, paths.bronze, dates)
    before, after = Observation("silver_in"), Observation("silver_out")
    raw = raw.observe(before, F.count(F.lit(1)).alias("rows")).where(F.col("dt").isNotNull())
    silver = silver_from_bronze(raw, clock).observe(after, F.count(F.lit(1)).alias("rows"))
    publish(silver, paths.silver, ("dt",), mode="dynamic")
    counts = {"bronze_rows": _metrics(before).get("rows", 0), "silver_rows": _metrics(after).get("rows", 0)}
    log.info("silver %s: %s", dates, counts)
    return counts


def run_gold(
    spark: SparkSession,
    paths: LayerPaths,
    dates: Dates = None,
    clock: Column | None = None,
    fact_input: str = "silver",
) -> dict:
    """Silver (given days) -> hourly fact + daily dimension.

    ``fact_input="silver"`` aggregates deduplicated Silver (one row per group,
    as the original job does); ``"bronze"`` aggregates every raw snapshot of
    the hour, which gives meaningful min / max / deviation."""
    configure(spark)
    silver = read_table(spark, paths.silver, SILVER_SCHEMA, dates)
    if fact_input == "silver":
        fact_src = silver
    elif fact_input == "bronze":
        from marketlake.functions.columns import enforce_types

        fact_src = enforce_types(read_bronze(spark, paths.bronze, dates), clock)
    else:
        raise ValueError("fact_input must be 'silver' or 'bronze'")
    fact_obs, dim_obs = Observation("fact"), Observation("dim")
    fact = hourly_fact(fact_src, clock).observe(fact_obs, F.count(F.lit(1)).alias("rows"))
    publish(fact.select(*FACT_SCHEMA.fieldNames()), paths.fact, ("dt",), mode="dynamic")
    dim = daily_dimension(silver, None, clock).observe(dim_obs, F.count(F.lit(1)).alias("rows"))
    publish(dim.select(*DIMENSION_SCHEMA.fieldNames()), paths.dimension, ("dt",), mode="dynamic")
    counts = {"fact_rows": _metrics(fact_obs).get("rows", 0), "dim_rows": _metrics(dim_obs).get("rows", 0)}
    log.info("gold %s: %s", dates, counts)
    return counts


@dataclass(frozen=True)
class MaintenanceResult:
    table: str
    status: str
    message: str


def run_compaction(spark: SparkSession, paths: LayerPaths) -> list[MaintenanceResult]:
    """Compact every layer table; one table's failure is logged and skipped."""
    results = []
    for name, path, schema in paths.tables():
        try:
            if not path_exists(spark, path):
                results.append(MaintenanceResult(name, "skipped", "table does not exist"))
                continue
            compact(spark, path, schema)
            results.append(MaintenanceResult(name, "ok", "compacted"))
        except Exception as exc:  # keep going with the other tables
            log.warning("compaction of %s failed: %s", name, exc)
            results.append(MaintenanceResult(name, "failed", str(exc)))
    return results


def run_vacuum(
    spark: SparkSession,
    paths: LayerPaths,
    now: _dt.datetime | None = None,
    retention_days: int = RETENTION_DAYS,
) -> tuple[list[MaintenanceResult], DataFrame]:
    """Weekly vacuum: orphan-file candidates in the warehouse.

    The inventory is the file listing of the warehouse root and of tables that
    live elsewhere, with the staging and temporary files of writes that crashed.
    A file is referenced when it lies in a partition folder of one of the tables,
    which the listing tells as well: no data file is opened, so neither an empty
    nor a broken file disturbs the job. Unreferenced files older than the
    retention window are candidates. Interrupted rewrites are recovered first, so
    a work folder never holds the only copy of a row.

    ``now`` is an instant (naive values are UTC). Tables and roots are handled one
    by one: one that cannot be listed is reported as failed, none of its files is
    a candidate, and the others are still done. Returns the status of each and
    the candidate list; deleting is a separate, explicit step."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    cutoff = retention_cutoff(now if now.tzinfo else now.replace(tzinfo=_dt.timezone.utc), retention_days)
    tables = [(BRONZE_TABLE, qualified(spark, paths.bronze), ["dt", "hour", BATCH_ID])] + [
        (name, qualified(spark, path), ["dt"]) for name, path, _ in paths.tables()]
    root = qualified(spark, paths.root)
    outside = [(n, p) for n, p, _ in tables if not plain_path(p).startswith(plain_path(root) + "/")]

    results, excluded, inventory = [], [], None
    for name, path, keys in tables:
        try:
            if not path_exists(spark, path):
                results.append(MaintenanceResult(name, "skipped", "table does not exist"))
                continue
            recover(spark, path, len(keys) if name != BRONZE_TABLE else 2)
            if not file_inventory(spark, path).isEmpty():
                results.append(MaintenanceResult(name, "ok", "listed"))
            else:
                results.append(MaintenanceResult(name, "ok", "no files"))
        except Exception as exc:  # keep going; never report this table's files
            log.warning("vacuum of %s failed: %s", name, exc)
            results.append(MaintenanceResult(name, "failed", str(exc)))
            excluded.append(path)
    for name, place in [("warehouse", root), *outside]:
        try:
            if not path_exists(spark, place) or place in excluded:
                continue
            listed = file_inventory(spark, place)
            hidden = leftover_inventory(spark, place, [p for _, p, _ in tables] if place == root else [])
            found = listed if hidden is None else listed.unionByName(hidden)
            inventory = found if inventory is None else inventory.unionByName(found)
        except Exception as exc:
            log.warning("listing %s failed: %s", place, exc)
            results.append(MaintenanceResult(name, "failed", str(exc)))
    if inventory is None:
        inventory = spark.createDataFrame([], "file_path string, modified_at timestamp, size_bytes long")
    for path in excluded:
        inventory = inventory.filter(~F.startswith("file_path", F.lit(plain_path(path) + "/")))
    refs = None
    for _, path, keys in tables:
        own = table_files(inventory, path, keys)
        refs = own if refs is None else refs.unionByName(own)
    return results, orphan_files(inventory, refs, cutoff)


def run_day(
    spark: SparkSession,
    paths: LayerPaths,
    dates: Dates,
    clock: Column | None = None,
    fact_input: str = "silver",
    compact_tables: bool = True,
    now: _dt.datetime | None = None,
    retention_days: int = RETENTION_DAYS,
    fold_before: str | None = None,
) -> dict:
    """The daily sequence: Silver -> Gold -> compaction -> vacuum on Sundays.

    ``dates`` may be one day, several (a backfill in one pass per layer) or None:
    every day that Bronze holds. ``untimed_rows`` of the report counts the Bronze rows
    without a time, which no day holds. ``fold_before`` names the day from which on the
    stream may still replay a batch: of the ``dates`` before it, the batch folders that
    the stream left in Bronze are folded into one per hour first."""
    if dates is None:
        dates = days_present(spark, paths.bronze)
    report = {}
    if fold_before is not None:
        closed = [d for d in ([dates] if isinstance(dates, str) else dates) if d < fold_before]
        report["folded_hours"] = fold_bronze(spark, paths.bronze, closed)
    report["silver"] = run_silver(spark, paths, dates, clock)
    report["untimed_rows"] = untimed_rows(spark, paths.bronze).count()
    report["gold"] = run_gold(spark, paths, dates, clock, fact_input)
    if compact_tables:
        report["compaction"] = run_compaction(spark, paths)
    days = [dates] if isinstance(dates, str) else list(dates or [])
    if any(is_vacuum_day(d) for d in days):
        results, candidates = run_vacuum(spark, paths, now, retention_days)
        report["vacuum"] = results
        report["orphan_candidates"] = candidates
    return report


def run_collection_cycle(
    spark: SparkSession,
    pages: DataFrame,
    out_dir: str,
    body_col: str = "body",
    fetched_at_col: str | None = "fetched_at",
) -> dict:
    """One collection cycle on landed pages: parse, stamp with ingestion time
    (the page's fetch time, or now), keep nulls, save as newline JSON."""
    obs = Observation("collection")
    keep = [fetched_at_col] if fetched_at_col and fetched_at_col in pages.columns else []
    rows = explode_pages(pages, body_col, keep=keep, observation=obs)
    if keep:
        rows = rows.withColumnRenamed(fetched_at_col, "ingestion_ts")
    enriched = ingestion_metadata(fill_nulls(rows, "keep"))
    write_ndjson(enriched, out_dir)
    return _metrics(obs)


def ingest_bronze_batch(
    spark: SparkSession, paths: LayerPaths, snapshots: DataFrame, null_policy: str = "keep", batch_id: int | None = None
) -> int:
    """Append already-parsed snapshots to the Bronze layer that the stream feeds,
    in the same layout. A caller that may repeat the append passes its own
    negative ``batch_id``. Returns the number used."""
    from marketlake.streaming.bronze_ingest import prepare_bronze

    if batch_id is not None and batch_id >= 0:
        raise ValueError("numbers from 0 belong to the stream's micro-batches")
    return append_bronze(prepare_bronze(snapshots, null_policy), paths.bronze, batch_id=batch_id)


def run_ingest(
    spark: SparkSession,
    paths: LayerPaths,
    landing: str,
    checkpoint: str,
    null_policy: str = "zero",
    available_now: bool = False,
    interval: str = TRIGGER_INTERVAL,
    progress: str | None = None,
    stop_marker: str | None = None,
):
    """Stream landed page bodies (one file each) into Bronze until stopped, or,
    with ``available_now``, until all that has landed is in. ``progress`` is a table of
    what each micro-batch did; a file at ``stop_marker`` ends the stream after the
    micro-batch that is running."""
    from marketlake.sources.stream import page_stream
    from marketlake.streaming.bronze_ingest import start_bronze_stream
    from marketlake.streaming.progress import run_until_stopped

    configure(spark)
    return run_until_stopped(spark, lambda: start_bronze_stream(
        page_stream(spark, landing), paths.bronze, checkpoint, null_policy, available_now, interval),
        progress or f"{checkpoint.rstrip('/')}__progress", stop_marker)
