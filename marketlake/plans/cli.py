"""Command line: ``python -m marketlake.plans.cli <job> --execution_date YYYY-MM-DD``.

The master and storage settings come from ``spark-submit``; the job never sets
them itself.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.plans.cleanup import delete_orphans, read_candidates, store_candidates
from marketlake.plans.jobs import (
    LayerPaths,
    ingest_bronze_batch,
    run_collection_cycle,
    run_compaction,
    run_day,
    run_gold,
    run_ingest,
    run_silver,
    run_vacuum,
)
from marketlake.schema import RETENTION_DAYS, TRIGGER_INTERVAL
from marketlake.sources.ndjson import read_ndjson


def _date(text: str) -> str:
    return _dt.date.fromisoformat(text).isoformat()


def _candidates(found: DataFrame, out: str | None) -> dict:
    """Compute the vacuum's candidates: stored under ``out``, if given, and counted."""
    if out:
        found = store_candidates(found, out)
    row = found.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes")).first()
    return {"files": row["files"], "bytes": row["bytes"], "list": out}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="marketlake", description="market snapshot pipeline jobs")
    parser.add_argument("job", choices=["ingest", "collect", "load", "silver", "gold", "day", "compaction", "vacuum"])
    parser.add_argument("--execution_date", type=_date, help="YYYY-MM-DD")
    parser.add_argument("--warehouse", required=True, help="root folder of the tables")
    parser.add_argument("--fact_input", choices=["silver", "bronze"], default="silver")
    parser.add_argument("--landing", help="folder of landed page bodies, one file each (ingest, collect)")
    parser.add_argument("--out", help="folder of the newline-JSON files (collect, load)")
    parser.add_argument("--batch", type=int, help="number of the load, from 1: loading it again replaces it (load)")
    parser.add_argument("--checkpoint", help="checkpoint folder of the stream (ingest)")
    parser.add_argument("--available_now", action="store_true", help="ingest what has landed, then stop")
    parser.add_argument("--interval", default=TRIGGER_INTERVAL, help="time between micro-batches (ingest)")
    parser.add_argument("--progress", help="table of what each micro-batch did (ingest)")
    parser.add_argument("--stop_marker", help="a file that ends the stream after the running micro-batch (ingest)")
    parser.add_argument("--fold_before", type=_date, help="days before this one have no batches to replay: fold them (day)")
    parser.add_argument("--retention_days", type=int, default=RETENTION_DAYS, help="age of vacuum candidates")
    parser.add_argument("--candidates", help="folder for the list of vacuum candidates (day, vacuum)")
    parser.add_argument("--delete", metavar="RESULTS", help="delete what the list --candidates of an earlier run "
                        "names and is still an orphan; what became of each file is written to RESULTS (vacuum)")
    args = parser.parse_args(argv)
    if args.job == "ingest" and not (args.landing and args.checkpoint):
        parser.error("ingest needs --landing and --checkpoint")
    if args.job == "load" and not (args.out and args.batch and args.batch > 0):
        parser.error("load needs --out and a --batch from 1")
    if args.delete and not (args.job == "vacuum" and args.candidates):
        parser.error("--delete belongs to vacuum and needs --candidates")
    if args.job == "collect" and not (args.landing and args.out):
        parser.error("collect needs --landing and --out")
    if args.job in ("silver", "gold", "day") and not args.execution_date:
        parser.error("--execution_date is required for this job")

    spark = SparkSession.builder.appName(f"marketlake-{args.job}").getOrCreate()
    paths = LayerPaths(args.warehouse)
    if args.job == "ingest":
        query = run_ingest(spark, paths, args.landing, args.checkpoint,
                           available_now=args.available_now, interval=args.interval,
                           progress=args.progress, stop_marker=args.stop_marker)
        out = {"batches": len(query.recentProgress)}
    elif args.job == "collect":
        pages = spark.read.option("wholetext", "true").text(args.landing).select(
            F.col("value").alias("body"), F.col("_metadata.file_modification_time").alias("fetched_at"))
        out = run_collection_cycle(spark, pages, args.out)
    elif args.job == "load":
        rows = read_ndjson(spark, args.out)
        out = {"batch_id": ingest_bronze_batch(spark, paths, rows, batch_id=-args.batch)}
    elif args.job == "silver":
        out = run_silver(spark, paths, args.execution_date)
    elif args.job == "gold":
        out = run_gold(spark, paths, args.execution_date, fact_input=args.fact_input)
    elif args.job == "day":
        out = run_day(spark, paths, args.execution_date, fact_input=args.fact_input, retention_days=args.retention_days,
                      fold_before=args.fold_before)
        if "orphan_candidates" in out:
            out["orphan_candidates"] = _candidates(out["orphan_candidates"], args.candidates)
    elif args.job == "compaction":
        out = [r.__dict__ for r in run_compaction(spark, paths)]
    elif args.delete:
        done = delete_orphans(spark, paths, read_candidates(spark, args.candidates), args.delete,
                              retention_days=args.retention_days)
        out = {r["status"]: r["count"] for r in done.groupBy("status").count().collect()}
    else:
        results, found = run_vacuum(spark, paths, retention_days=args.retention_days)
        out = {"tables": [r.__dict__ for r in results], "candidates": _candidates(found, args.candidates)}
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
