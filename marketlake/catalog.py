"""Registered queries over the shared test tables, with their SQL oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame built from the
tables under ``sf_dir`` (mostly ``events`` through the snapshot adapter, plus
``orders`` / ``lineitem`` as stand-ins for maintenance metadata). Queries that
exercise writers write to a fresh folder under the session's checkpoint
directory and read the result back.

Comparison hygiene: aggregated doubles are rounded to 6 digits on both sides
and the processing-time column is dropped (it is the wall clock).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from marketlake.functions.columns import fill_nulls, enforce_types
from marketlake.operators import maintenance
from marketlake.operators.gold import daily_dimension, hourly_fact
from marketlake.operators.gold_views import Gold
from marketlake.operators.quality import layer_counts
from marketlake.operators.silver import silver_from_bronze
from marketlake.plans.jobs import LayerPaths, open_gold, run_collection_cycle, run_day, run_vacuum
from marketlake.schema import (
    BRONZE_SCHEMA,
    DIMENSION_SCHEMA,
    FACT_SCHEMA,
    MEASURES,
    PAYLOAD_FIELDS,
    PROCESSED_AT,
    SILVER_SCHEMA,
    BATCH_ID,
)
from marketlake.session import configure, file_system, path_exists, scratch_dir
from marketlake.sinks.writers import append_bronze, compact, land_pages, publish
from marketlake.sources.bronze import pack_pages, page_key_by_sequence, explode_pages, read_bronze
from marketlake.sources.ndjson import read_ndjson
from marketlake.sources.stream import landing_stream, page_stream
from marketlake.sources.tables import read_table
from marketlake.sources.ticks import read_ticks, ticks_from_events
from marketlake.streaming.bronze_ingest import prepare_bronze, start_bronze_stream

# Parameters of the registered queries (an execution date inside the test
# data, maintenance cutoffs inside the stand-in tables' date range, the series
# symbol selected in the dashboard).
EXECUTION_DATE = "2024-01-15"
SERIES_SYMBOL = "s0"
SNAPSHOT_CUTOFF = "2001-07-25"
ORPHAN_CUTOFF = "2001-07-29"
# The widest spreads are taken among more assets than are shown.
SPREAD_AMONG = 40

TICK_COLUMNS = PAYLOAD_FIELDS + ["ingestion_ts", "dt", "hour"]
FACT_OUT = [c for c in FACT_SCHEMA.fieldNames() if c != PROCESSED_AT]


def _round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _ticks(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    configure(spark)
    return read_ticks(spark, sf_dir, **kw)


def _silver(spark, sf_dir):
    return silver_from_bronze(_ticks(spark, sf_dir))


def _with_nulls(spark, sf_dir) -> DataFrame:
    """Ticks with missing measures: all seven for ``event_id % 11 = 0``, the
    price alone for ``event_id % 7 = 0`` (every row is kept)."""
    t = _ticks(spark, sf_dir, with_partitions=False, keep=["event_id"])
    all_null = F.col("event_id") % 11 == 0
    price_null = F.col("event_id") % 7 == 0
    out = {c: F.when(all_null, F.lit(None).cast(DoubleType())).otherwise(F.col(c)) for c in MEASURES}
    out["current_price"] = F.when(all_null | price_null, F.lit(None).cast(DoubleType())).otherwise(
        F.col("current_price"))
    return t.withColumns(out).drop("event_id")


def _as_text(spark, sf_dir) -> DataFrame:
    """Untyped rows as a schema-less JSON read would give them: every field text,
    with ``n/a`` for some measures and ranks (``event_id % 13 = 0``)."""
    t = _ticks(spark, sf_dir, keep=["event_id"])
    bad = F.col("event_id") % 13 == 0
    cols = {c: F.when(bad, F.lit("n/a")).otherwise(F.col(c).cast(StringType())) for c in MEASURES}
    cols["market_cap_rank"] = F.when(bad, F.lit("n/a")).otherwise(F.col("market_cap_rank").cast(StringType()))
    cols["ingestion_ts"] = F.col("ingestion_ts").cast(StringType())
    return t.withColumns(cols).drop("event_id")


# --- Silver / Gold -------------------------------------------------------------

def q_silver_dedup(spark, sf_dir):
    return _silver(spark, sf_dir).drop(PROCESSED_AT)


def q_gold_hourly_fact_silver(spark, sf_dir):
    return _round_doubles(hourly_fact(_silver(spark, sf_dir)).select(*FACT_OUT))


def q_gold_hourly_fact_ticks(spark, sf_dir):
    return _round_doubles(hourly_fact(_ticks(spark, sf_dir)).select(*FACT_OUT))


def q_gold_daily_dimension(spark, sf_dir):
    return daily_dimension(_silver(spark, sf_dir)).drop(PROCESSED_AT)


def q_silver_typing(spark, sf_dir):
    return enforce_types(_as_text(spark, sf_dir)).select(*TICK_COLUMNS)


# --- Serving -------------------------------------------------------------------

# Gold warehouses published by this process, by application, input folder and version.
_PUBLISHED: dict[tuple[str, str, str], LayerPaths] = {}


def _version(spark, path: str) -> str:
    """What tells one state of a table's files from another: names, sizes and times."""
    fs, place = file_system(spark, path)
    files = fs.listStatus(place) if fs.exists(place) else []
    return "|".join(sorted(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}" for f in files))


def _gold(spark, sf_dir) -> Gold:
    """The Gold tables of ``sf_dir``, published once per application and state of the
    input: the dimension from Silver, the fact at tick grain (its hourly statistics are
    non-degenerate)."""
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir, _version(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    paths = _PUBLISHED.get(key)
    if paths is None or not path_exists(spark, paths.dimension):
        paths = LayerPaths(scratch_dir(spark, "gold"))
        publish(daily_dimension(_silver(spark, sf_dir)).select(*DIMENSION_SCHEMA.fieldNames()), paths.dimension)
        publish(hourly_fact(_ticks(spark, sf_dir)).select(*FACT_SCHEMA.fieldNames()), paths.fact)
        _PUBLISHED[key] = paths
    return open_gold(spark, paths)


def q_serve_top_n(spark, sf_dir):
    return _gold(spark, sf_dir).top_n().drop(PROCESSED_AT)


def q_serve_market_cap(spark, sf_dir):
    return _gold(spark, sf_dir).market_cap()


def q_serve_variation(spark, sf_dir):
    return _gold(spark, sf_dir).variation()


def q_serve_top_spread(spark, sf_dir):
    return _round_doubles(_gold(spark, sf_dir).top_spread(SPREAD_AMONG))


def q_serve_kpis(spark, sf_dir):
    return _round_doubles(_gold(spark, sf_dir).kpis())


def q_serve_symbols(spark, sf_dir):
    return _gold(spark, sf_dir).symbols()


def q_serve_hourly_series(spark, sf_dir):
    return _round_doubles(_gold(spark, sf_dir).hourly_series(SERIES_SYMBOL, "price"))


def q_serve_hourly_volume(spark, sf_dir):
    return _round_doubles(_gold(spark, sf_dir).hourly_series(SERIES_SYMBOL, "volume"))


def q_serve_hourly_volatility(spark, sf_dir):
    return _round_doubles(_gold(spark, sf_dir).hourly_series(SERIES_SYMBOL, "volatility"))


def q_serve_default_series(spark, sf_dir):
    return _round_doubles(_gold(spark, sf_dir).default_series("price"))


# --- Bronze --------------------------------------------------------------------

def _pages(spark, sf_dir) -> DataFrame:
    """Ticks packed into API-shaped page bodies of at most 250 objects
    (consecutive events), each object carrying one key the reader must ignore;
    the page's fetch time is its latest snapshot time. Even pages also hold a
    null element and an object without an id, and every page has a failed twin
    (an error object), all of which the reader must skip."""
    t = _ticks(spark, sf_dir, with_partitions=False, keep=["event_id"])
    pages = pack_pages(
        t,
        page_key_by_sequence("event_id"),
        extra_fields={"sparkline": F.lit(None).cast(StringType()), "roi": F.col("event_id")},
        carry={"fetched_at": F.max("ingestion_ts")},
    )
    odd = F.regexp_replace("body", r"^\[", '[null, {"symbol": "no id", "current_price": 1.0}, ')
    error = F.lit('{"status": {"error_code": 429, "error_message": "limit"}}')
    # The twin is made beside its page: a second aggregate of ids alone is so small that
    # it ends in one or two tasks, which then write half of all pages.
    twins = pages.withColumn("failed", F.explode(F.array(F.lit(False), F.lit(True))))
    return twins.withColumns({
        "page_id": F.when(F.col("failed"), -1 - F.col("page_id")).otherwise(F.col("page_id")),
        "body": F.when(F.col("failed"), error).when(F.col("page_id") % 2 == 0, odd).otherwise(F.col("body")),
    }).drop("failed")


def q_bronze_page_explode(spark, sf_dir):
    return explode_pages(_pages(spark, sf_dir))


def q_bronze_null_fill(spark, sf_dir):
    return fill_nulls(_with_nulls(spark, sf_dir), "zero")


def q_bronze_metadata(spark, sf_dir):
    return prepare_bronze(_ticks(spark, sf_dir, with_partitions=False), "zero")


def q_bronze_metadata_keep_nulls(spark, sf_dir):
    return prepare_bronze(_with_nulls(spark, sf_dir), "keep")


def q_bronze_partition_scan(spark, sf_dir):
    base = scratch_dir(spark, "bronze")
    append_bronze(prepare_bronze(_ticks(spark, sf_dir, with_partitions=False)), base)
    return read_bronze(spark, base, EXECUTION_DATE).drop(BATCH_ID)


def q_bronze_stream_ingest(spark, sf_dir):
    configure(spark)
    events_path = f"{sf_dir.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(events_path).schema
    source = landing_stream(spark, sf_dir, schema, "parquet", glob="events.parquet")
    base, ckpt = scratch_dir(spark, "bronze-stream"), scratch_dir(spark, "bronze-stream-ckpt")
    query = start_bronze_stream(ticks_from_events(source, with_partitions=False), base, ckpt, available_now=True)
    query.awaitTermination()
    return read_bronze(spark, base).drop(BATCH_ID)


def q_bronze_page_stream(spark, sf_dir):
    """Page bodies land as one file each and are streamed into Bronze. The time is
    each file's own, so it is not compared."""
    configure(spark)
    landing = scratch_dir(spark, "landed-pages")
    land_pages(_pages(spark, sf_dir), landing)
    base, ckpt = scratch_dir(spark, "bronze-pages"), scratch_dir(spark, "bronze-pages-ckpt")
    query = start_bronze_stream(page_stream(spark, landing), base, ckpt, available_now=True)
    query.awaitTermination()
    return read_bronze(spark, base).select(*PAYLOAD_FIELDS)


def q_landing_ndjson_roundtrip(spark, sf_dir):
    out = scratch_dir(spark, "landing")
    run_collection_cycle(spark, _pages(spark, sf_dir), out)
    return read_ndjson(spark, out)


# --- Publish round trips -------------------------------------------------------

def q_silver_publish_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "silver")
    publish(_silver(spark, sf_dir), path, ("dt",))
    return read_table(spark, path, SILVER_SCHEMA).drop(PROCESSED_AT)


def q_silver_daily_filter(spark, sf_dir):
    path = scratch_dir(spark, "silver")
    publish(_silver(spark, sf_dir), path, ("dt",))
    return read_table(spark, path, SILVER_SCHEMA, EXECUTION_DATE).drop(PROCESSED_AT)


def q_gold_publish_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "fact")
    publish(hourly_fact(_silver(spark, sf_dir)).select(*FACT_SCHEMA.fieldNames()), path, ("dt",))
    return _round_doubles(read_table(spark, path, FACT_SCHEMA).select(*FACT_OUT))


def q_gold_dimension_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "dim")
    publish(daily_dimension(_silver(spark, sf_dir)).select(*DIMENSION_SCHEMA.fieldNames()), path, ("dt",))
    return read_table(spark, path, DIMENSION_SCHEMA).drop(PROCESSED_AT)


def q_daily_job_run(spark, sf_dir):
    """Bronze JSON -> run_day over every day present, Sundays among them (one
    pass per layer, compaction and vacuum included) -> the published fact table,
    with what the vacuum said."""
    paths = LayerPaths(scratch_dir(spark, "warehouse"))
    append_bronze(prepare_bronze(_ticks(spark, sf_dir, with_partitions=False)), paths.bronze)
    report = run_day(spark, paths, None)
    healthy = all(r.status == "ok" for r in report["compaction"] + report["vacuum"])
    fact = read_table(spark, paths.fact, FACT_SCHEMA).select(*FACT_OUT)
    return _round_doubles(fact).withColumns({
        "healthy": F.lit(healthy), "orphans": F.lit(report["orphan_candidates"].count()).cast("long")})


# --- Maintenance ---------------------------------------------------------------

def q_maint_compact(spark, sf_dir):
    """Content of a compacted table, and whether compaction left fewer files."""
    path = scratch_dir(spark, "fragmented")
    fragmented = _ticks(spark, sf_dir).repartition(64)  # many small files per day
    fragmented.write.partitionBy("dt").parquet(path)
    schema = _ticks(spark, sf_dir).schema
    done = compact(spark, path, schema)
    return spark.read.schema(schema).parquet(path).select(*TICK_COLUMNS).withColumn(
        "fewer_files", F.lit(done["files_after"] < done["files"]))


def q_maint_vacuum(spark, sf_dir):
    """The vacuum's candidates, by folder, in a warehouse with a published fact
    table and one stray file per day, all of them past their retention."""
    configure(spark)
    paths = LayerPaths(scratch_dir(spark, "vacuum"))
    publish(hourly_fact(_ticks(spark, sf_dir)).select(*FACT_SCHEMA.fieldNames()), paths.fact)
    _ticks(spark, sf_dir).select("id", "dt").repartition("dt").write.partitionBy("dt").parquet(f"{paths.root}/old export")
    _, found = run_vacuum(spark, paths, now=_dt.datetime.now(_dt.timezone.utc) + _dt.timedelta(days=30))
    return found.groupBy(F.array_join(F.slice(F.split("file_path", "/"), -3, 2), "/").alias("folder")).agg(
        F.count(F.lit(1)).alias("files"))


def _snapshot_log(spark, sf_dir):
    configure(spark)
    orders = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
    return orders.select(
        F.col("o_orderstatus").alias("table_name"),
        F.col("o_orderkey").alias("snapshot_id"),
        F.col("o_orderdate").cast("timestamp").alias("committed_at"),
    )


def q_maint_expired_snapshots(spark, sf_dir):
    return maintenance.expired_snapshots(_snapshot_log(spark, sf_dir), SNAPSHOT_CUTOFF)


def q_maint_orphan_files(spark, sf_dir):
    """Stand-ins: every order is a file in the inventory (modified at its order
    date); the lineitem rows are the table references (duplicates included).
    Orders without any line are the orphans."""
    configure(spark)
    d = sf_dir.rstrip("/")
    inventory = spark.read.parquet(f"{d}/orders.parquet").select(
        F.col("o_orderkey").alias("file_path"), F.col("o_orderdate").cast("timestamp").alias("modified_at"))
    referenced = spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").alias("file_path"))
    return maintenance.orphan_files(inventory, referenced, ORPHAN_CUTOFF)


def q_maint_vacuum_days(spark, sf_dir):
    return maintenance.vacuum_days(_ticks(spark, sf_dir))


def q_maint_file_stats(spark, sf_dir):
    path = scratch_dir(spark, "filestats")
    t = _ticks(spark, sf_dir)
    publish(t, path, ("dt",))
    stats = maintenance.file_stats(spark.read.schema(t.schema).parquet(path), ["dt"], small_file_bytes=128 * 1024 * 1024)
    sound = (
        (F.col("files") >= 1) & (F.col("small_files") <= F.col("files")) & (F.col("min_file_bytes") <= F.col("max_file_bytes"))
        & (F.col("bytes") >= F.col("files") * F.col("min_file_bytes")) & (F.col("bytes") <= F.col("files") * F.col("max_file_bytes")))
    return stats.select("dt", "rows", sound.alias("sound"))


def q_quality_row_counts(spark, sf_dir):
    return layer_counts(_ticks(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "silver_dedup": q_silver_dedup,
    "gold_hourly_fact_silver": q_gold_hourly_fact_silver,
    "gold_hourly_fact_ticks": q_gold_hourly_fact_ticks,
    "gold_daily_dimension": q_gold_daily_dimension,
    "silver_typing": q_silver_typing,
    "serve_top_n": q_serve_top_n,
    "serve_market_cap": q_serve_market_cap,
    "serve_variation": q_serve_variation,
    "serve_top_spread": q_serve_top_spread,
    "serve_kpis": q_serve_kpis,
    "serve_symbols": q_serve_symbols,
    "serve_hourly_series": q_serve_hourly_series,
    "serve_hourly_volume": q_serve_hourly_volume,
    "serve_hourly_volatility": q_serve_hourly_volatility,
    "serve_default_series": q_serve_default_series,
    "bronze_page_explode": q_bronze_page_explode,
    "bronze_null_fill": q_bronze_null_fill,
    "bronze_metadata": q_bronze_metadata,
    "bronze_metadata_keep_nulls": q_bronze_metadata_keep_nulls,
    "bronze_partition_scan": q_bronze_partition_scan,
    "bronze_stream_ingest": q_bronze_stream_ingest,
    "bronze_page_stream": q_bronze_page_stream,
    "landing_ndjson_roundtrip": q_landing_ndjson_roundtrip,
    "silver_publish_roundtrip": q_silver_publish_roundtrip,
    "silver_daily_filter": q_silver_daily_filter,
    "gold_publish_roundtrip": q_gold_publish_roundtrip,
    "gold_dimension_roundtrip": q_gold_dimension_roundtrip,
    "daily_job_run": q_daily_job_run,
    "maint_compact": q_maint_compact,
    "maint_vacuum": q_maint_vacuum,
    "maint_expired_snapshots": q_maint_expired_snapshots,
    "maint_orphan_files": q_maint_orphan_files,
    "maint_vacuum_days": q_maint_vacuum_days,
    "maint_file_stats": q_maint_file_stats,
    "quality_row_counts": q_quality_row_counts,
}
