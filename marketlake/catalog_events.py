"""Registered queries on event time, state, the star schema, rules and alerts.

Streams read the ticks of the ``events`` table as they land: in waves, each drained by
a run of its own on one checkpoint, so every query also restarts its stream. A wave is
a range of days; where rows come late, every 50th event is held back to the last wave.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.alerts import alert_runs
from marketlake.operators.fact_state import fact_of_partials, merge_facts, partial_facts
from marketlake.operators.gold import daily_dimension, hourly_fact
from marketlake.operators.quality import rule_counts
from marketlake.operators.silver import silver_from_bronze
from marketlake.operators.star import daily_profile, star
from marketlake.plans.cleanup import delete_orphans, store_candidates
from marketlake.plans.jobs import LayerPaths, run_vacuum
from marketlake.schema import DIMENSION_SCHEMA, FACT_SCHEMA, PROCESSED_AT, SILVER_SCHEMA
from marketlake.session import configure, file_system, scratch_dir
from marketlake.sinks.writers import publish
from marketlake.sources.stream import landing_stream
from marketlake.sources.tables import read_table
from marketlake.sources.ticks import read_ticks
from marketlake.streaming.event_time import read_closed, start_watermarked_fact, start_watermarked_silver
from marketlake.streaming.incremental_fact import FactPaths, read_batches, start_incremental_fact
from marketlake.streaming.price_alerts import read_alerts, runs_of_alerts, start_alert_stream
from marketlake.streaming.progress import batch_totals, read_progress, run_until_stopped

# Parameters: the first days of the later waves, every which event comes late, the
# large move, and the ranks of the star's drill-down.
SECOND_WAVE, THIRD_WAVE = "2024-01-11", "2024-01-21"
LATE_EVERY = 50
ALERT_PERCENT = 50.0
STAR_RANKS, STAR_PRICE = 3, 90.0
TOUCHED_DAY = "2024-01-15"

_FACT = [c for c in FACT_SCHEMA.fieldNames() if c != PROCESSED_AT]


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _waves(late: bool) -> list[Column]:
    day = F.to_date("ingestion_ts")
    second, third = F.to_date(F.lit(SECOND_WAVE)), F.to_date(F.lit(THIRD_WAVE))
    held = (F.col("event_id") % LATE_EVERY == 0) if late else F.lit(False)
    return [(day < second) & ~held, (day >= second) & (day < third) & ~held, (day >= third) | held]


def _drained(spark: SparkSession, sf_dir: str, start: Callable[[DataFrame], object], late: bool = False) -> None:
    """Land the ticks wave by wave; ``start(stream)`` runs the query until it is drained."""
    configure(spark)
    landing = scratch_dir(spark, "landing-waves")
    ticks = read_ticks(spark, sf_dir, with_partitions=False, keep=["event_id"])
    schema = ticks.drop("event_id").schema
    for wave in _waves(late):
        ticks.where(wave).drop("event_id").write.mode("append").parquet(landing)
        query = start(landing_stream(spark, landing, schema))
        if query is not None:
            query.awaitTermination()


def q_stream_hourly_fact(spark, sf_dir):
    path, checkpoint = scratch_dir(spark, "stream-fact"), scratch_dir(spark, "stream-fact-ckpt")
    _drained(spark, sf_dir, lambda s: start_watermarked_fact(s, path, checkpoint, available_now=True))
    return _rounded(read_closed(spark, path, FACT_SCHEMA).select(_FACT))


def q_stream_silver_dedup(spark, sf_dir):
    path, checkpoint = scratch_dir(spark, "stream-silver"), scratch_dir(spark, "stream-silver-ckpt")
    _drained(spark, sf_dir, lambda s: start_watermarked_silver(s, path, checkpoint, available_now=True))
    return read_closed(spark, path, SILVER_SCHEMA).drop(PROCESSED_AT)


def _incremental(spark, sf_dir) -> FactPaths:
    paths, checkpoint = FactPaths(scratch_dir(spark, "increments")), scratch_dir(spark, "increments-ckpt")
    _drained(spark, sf_dir, lambda s: start_incremental_fact(s, paths.root, checkpoint, available_now=True), late=True)
    return paths


def q_stream_late_rows(spark, sf_dir):
    paths = _incremental(spark, sf_dir)
    return read_batches(spark, paths).select("batch_id", "rows", "on_time", "late", "untimed")


def q_stream_incremental_fact(spark, sf_dir):
    paths = _incremental(spark, sf_dir)
    return _rounded(read_table(spark, paths.fact, FACT_SCHEMA).select(_FACT))


def q_fact_state_merge(spark, sf_dir):
    """The fact from the partials of 32 batches of interleaved events."""
    configure(spark)
    ticks = read_ticks(spark, sf_dir, keep=["event_id"]).withColumn("batch", F.pmod(F.xxhash64("event_id"), F.lit(32)))
    partials = partial_facts(ticks, ["id", "symbol", "name", "dt", "hour", "batch"])
    return _rounded(fact_of_partials(merge_facts(partials)).select(_FACT))


def q_alert_runs(spark, sf_dir):
    configure(spark)
    return _rounded(alert_runs(read_ticks(spark, sf_dir), ALERT_PERCENT))


def _alerts(spark, sf_dir) -> tuple[str, str]:
    path, checkpoint, progress = (scratch_dir(spark, f"alerts{x}") for x in ("", "-ckpt", "-progress"))
    _drained(spark, sf_dir, lambda s: run_until_stopped(
        spark, lambda: start_alert_stream(s, path, checkpoint, ALERT_PERCENT, available_now=True), progress))
    return path, progress


def q_stream_alert_runs(spark, sf_dir):
    path, _ = _alerts(spark, sf_dir)
    return _rounded(runs_of_alerts(read_alerts(spark, path)))


def q_stream_progress(spark, sf_dir):
    """What the alert stream's progress table tells of each micro-batch."""
    _, progress = _alerts(spark, sf_dir)
    return batch_totals(read_progress(spark, progress))


def q_quality_rules(spark, sf_dir):
    """Ticks with planted faults: no measures, no price, negative and swapped values."""
    configure(spark)
    t = read_ticks(spark, sf_dir, keep=["event_id"])
    e = F.col("event_id")
    nothing = F.lit(None).cast("double")
    faulty = t.withColumns({
        "current_price": F.when(e % 7 == 0, nothing).when(e % 13 == 0, -F.col("current_price")).otherwise(F.col("current_price")),
        "market_cap": F.when(e % 11 == 0, nothing).otherwise(F.col("market_cap")),
        "high_24h": F.when(e % 17 == 0, F.col("low_24h")).otherwise(F.col("high_24h")),
        "low_24h": F.when(e % 17 == 0, F.col("high_24h")).otherwise(F.col("low_24h")),
    })
    return _rounded(rule_counts(faulty))


def _gold_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Fact at tick grain and dimension, published and read back."""
    configure(spark)
    paths = LayerPaths(scratch_dir(spark, "star"))
    ticks = read_ticks(spark, sf_dir)
    publish(hourly_fact(ticks).select(*FACT_SCHEMA.fieldNames()), paths.fact)
    publish(daily_dimension(silver_from_bronze(ticks)).select(*DIMENSION_SCHEMA.fieldNames()), paths.dimension)
    return read_table(spark, paths.fact, FACT_SCHEMA), read_table(spark, paths.dimension, DIMENSION_SCHEMA)


def q_star_join(spark, sf_dir):
    fact, dimension = _gold_tables(spark, sf_dir)
    return _rounded(daily_profile(star(fact, dimension)))


def q_star_top_assets(spark, sf_dir):
    """Hours of the best ranked assets on the days on which they closed high."""
    fact, dimension = _gold_tables(spark, sf_dir)
    chosen = (F.col("market_cap_rank") <= STAR_RANKS) & (F.col("current_price") >= STAR_PRICE)
    out = star(fact, dimension, where=chosen)
    return _rounded(out.select("id", "dt", "hour", "market_cap_rank", "close_price", "preco_medio", "preco_max"))


def q_maint_delete_orphans(spark, sf_dir):
    """Stray files, one folder a day, are listed past their retention. Those of one day
    are written to again; the deleting step keeps them and deletes the others."""
    configure(spark)
    paths = LayerPaths(scratch_dir(spark, "cleanup"))
    ticks = read_ticks(spark, sf_dir)
    publish(hourly_fact(ticks).select(*FACT_SCHEMA.fieldNames()), paths.fact)
    ticks.select("id", "dt").repartition("dt").write.partitionBy("dt").parquet(f"{paths.root}/stray")
    later = _dt.datetime.now(_dt.timezone.utc) + _dt.timedelta(days=30)
    _, found = run_vacuum(spark, paths, now=later)
    candidates = store_candidates(found, scratch_dir(spark, "cleanup-list"))
    fs, folder = file_system(spark, f"{paths.root}/stray/dt={TOUCHED_DAY}")
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        fs.setTimes(status.getPath(), status.getModificationTime() + 5_000, -1)
    done = delete_orphans(spark, paths, candidates, scratch_dir(spark, "cleanup-done"), now=later)
    day = F.to_date(F.regexp_extract("file_path", r"/dt=([^/]*)/", 1))
    return done.groupBy(day.alias("dt"), "status").agg(F.count(F.lit(1)).alias("files"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_hourly_fact": q_stream_hourly_fact,
    "stream_late_rows": q_stream_late_rows,
    "stream_incremental_fact": q_stream_incremental_fact,
    "fact_state_merge": q_fact_state_merge,
    "stream_silver_dedup": q_stream_silver_dedup,
    "star_join": q_star_join,
    "star_top_assets": q_star_top_assets,
    "quality_rules": q_quality_rules,
    "alert_runs": q_alert_runs,
    "stream_alert_runs": q_stream_alert_runs,
    "maint_delete_orphans": q_maint_delete_orphans,
    "stream_progress": q_stream_progress,
}
