"""Adapter from the shared ``events`` table to market snapshots ("ticks").

Each event becomes one asset snapshot: 60 assets (``user_id % 60``), three
assets per symbol (so symbol is not a key), some ranks null and some tied.
The same mapping is written in SQL for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, TimestampType

N_ASSETS = 60
N_SYMBOLS = 20


def ticks_from_events(
    events: DataFrame, with_partitions: bool = True, keep: list[str] | None = None
) -> DataFrame:
    """Typed snapshots: payload fields + ``ingestion_ts`` (+ ``dt``, ``hour``);
    ``keep`` carries source columns (e.g. ``event_id``) through unchanged."""
    asset = F.col("user_id") % N_ASSETS
    value = F.col("value")
    cols = [
        F.concat(F.lit("c"), asset.cast("string")).alias("id"),
        F.concat(F.lit("s"), (asset % N_SYMBOLS).cast("string")).alias("symbol"),
        F.concat(F.lit("Asset "), asset.cast("string")).alias("name"),
        value.alias("current_price"),
        (value * F.lit(1000.0)).alias("market_cap"),
        ((F.col("event_id") % 997).cast(DoubleType()) * F.lit(10.0)).alias("total_volume"),
        (value - F.lit(50.0)).alias("price_change_24h"),
        ((value - F.lit(50.0)) / F.lit(50.0) * F.lit(100.0)).alias("price_change_percentage_24h"),
        F.when(asset % 17 == 0, F.lit(None).cast(IntegerType()))
        .otherwise(F.floor(asset / 2).cast(IntegerType()) + 1)
        .alias("market_cap_rank"),
        (value * F.lit(1.1)).alias("high_24h"),
        (value * F.lit(0.9)).alias("low_24h"),
        F.col("ts").cast(TimestampType()).alias("ingestion_ts"),
    ]
    ticks = events.select(*(keep or []), *cols)
    if with_partitions:
        ticks = ticks.withColumns({
            "dt": F.to_date("ingestion_ts"),
            "hour": F.hour("ingestion_ts").cast(IntegerType()),
        })
    return ticks


def read_ticks(
    spark: SparkSession, sf_dir: str, with_partitions: bool = True, keep: list[str] | None = None
) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return ticks_from_events(events, with_partitions, keep)
