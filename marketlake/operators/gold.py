"""Gold star schema: hourly fact and daily asset dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.columns import processed_at, relative_volatility, spread
from marketlake.operators.latest import latest_per_key
from marketlake.schema import DIMENSION_COLUMNS, FACT_KEYS, PAYLOAD_FIELDS, PROCESSED_AT
from marketlake.sources.bronze import filter_dates


def fact_aggregates() -> list[Column]:
    """The aggregates of one asset-hour."""
    price = F.col("current_price")
    return [
        F.count(F.lit(1)).alias("total_registros"),
        F.avg(price).alias("preco_medio"),
        F.min(price).alias("preco_min"),
        F.max(price).alias("preco_max"),
        F.stddev_samp(price).alias("preco_desvio"),
        F.avg("market_cap").alias("market_cap_medio"),
        F.avg("total_volume").alias("volume_medio"),
        F.avg("price_change_24h").alias("variacao_24h_media"),
        F.avg("price_change_percentage_24h").alias("variacao_pct_24h_media"),
        F.max("high_24h").alias("high_24h"),
        F.min("low_24h").alias("low_24h"),
    ]


def derived_measures(aggregated: DataFrame, clock: Column | None = None) -> DataFrame:
    """Spread, relative volatility and processing time of aggregated asset-hours."""
    return (
        aggregated.withColumn("spread_24h", spread("high_24h", "low_24h"))
        .withColumn("volatilidade_relativa", relative_volatility("preco_desvio", "preco_medio"))
        .withColumn(PROCESSED_AT, processed_at(clock))
    )


def hourly_fact(df: DataFrame, clock: Column | None = None) -> DataFrame:
    """Per (id, symbol, name, dt, hour): count, price mean/min/max/sample stddev,
    means of cap, volume and both 24 h changes, 24 h extremes, spread and
    relative volatility. One hash aggregate with map-side partial aggregation,
    so a hot asset-hour is combined before the shuffle.

    Takes any grain: over deduplicated Silver every group has one row (stddev
    null); over raw ticks the statistics are meaningful."""
    return derived_measures(df.groupBy(*FACT_KEYS).agg(*fact_aggregates()), clock)


def daily_dimension(
    silver: DataFrame,
    dates: str | list[str] | None = None,
    clock: Column | None = None,
) -> DataFrame:
    """Last snapshot of each asset per day (``dt``), 12 columns + processing
    time. ``dates`` limits the build to those days (a daily run); ``None``
    builds every day in the input."""
    day = filter_dates(silver, dates)
    tie = [c for c in PAYLOAD_FIELDS if c != "id"]
    return (
        latest_per_key(day, ["id", "dt"], "ingestion_ts", tie)
        .select(*DIMENSION_COLUMNS)
        .withColumn(PROCESSED_AT, processed_at(clock))
    )
