"""Record shapes of every layer, as explicit schemas.

Schemas are always passed to readers: JSON inference drops all-null columns and
guesses partition types, which would change results between runs.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- Fixed values: field, column and table names of the data model. -------------
# They must stay exactly as below so that tables and queries written for the
# original pipeline keep resolving.
PAYLOAD_FIELDS = [
    "id", "symbol", "name", "current_price", "market_cap", "total_volume",
    "price_change_24h", "price_change_percentage_24h", "market_cap_rank",
    "high_24h", "low_24h",
]
MEASURES = [
    "current_price", "market_cap", "total_volume", "price_change_24h",
    "price_change_percentage_24h", "high_24h", "low_24h",
]
FACT_KEYS = ["id", "symbol", "name", "dt", "hour"]
FACT_MEASURES = [
    "total_registros", "preco_medio", "preco_min", "preco_max", "preco_desvio",
    "market_cap_medio", "volume_medio", "variacao_24h_media",
    "variacao_pct_24h_media", "high_24h", "low_24h", "spread_24h",
    "volatilidade_relativa",
]
DIMENSION_COLUMNS = [
    "id", "symbol", "name", "market_cap_rank", "current_price", "market_cap",
    "total_volume", "high_24h", "low_24h", "price_change_24h",
    "price_change_percentage_24h", "dt",
]
PAYLOAD_SCHEMA = StructType([
    StructField("id", StringType()),
    StructField("symbol", StringType()),
    StructField("name", StringType()),
    StructField("current_price", DoubleType()),
    StructField("market_cap", DoubleType()),
    StructField("total_volume", DoubleType()),
    StructField("price_change_24h", DoubleType()),
    StructField("price_change_percentage_24h", DoubleType()),
    StructField("market_cap_rank", IntegerType()),
    StructField("high_24h", DoubleType()),
    StructField("low_24h", DoubleType()),
])
BRONZE_TABLE = "coins_markets"
SILVER_TABLE = "coins_markets_silver"
FACT_TABLE = "fct_metricas_hora"
DIMENSION_TABLE = "dim_moedas"
# Collector defaults: records per page, trigger interval,
# snapshot retention, dashboard top-N (slider 10..100, default 20) and the
# number of bars in the spread chart.
PAGE_SIZE = 250
TRIGGER_INTERVAL = "30 seconds"
RETENTION_DAYS = 7
TOP_N_DEFAULT = 20
TOP_N_RANGE = (10, 100)
SPREAD_TOP = 20
# --------------------------------------------------------------------------------

PROCESSED_AT = "_processed_at"
BATCH_ID = "batch_id"

# Bronze on disk: payload + ingestion time, partitioned by dt / hour / batch_id.
BRONZE_SCHEMA = StructType(
    PAYLOAD_SCHEMA.fields
    + [
        StructField("ingestion_ts", TimestampType()),
        StructField("dt", DateType()),
        StructField("hour", IntegerType()),
        StructField(BATCH_ID, LongType()),
    ]
)

# Silver: typed, one row per (id, dt, hour).
SILVER_SCHEMA = StructType(
    PAYLOAD_SCHEMA.fields
    + [
        StructField("ingestion_ts", TimestampType()),
        StructField(PROCESSED_AT, TimestampType()),
        StructField("dt", DateType()),
        StructField("hour", IntegerType()),
    ]
)

FACT_SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("symbol", StringType()),
        StructField("name", StringType()),
        StructField("hour", IntegerType()),
        StructField("total_registros", LongType()),
    ]
    + [StructField(c, DoubleType()) for c in FACT_MEASURES[1:]]
    + [
        StructField(PROCESSED_AT, TimestampType()),
        StructField("dt", DateType()),
    ]
)

DIMENSION_SCHEMA = StructType(
    [f for f in PAYLOAD_SCHEMA.fields]
    + [
        StructField(PROCESSED_AT, TimestampType()),
        StructField("dt", DateType()),
    ]
)
