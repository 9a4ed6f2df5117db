"""Silver: typed, deduplicated snapshots (one row per asset and hour)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from marketlake.functions.columns import enforce_types
from marketlake.operators.latest import latest_per_key
from marketlake.schema import BATCH_ID, PAYLOAD_FIELDS, PROCESSED_AT

SILVER_KEYS = ["id", "dt", "hour"]
SILVER_COLUMNS = PAYLOAD_FIELDS + ["ingestion_ts", PROCESSED_AT, "dt", "hour"]


def silver_from_bronze(bronze: DataFrame, clock: Column | None = None) -> DataFrame:
    """Type the raw rows and keep the latest snapshot per (id, dt, hour).

    Ties on ``ingestion_ts`` are broken on the payload columns (not on the
    processing time or batch id), so the same input always gives the same row.
    """
    typed = enforce_types(bronze.drop(BATCH_ID) if BATCH_ID in bronze.columns else bronze, clock)
    tie = [c for c in PAYLOAD_FIELDS if c not in SILVER_KEYS]
    return latest_per_key(typed, SILVER_KEYS, "ingestion_ts", tie).select(*SILVER_COLUMNS)
