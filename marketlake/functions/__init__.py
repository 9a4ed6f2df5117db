"""Column expressions (all JVM-side built-ins; no Python UDFs)."""

from marketlake.functions.columns import (
    enforce_types,
    fill_nulls,
    ingestion_metadata,
    is_sunday,
    processed_at,
    relative_volatility,
    retention_cutoff,
    spread,
)

__all__ = [
    "enforce_types",
    "fill_nulls",
    "ingestion_metadata",
    "is_sunday",
    "processed_at",
    "relative_volatility",
    "retention_cutoff",
    "spread",
]
