"""Composite jobs: Silver, Gold, the daily sequence, maintenance, collection."""

from marketlake.plans.jobs import (
    LayerPaths,
    MaintenanceResult,
    open_gold,
    run_collection_cycle,
    run_compaction,
    run_day,
    run_gold,
    run_ingest,
    run_silver,
    run_vacuum,
)

__all__ = [
    "LayerPaths",
    "MaintenanceResult",
    "run_collection_cycle",
    "run_compaction",
    "run_day",
    "run_gold",
    "run_ingest",
    "open_gold",
    "run_silver",
    "run_vacuum",
]
