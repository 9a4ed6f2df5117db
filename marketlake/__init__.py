"""marketlake: a Spark-native medallion pipeline for market snapshots.

Raw asset snapshots land as JSON (Bronze), are typed and deduplicated to one row
per asset-hour (Silver) and aggregated into an hourly fact table and a daily
asset dimension (Gold). Serving queries and table maintenance run on the same
tables. Every operator is a DataFrame -> DataFrame function; only the jobs in
``marketlake.plans`` and the writers in ``marketlake.sinks`` touch storage.
"""

from marketlake.session import configure, scratch_dir

__all__ = ["configure", "scratch_dir"]
