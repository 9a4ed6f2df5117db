"""DataFrame -> DataFrame operators of the Silver, Gold, serving and
maintenance layers."""

from marketlake.operators.latest import latest_per_key
from marketlake.operators.silver import silver_from_bronze
from marketlake.operators.gold import daily_dimension, hourly_fact
from marketlake.operators import serving, maintenance
from marketlake.operators.gold_views import Gold

__all__ = [
    "latest_per_key",
    "silver_from_bronze",
    "daily_dimension",
    "hourly_fact",
    "Gold",
    "serving",
    "maintenance",
]
