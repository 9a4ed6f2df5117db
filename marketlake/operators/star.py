"""Joins of the star schema: hourly fact with the daily dimension.

The key is (id, dt). Nothing forces a join strategy: the planner broadcasts a
dimension whose size it knows to be small and otherwise sorts both sides, and AQE
splits a day that holds most of the rows. With a broadcast dimension that is filtered,
its days prune the partitions of the fact before they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.schema import FACT_KEYS

#: Dimension columns that the fact does not have, and their names in the star.
DIMENSION_ATTRIBUTES = {
    "market_cap_rank": "market_cap_rank",
    "current_price": "close_price",
    "market_cap": "close_market_cap",
    "total_volume": "close_volume",
}


def star(fact: DataFrame, dimension: DataFrame, keep_unmatched: bool = True, where: Column | None = None) -> DataFrame:
    """Every fact row with the attributes of its asset on its day.

    ``keep_unmatched`` keeps fact rows whose asset has no dimension row that day
    (attributes null). ``where`` filters the dimension; it implies matched rows only,
    so that the days it leaves prune the fact's partitions. A null id or dt joins with
    nothing."""
    chosen = dimension if where is None else dimension.where(where)
    chosen = chosen.select("id", "dt", *[F.col(c).alias(n) for c, n in DIMENSION_ATTRIBUTES.items()])
    return fact.join(chosen, ["id", "dt"], "left" if keep_unmatched and where is None else "inner")


def daily_profile(starred: DataFrame) -> DataFrame:
    """One row per asset and day of a star: the hours, snapshots and price range of the
    day, the weighted mean price, and how far the close is from it (percent)."""
    priced = F.col("preco_medio").isNotNull()
    weight = F.when(priced, F.col("total_registros"))
    return (
        starred.groupBy(*[k for k in FACT_KEYS if k != "hour"], *DIMENSION_ATTRIBUTES.values())
        .agg(F.count(F.lit(1)).alias("hours"), F.sum("total_registros").alias("snapshots"),
             F.min("preco_min").alias("low"), F.max("preco_max").alias("high"),
             F.try_divide(F.sum(F.col("preco_medio") * weight), F.sum(weight).cast("double")).alias("mean_price"))
        .withColumn("close_vs_mean_pct", F.try_divide(F.col("close_price") - F.col("mean_price"), F.col("mean_price")) * 100.0)
    )
