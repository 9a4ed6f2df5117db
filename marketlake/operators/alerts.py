"""Alerts on large moves: snapshots whose price differs from the asset's previous one by
a given percentage, and runs of such snapshots.

Order and runs are found inside one asset and day, so the unit of work is a day, not an
asset's history. What crosses midnight is carried by small tables: the last price of
each day, and the runs that touch a day's first or last snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Percent from which a move is large.
LARGE_MOVE = 50.0

_ORDER = ["ingestion_ts", "current_price"]


def move_pct(price: Column, previous: Column) -> Column:
    """Change in percent. Null without a previous price, and if that is not positive."""
    return F.when(previous > 0, (price / previous - 1.0) * 100.0)


def moves(snapshots: DataFrame) -> DataFrame:
    """id, dt, ingestion_ts, current_price, previous_price and pct of every snapshot.

    Snapshots of an asset follow each other by time, then price. Rows without id, time
    or price are left out: they are no observation of a price."""
    seen = snapshots.select("id", "dt", *_ORDER).where(
        F.col("id").isNotNull() & F.col("ingestion_ts").isNotNull() & F.col("current_price").isNotNull())
    # A day's last price is one row per asset and day: a partial aggregate.
    last = seen.groupBy("id", "dt").agg(F.max(F.struct(*_ORDER)).alias("_last"))
    carry = last.select("id", "dt", F.lag("_last.current_price").over(Window.partitionBy("id").orderBy("dt")).alias("_carried"))
    inside = Window.partitionBy("id", "dt").orderBy(*_ORDER)
    return (
        seen.join(carry, ["id", "dt"])
        .withColumn("previous_price", F.coalesce(F.lag("current_price").over(inside), F.col("_carried")))
        .withColumn("pct", move_pct(F.col("current_price"), F.col("previous_price"))).drop("_carried")
    )


def alert_runs(snapshots: DataFrame, threshold: float = LARGE_MOVE) -> DataFrame:
    """Maximal runs of an asset's consecutive snapshots that each move by at least
    ``threshold`` percent: id, started_at, ended_at, length (snapshots), extreme_pct
    (the largest absolute move).

    Runs are first made inside a day, by gaps and islands: the number of quiet snapshots
    before a large one is the same all along a run. Then runs that touch at midnight are
    joined, of which a day has two at most."""
    inside = Window.partitionBy("id", "dt").orderBy(*_ORDER)
    day = Window.partitionBy("id", "dt")
    large = F.coalesce(F.abs("pct") >= threshold, F.lit(False))
    marked = moves(snapshots).withColumn("large", large).withColumns({
        "island": F.sum(F.when(F.col("large"), 0).otherwise(1)).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
        "place": F.row_number().over(inside),
        "places": F.count(F.lit(1)).over(day),
    })
    runs = marked.where("large").groupBy("id", "dt", "island").agg(
        F.min("ingestion_ts").alias("started_at"), F.max("ingestion_ts").alias("ended_at"),
        F.count(F.lit(1)).alias("length"), F.max(F.abs("pct")).alias("extreme_pct"),
        (F.min("place") == 1).alias("opens_day"), (F.max("place") == F.max("places")).alias("closes_day"))
    # The days of an asset are numbered, so that a run knows whether the day after it is
    # the next one that has snapshots.
    numbered = marked.select("id", "dt").distinct().withColumn(
        "day_no", F.row_number().over(Window.partitionBy("id").orderBy("dt")))
    touching = runs.where("opens_day or closes_day").join(numbered, ["id", "dt"])
    along = Window.partitionBy("id").orderBy("day_no", "started_at", "ended_at", "island")
    joined = F.col("opens_day") & F.lag("closes_day").over(along) & (F.lag("day_no").over(along) == F.col("day_no") - 1)
    chains = touching.withColumn("starts", F.when(F.coalesce(joined, F.lit(False)), 0).otherwise(1)).withColumn(
        "chain", F.sum("starts").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    columns = ["id", "started_at", "ended_at", "length", "extreme_pct"]
    return runs.where("not (opens_day or closes_day)").select(columns).unionByName(
        chains.groupBy("id", "chain").agg(
            F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"), F.sum("length").alias("length"),
            F.max("extreme_pct").alias("extreme_pct")).select(columns))
