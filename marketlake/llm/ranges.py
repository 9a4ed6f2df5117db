"""Rows in one total order, cut into range shards of a bounded number of rows."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import stored

#: Bits of ``at`` that number the rows inside a shard (what Spark's ids use).
SHARD_BITS = 33


def range_shards(df: DataFrame, keys: list[str], name: str, shard_rows: int) -> tuple[DataFrame, int]:
    """``df`` written in the order of ``keys`` (nulls first), with the column ``at``: a
    long that grows along that order and whose upper bits are the row's shard. Also
    the number of shards, which grows with the rows: about ``shard_rows`` in each.

    Rows with equal keys are put in some order that stays the same once written, and
    may be cut between shards, so neither a hot key nor equal rows fill one task."""
    shards = max(1, ceil(df.count() / shard_rows))
    ordered = (
        df.withColumn("_x_salt", F.monotonically_increasing_id())
        .repartitionByRange(shards, *keys, "_x_salt").sortWithinPartitions(*keys, "_x_salt")
        .withColumn("at", F.monotonically_increasing_id()).drop("_x_salt")
    )
    return stored(df.sparkSession, ordered, name), shards


def shard_of(at: str = "at") -> Column:
    return F.shiftrightunsigned(F.col(at), SHARD_BITS).cast("int")


def numbered(ordered: DataFrame, key: str, name: str) -> DataFrame:
    """``ordered`` (of ``range_shards``, sorted by ``key`` first) with ``i``: the row's
    place among those of its ``key``, from 0. Rows are numbered shard by shard, and only
    the counts of the shards of a key that was cut are summed along it."""
    ordered = ordered.withColumn("_x_shard", shard_of())
    along = Window.partitionBy(key).orderBy("_x_shard").rowsBetween(Window.unboundedPreceding, -1)
    # Only a shard's first key can have begun in an earlier one.
    begun = stored(ordered.sparkSession, (
        ordered.groupBy(key, "_x_shard").agg(F.count(F.lit(1)).alias("c"))
        .withColumn("_x_before", F.sum("c").over(along)).where(F.col("_x_before").isNotNull())
        .select(key, "_x_shard", "_x_before")
    ), name)
    inside = Window.partitionBy(key, "_x_shard").orderBy("at")
    return (
        ordered.withColumn("i", F.row_number().over(inside) - 1).join(begun, [key, "_x_shard"], "left")
        .withColumn("i", F.col("i") + F.coalesce("_x_before", F.lit(0))).drop("_x_shard", "_x_before")
    )
