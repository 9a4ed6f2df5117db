"""Sharding by jump consistent hashing.

The shard of a row is a function of its stable key and the number of shards
alone: no ring table, no shuffle, and when a shard is appended a row either
stays where it is or moves to the new shard (about 1 in n+1 rows moves).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from marketlake.llm.common import ship_by_value

ship_by_value(__name__)

# Fixed values of the published algorithm: its linear congruential step.
_STEP = np.uint64(2862933555777941757)
_ONE = np.uint64(1)
_TOP = np.uint64(33)
_SPAN = float(1 << 31)

#: Rows that one slot-numbering group holds on average.
ROWS_PER_GROUP = 100_000


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard (0 .. shards-1) of each unsigned 64-bit key."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64, copy=True)
    shard = np.zeros(len(state), dtype=np.int64)
    active = np.arange(len(state))
    while len(active):  # at most `shards` rounds: each jump goes forward
        state[active] = state[active] * _STEP + _ONE
        jump = ((shard[active] + 1) * (_SPAN / ((state[active] >> _TOP) + _ONE).astype(np.float64))).astype(np.int64)
        inside = jump < shards
        shard[active[inside]] = jump[inside]
        active = active[inside]
    return shard


def key_hash(key: Column) -> Column:
    """60 bits of the key's MD5 digest as a long; a null key hashes as an empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a key of any type that casts to text."""

    @pandas_udf("int")
    def place(hashes: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(hashes.to_numpy(dtype=np.int64), shards).astype(np.int32))

    return place(key_hash(key))


def with_shard(df: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """``df`` with the shard of ``key``; a map-only step."""
    return df.withColumn(name, shard_of(F.col(key), shards))


def with_slots(rows: DataFrame, shard: str, order: list[str], spread: Column, count: int) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in a repeatable order.

    A shard may be as large as the table over the number of shards, so it is
    never one task's work. Rows are dealt by ``spread``, a long made of ``order``
    columns, into groups of about ``ROWS_PER_GROUP``; a group's first slot is the running total of the
    (small) table of group sizes, and rows are numbered inside their group.
    Rows equal in all ``order`` columns travel as one row and a count, so a key
    that a third of all rows repeat does not fill a group; such rows take
    consecutive slots. ``count`` is the number of rows; only the number of
    groups depends on it.
    """
    groups = max(1, -(-count // ROWS_PER_GROUP))
    packed = (
        rows.groupBy(shard, *order).agg(F.count(F.lit(1)).alias("_x_n"))
        .withColumn("_x_group", F.pmod(spread, F.lit(groups)).cast("int"))
    )
    sizes = packed.groupBy(shard, "_x_group").agg(F.sum("_x_n").alias("_x_size"))
    before = Window.partitionBy(shard).orderBy("_x_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(shard, "_x_group", F.coalesce(F.sum("_x_size").over(before), F.lit(0)).alias("_x_start"))
    inside = Window.partitionBy(shard, "_x_group").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        packed.withColumn("_x_before", F.coalesce(F.sum("_x_n").over(inside), F.lit(0)))
        .join(starts, [shard, "_x_group"])
        .withColumn("_x_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_x_n") - 1)))
        .withColumn("slot", (F.col("_x_start") + F.col("_x_before") + F.col("_x_at")).cast("long"))
        .select(shard, *order, "slot")
    )


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Place every document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law ``key``: doc_id and the number of shards decide the shard; grown_shard
    is the shard with one shard more and differs only by being the new one.
    ``size`` is the UTF-8 length of the text (null: none) plus 1, ``text_crc32``
    the unsigned CRC-32 of its UTF-8 bytes (null counts as empty). Documents
    with a null doc_id share one shard. Repeated rows take one slot each.
    Other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    numbered = with_slots(
        with_shard(rows, "doc_id", shards), "shard", ["doc_id", "text_crc32", "size"],
        key_hash(F.col("doc_id")) + F.col("text_crc32"), docs.count())
    return with_shard(numbered, "doc_id", shards + 1, "grown_shard").select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
