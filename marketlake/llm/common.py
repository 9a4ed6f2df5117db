"""Helpers shared by the training-data operators.

Lineage is cut by writing a table under the session's shared checkpoint folder
(``spark.checkpoint.dir``) and reading it back, so a lost executor costs only
the tasks that were running, never an earlier stage. Nothing is written to a
machine-local folder on a cluster.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import scratch_dir

# Fixed value: the characters that count as white space in the contracts.
SPACES = " \t\n\x0b\x0c\r"


def ship_by_value(module: str) -> None:
    """Send this module's functions to the executors whole, so that a worker needs
    no copy of the package on its path."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Also used for the result of an aggregate before it is joined on its own key:
    with an exchange directly under both sides of the join, AQE can split a key
    that holds a large share of the rows."""
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete the tables that ``stored`` wrote for these frames. Only for tables
    that no later result reads."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def _marks(df: DataFrame, keys: DataFrame, key: str, bits: int, how: str) -> tuple[DataFrame, Column]:
    """``df`` with the bitmap of its rows' slots, and the row's bit in it."""
    slot = F.pmod(F.xxhash64(F.col(key)), F.lit(bits))
    marked = keys.select(slot.alias("_x_slot")).groupBy(F.bitmap_bucket_number("_x_slot").alias("_x_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_x_slot")).alias("_x_bits"))
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substr("_x_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    rows = df.withColumn("_x_bucket", F.bitmap_bucket_number(slot)).join(F.broadcast(marked), "_x_bucket", how)
    return rows, F.getbit(byte, (at % 8).cast("int"))


def possible(df: DataFrame, keys: DataFrame, key: str, bits: int = 1 << 26) -> DataFrame:
    """``df`` without most of the rows whose ``key`` is not in ``keys``, so that a
    join which follows moves less. The keys are marked in a bitmap of a fixed number
    of ``bits`` (8 MB), which is sent to all tasks; with very many keys it fills up and
    lets more rows pass, but never holds back a row that has a partner.

    The join that follows must not be a semi-join or anti-join: the optimizer moves those
    below the bitmap, and then all rows of ``df`` are moved."""
    rows, bit = _marks(df, keys, key, bits, "inner")
    return rows.where(bit == 1).select(*df.columns)


def absent(df: DataFrame, keys: DataFrame, key: str, bits: int = 1 << 26) -> DataFrame:
    """The rows of ``df`` that ``possible`` leaves out: their ``key`` is surely not in
    ``keys``. They are found where they lie."""
    rows, bit = _marks(df, keys, key, bits, "left")
    return rows.where(F.coalesce(bit, F.lit(0)) == 0).select(*df.columns)


#: Parts that the rows of one key are dealt to when they are joined with its one row.
PARTS = 32


def part_of(*cols: str) -> Column:
    """The part of a row, from columns that differ between rows of one key."""
    return F.pmod(F.xxhash64(*cols), F.lit(PARTS)).cast("int")


def parts_held() -> Column:
    """Aggregate: the parts ``_x_part`` that hold rows of a key, as bits ``_x_parts``."""
    return F.bit_or(F.expr("shiftleft(1L, _x_part)")).alias("_x_parts")


def by_part(groups: DataFrame) -> DataFrame:
    """``groups`` (a row per key) once for every part in ``_x_parts``: never more often
    than the key has rows. Joined on the key and ``_x_part``, a key that holds a large
    share of all rows is the work of ``PARTS`` tasks."""
    return groups.withColumn("_x_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))).where(
        F.expr("getbit(_x_parts, _x_part) = 1")).drop("_x_parts")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def without_spaces(col: Column) -> Column:
    """The text without its white space; null counts as empty."""
    return F.translate(F.coalesce(col, F.lit("")), SPACES, "")
