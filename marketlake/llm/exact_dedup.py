"""Exact dedup by progressive refinement.

Three rounds, each narrower than the one before: rows are grouped by the length
of the normalised text, then by (length, hash of a prefix), and only rows whose
group still has company are grouped by the full hash; all others are unique. Every
text is read once, where it lies, and only lengths and hashes are moved. Group
sizes are counts with a map-side partial aggregate, so a group that holds a third
of all rows costs one row per task. Its fate is brought back to its rows in
parts (``common.by_part``): rows are dealt to parts by their place, and a group's row is
repeated for the parts that hold members only, never more often than it has members.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import by_part, part_of, parts_held, stored, without_spaces

#: Characters of the normalised text that the second round hashes.
PREFIX_CHARS = 256


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, code points of the text, and what the rounds compare: length, prefix hash
    and full hash of the normalised text; further a number that tells equal rows apart
    once it is stored, and the part the row is dealt to. The text itself is not carried
    on, so no round moves more than these few bytes a row."""
    normal = without_spaces(F.col("text"))
    return docs.select(
        "doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("_x_chars"), F.length(normal).alias("_x_len"),
        F.xxhash64(F.substring(normal, 1, PREFIX_CHARS)).alias("_x_prefix"), F.sha2(normal, 256).alias("text_sha256"),
        F.monotonically_increasing_id().alias("_x_row"),
    ).withColumn("_x_part", part_of("_x_row"))


def refine(rows: DataFrame) -> DataFrame:
    """The rows of ``measured`` texts that share length and prefix hash with another
    one, with ``full_hash``; all others are unique texts and are left out."""
    spark = rows.sparkSession
    short = rows.select("_x_len", "_x_prefix")
    by_length = stored(spark, short.groupBy("_x_len").count().where("count > 1").select("_x_len"), "exact-lengths")
    by_prefix = stored(spark, (
        short.join(by_length, "_x_len", "left_semi")
        .groupBy("_x_prefix", "_x_len").count().where("count > 1").select("_x_len", "_x_prefix")
    ), "exact-prefixes")
    # A sort-merge join by hint: the table of shared prefixes grows with the documents,
    # and so the plan is the same at every size.
    return rows.join(by_prefix.hint("merge"), ["_x_len", "_x_prefix"]).withColumnRenamed("text_sha256", "full_hash")


def keepers(rows: DataFrame) -> DataFrame:
    """One row per ``full_hash`` with company: keep_id, keep_chars and keep_row of the row
    that stays (most ``_x_chars``, then the smallest doc_id, null last, then the smallest
    ``_x_row``), group_size, and the bits of the ``_x_part`` that hold members."""
    best = F.min(F.struct((-F.col("_x_chars")).alias("c"), F.col("doc_id").isNull().alias("n"),
                          F.col("doc_id").alias("d"), F.col("_x_row").alias("r")))
    return (
        rows.groupBy("full_hash").agg(
            best.alias("b"), F.count(F.lit(1)).alias("group_size"), parts_held())
        .where("group_size > 1")
        .select("full_hash", F.col("b.d").alias("keep_id"), "group_size", (-F.col("b.c")).alias("keep_chars"),
                F.col("b.r").alias("keep_row"), "_x_parts")
    )


def dealt_keepers(rows: DataFrame) -> DataFrame:
    """``keepers`` of ``rows``, stored, once for every part that holds members. With the
    hint the join that follows is a sort-merge join at every size: the table grows with
    the documents."""
    return stored(rows.sparkSession, by_part(keepers(rows)), "exact-keepers").hint("merge")


def exact_groups(docs: DataFrame) -> DataFrame:
    """Every document with its group of equal texts.

    Returns one row per input row: doc_id, keep_id, group_size (long), kept,
    text_sha256. Texts are equal when identical after white space is deleted; a
    null text counts as empty, so all empty and null texts form one group.

    - Of equal texts the one with the most code points in the original stays,
      then the smallest doc_id; a null doc_id comes last.
    - Rows that repeat both doc_id and text count one each in group_size; the
      first of them can be kept, the others are dropped.
    - Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    rows = stored(spark, measured(docs), "exact-hashes")
    # Only texts with company are grouped; a row without a group is alone.
    groups = dealt_keepers(refine(rows))
    alone = F.col("group_size").isNull()
    return (
        rows.withColumnRenamed("text_sha256", "full_hash").join(groups, ["full_hash", "_x_part"], "left")
        .select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                (alone | (F.col("_x_row") == F.col("keep_row"))).alias("kept"), F.col("full_hash").alias("text_sha256"))
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns: one of each group of
    equal texts. Rows that repeat doc_id and text length within a group are one
    document and stay or go together; rows of another group, whatever their doc_id
    and length, are not touched. A null doc_id is a value like any other."""
    spark = docs.sparkSession
    chars = F.coalesce(F.length("text"), F.lit(0))
    candidates = stored(spark, refine(stored(spark, measured(docs), "exact-hashes")), "exact-candidates")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_x_chars") == F.col("keep_chars"))
    dropped = (
        candidates.join(dealt_keepers(candidates), ["full_hash", "_x_part"]).where(~stays)
        .select(F.col("doc_id").alias("_x_id"), F.col("_x_chars").alias("_x_gone"), F.col("full_hash").alias("_x_hash"))
        .distinct()
    )
    # A sort-merge join by hint: the table of dropped rows grows with the documents.
    return docs.join(
        dropped.hint("merge"),
        (F.sha2(without_spaces(docs["text"]), 256) == F.col("_x_hash"))
        & docs["doc_id"].eqNullSafe(F.col("_x_id")) & (chars == F.col("_x_gone")), "left_anti")
