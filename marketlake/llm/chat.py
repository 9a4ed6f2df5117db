"""Chat formatting with cumulative-snapshot collapse.

Chat logs hold the same conversation many times: once for every turn, each time
one turn longer. A rolling hash of the turns so far is made for every turn; a
conversation whose final hash is the hash of a shorter prefix of another one is a
snapshot of it and is dropped by an anti-join. Of equal conversations the one with
the smallest conv_id stays. What is left is rendered with a chat template.

The rolling hash is a running sum of hashes of (turn, role, text), kept in four
32-bit parts (128 bits), so that it needs no fold over a whole conversation: rows are
put in one order and numbered shard by shard, summed in chunks of ``CHUNK_TURNS`` rows,
and only chunk totals are summed along the conversation. Rendering uses the same
chunks, so that a conversation that holds a third of all rows is spread over many tasks
and rows, also where all its rows have one turn number or none. Only built-in functions
are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import stored
from marketlake.llm.ranges import numbered, range_shards

#: Rows of one chunk, and of one rendered row; rows of a range shard.
CHUNK_TURNS = 256
SHARD_ROWS = 100_000

_HASH = ["h0", "h1", "h2", "h3"]
_LAST_TURN = 2**63 - 1


def _turns(rows: DataFrame, shard_rows: int) -> DataFrame:
    """Distinct turns in order, with their place ``i`` in the conversation, its chunk
    (``part``) and the four parts of their hash."""
    turns = rows.where(F.col("conv_id").isNotNull()).select(
        "conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(_LAST_TURN)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()
    turns = stored(rows.sparkSession, turns, "chat-distinct")
    ordered, _ = range_shards(turns, ["conv_id", "turn", "role", "text"], "chat-ordered", shard_rows)
    one, two = F.xxhash64("turn", "role", "text"), F.xxhash64(F.lit(1), "turn", "role", "text")
    low = F.lit(0xFFFFFFFF).cast("long")
    return stored(rows.sparkSession, numbered(ordered, "conv_id", "chat-begun").select(
        "conv_id", "i", F.floor(F.col("i") / CHUNK_TURNS).alias("part"), "role", "text",
        one.bitwiseAND(low).alias("h0"), F.shiftrightunsigned(one, 32).alias("h1"),
        two.bitwiseAND(low).alias("h2"), F.shiftrightunsigned(two, 32).alias("h3")), "chat-turns")


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id and n_turns of the conversations that are not a prefix of another."""
    spark = turns.sparkSession
    along = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = turns.groupBy("conv_id", "part").agg(
        F.count(F.lit(1)).alias("c"), *[F.sum(h).alias(h) for h in _HASH])
    chunks = stored(spark, totals.select(
        "conv_id", "part", "c", *_HASH,
        F.sum("c").over(Window.partitionBy("conv_id")).alias("n_turns"),
        *[F.coalesce(F.sum(h).over(along), F.lit(0)).alias(f"before_{h}") for h in ["c", *_HASH]],
    ), "chat-chunks")
    inside = Window.partitionBy("conv_id", "part").orderBy("i").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    prefixes = (
        turns.join(chunks.drop("c", *_HASH), ["conv_id", "part"])
        .select((F.count(F.lit(1)).over(inside) + F.col("before_c")).alias("n_turns"),
                F.col("n_turns").alias("whole"),
                *[(F.sum(h).over(inside) + F.col(f"before_{h}")).alias(h) for h in _HASH])
        .where("n_turns < whole").drop("whole").distinct()
    )
    finals = (
        chunks.groupBy("conv_id").agg(F.sum("c").alias("n_turns"), *[F.sum(h).alias(h) for h in _HASH])
        .groupBy("n_turns", *_HASH).agg(F.min("conv_id").alias("conv_id"))
    )
    return finals.join(prefixes, ["n_turns", *_HASH], "left_anti").select("conv_id", "n_turns")


def format_chats(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Render the maximal conversations of ``rows`` (conv_id, turn, role, text).

    Returns conv_id, n_turns (long, of the conversation), part (long) and text: one
    row for each ``CHUNK_TURNS`` turns, which for a conversation of usual length is its
    only row. Parts in order make up the conversation.

    - Conversations are compared by turn number, role and text. One that equals
      the first turns of a longer one is dropped; of equal ones the smallest
      conv_id stays.
    - Rows without a conv_id belong to no conversation and are left out. A null
      turn comes last, a null role or text counts as empty. Repeated rows count
      once; different rows of one turn follow each other by role and text.
    - Other columns are not read. An empty table gives an empty result.
    """
    turns = _turns(rows, shard_rows)
    kept = stored(rows.sparkSession, maximal_conversations(turns), "chat-maximal")
    # At most CHUNK_TURNS rows in a group.
    ordered = F.array_sort(F.collect_list(F.struct("i", "role", "text")))
    rendered = F.array_join(F.transform(
        "turns", lambda t: F.concat(F.lit("<|im_start|>"), t["role"], F.lit("\n"), t["text"], F.lit("<|im_end|>\n"))), "")
    return (
        turns.select("conv_id", "part", "i", "role", "text").join(kept.hint("merge"), "conv_id")
        .groupBy("conv_id", "n_turns", "part").agg(ordered.alias("turns"))
        .select("conv_id", "n_turns", "part", rendered.alias("text"))
    )
