"""Prefix trie of conversations, from ternary search trees over range shards.

Turns are dictionary-encoded: each distinct (role, text) gets a number. The numbers
of a conversation, cut into segments of ``SEGMENT`` turns, are sorted and dealt into
range shards, so conversations with a common beginning lie together and equal ones
may still be cut by conv_id. A task reads one shard, whose size is bounded, and

1. builds a ternary search tree of the distinct sequences of each common top, which
   inserting the median first, then the medians of both halves, keeps balanced;
2. walks it without recursion and adds up members, smallest conversation, children,
   leaves and savings from the bottom.

Conversations below a node are neighbours in the sort order, so a node lies in several
shards only if it is on the path of a shard's first or last conversation. Such
boundary nodes, and all that lie above or inside later segments of long
conversations, are given out with what their complete (inner) subtrees add up to, and
are merged by key: members are summed, smallest conversations compared, and subtree
sums made along the paths that hold them. Every other node is final in its shard.

A key is the exclusive or, over the turns, of two hashes of (depth, turn number): 128
bits that do not need a fold over a long conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.arrow import arrow_schema, batched
from marketlake.llm.common import ship_by_value, stored
from marketlake.llm.ranges import numbered, range_shards

ship_by_value(__name__)

#: Turns of a segment, and of a range shard (segments are not cut).
SEGMENT = 256
SHARD_TURNS = 50_000
#: Rows of a range shard of the ordered turns.
SHARD_ROWS = 100_000

# Fixed values of the contract: conversations that share a head, and its lengths.
FAMILY, HEADS = 100, 6

_KEY = ["depth", "key0", "key1"]


def ordered_turns(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) as conv_id, i (place from 0 by turn, null
    first, then role and the SHA-256 of role and text), mark (that SHA-256) and chars
    (code points of the text). Null roles and texts are empty; rows without conv_id
    belong to no conversation. A long conversation is numbered shard by shard."""
    named = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *[
            F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    marked = named.select(
        "conv_id", "turn", "role",
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("mark"),
        F.length("text").alias("chars"))
    ordered, _ = range_shards(marked, ["conv_id", "turn", "role", "mark"], "trie-turns", shard_rows)
    return numbered(ordered, "conv_id", "trie-begun").select("conv_id", "i", "mark", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The contract's conversations, from ``turns`` (conv_id, i, mark, chars): the first
    h turns of conversation c - c % 100, h = crc32(c) % 6, then c's own turns from the
    h-th on. Returns paths (conv_id, depth from 1, mark, chars) and all conv_ids."""
    spark = turns.sparkSession
    turns = stored(spark, turns, "trie-ordered")

    def head(c: str):
        return (F.crc32(F.col(c).cast("string").cast("binary")) % HEADS).cast("long")

    def base(c: str):
        return F.col(c) - F.col(c) % FAMILY

    convs = stored(spark, turns.select("conv_id").distinct(), "trie-convs")
    heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("i") < HEADS - 1)).withColumnRenamed("conv_id", "base")
    sizes = stored(spark, heads.groupBy("base").agg(F.count(F.lit(1)).alias("held")), "trie-heads")
    taken = (
        convs.withColumn("base", base("conv_id")).join(heads, "base").where(F.col("i") < head("conv_id"))
        .select("conv_id", (F.col("i") + 1).alias("depth"), "mark", "chars")
    )
    own = (
        turns.where(F.col("i") >= head("conv_id")).withColumn("base", base("conv_id"))
        .join(sizes.hint("merge"), "base", "left")
        .select("conv_id", (F.col("i") + 1 - head("conv_id") + F.least(head("conv_id"), F.coalesce("held", F.lit(0)))).alias("depth"),
                "mark", "chars")
    )
    return taken.unionByName(own), convs


class TernaryTree:
    """Sequences of numbers. Every tree node stands for a prefix: node 0 for the top,
    the others for their parent's prefix and one number more. ``low`` and ``high`` lead
    to siblings, ``below`` to the children."""

    def __init__(self) -> None:
        self.number: list[int] = []
        self.low: list[int] = []
        self.high: list[int] = []
        self.below: list[int] = []
        self.source: list[tuple[int, int]] = []  # (sequence, place) that a node was made from
        self._node(-1, (-1, -1))

    def _node(self, number: int, source: tuple[int, int]) -> int:
        self.number.append(number)
        self.source.append(source)
        for links in (self.low, self.high, self.below):
            links.append(-1)
        return len(self.number) - 1

    def path(self, numbers: list[int], which: int = -1) -> list[int]:
        """The nodes of ``numbers``, after the top; missing ones are made."""
        out, parent = [], 0
        for place, number in enumerate(numbers):
            links, at = self.below, parent
            while True:
                node = links[at]
                if node < 0:
                    node = links[at] = self._node(number, (which, place))
                    break
                if self.number[node] == number:
                    break
                links, at = (self.low if number < self.number[node] else self.high), node
            out.append(node)
            parent = node
        return out

    def walk(self) -> tuple[list[int], list[int]]:
        """All nodes but the top, parents before children, and the parent of each node."""
        order, parents = [], [-1] * len(self.number)
        todo = [(self.below[0], 0)]
        while todo:
            node, parent = todo.pop()
            if node < 0:
                continue
            order.append(node)
            parents[node] = parent
            todo += [(self.low[node], parent), (self.high[node], parent), (self.below[node], node)]
        return order, parents


def medians_first(n: int) -> Iterator[int]:
    """0 to n - 1: the middle first, then the middles of both halves, and so on."""
    todo = [(0, n)]
    while todo:
        begin, end = todo.pop()
        if begin < end:
            middle = (begin + end) // 2
            yield middle
            todo += [(middle + 1, end), (begin, middle)]


def _digest(convs: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, convs)).encode()).hexdigest()


INNER, UNDER_BOUNDARY, BOUNDARY, CHAIN = range(4)


def trie_rows(segments: list[dict], first: bool, last: bool) -> Iterator[dict]:
    """Nodes of one top's ``segments`` (sorted). ``first`` and ``last``: whether they
    hold the shard's first and last segment."""
    block = segments[0]["block"]
    whole_boundary = block > 0  # everything inside later segments hangs on other blocks
    groups = [(ids, list(rows)) for ids, rows in groupby(segments, key=lambda r: r["ids"])]
    tree = TernaryTree()
    ends: dict[int, list[int]] = {}
    for which in medians_first(len(groups)):
        ids, rows = groups[which]
        nodes = tree.path(ids, which)
        ends[nodes[-1] if nodes else 0] = rows
    size = len(tree.number)
    order, parents = tree.walk()

    edge = [whole_boundary] * size
    edge[0] = True
    chains = []
    for i, row in enumerate(segments):
        chain = whole_boundary or row["goes_on"] or (first and i == 0) or (last and i + 1 == len(segments))
        if chain:
            nodes = tree.path(row["ids"])
            chains.append((row["conv_id"], nodes))
            for node in nodes:
                edge[node] = True

    members, least = [0] * size, [None] * size
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    chars = [0] * size
    depth = [block * SEGMENT] * size
    for node in order:
        which, place = tree.source[node]
        chars[node] = groups[which][1][0]["chars"][place]
        depth[node] = block * SEGMENT + place + 1
    for node, rows in ends.items():
        members[node] = len(rows)
        least[node] = rows[0]["conv_id"]
    # From the bottom: a node comes after its parent in ``order``.
    for node in reversed(order):
        parent = parents[node]
        members[parent] += members[node]
        least[parent] = least[node] if least[parent] is None else min(least[parent], least[node])
        if not edge[node]:
            saved[node] += (members[node] - 1) * chars[node]
            leaves[node] += children[node] == 0
            children[parent] += 1
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]

    top = (segments[0]["top0"], segments[0]["top1"])
    keys: dict[int, tuple[int, int]] = {0: top}
    running: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def key(node: int) -> tuple[int, int]:
        if node not in keys:
            which, place = tree.source[node]
            if which not in running:
                row = groups[which][1][0]
                running[which] = tuple(
                    np.bitwise_xor.accumulate(np.array(row[c], np.int64)) ^ np.int64(t) for c, t in zip(("hash0", "hash1"), top))
            keys[node] = (int(running[which][0][place]), int(running[which][1][place]))
        return keys[node]

    for node in [0, *order]:
        stop = [r["conv_id"] for r in ends.get(node, []) if not r["goes_on"]]
        row = {"depth": depth[node], "n_convs": members[node], "n_children": children[node], "n_leaves": leaves[node],
               "saved_tokens": saved[node], "conv_id": least[node]}
        if not edge[node]:
            parent = parents[node]
            row |= {"kind": INNER, "ends": _digest(stop)}
            if edge[parent]:
                up = key(parent)
                row |= {"kind": UNDER_BOUNDARY, "up0": up[0], "up1": up[1]}
            else:
                row["parent_conv_id"] = least[parent]
            yield row
            continue
        here = key(node)
        row |= {"kind": BOUNDARY, "key0": here[0], "key1": here[1], "chars": chars[node],
                "ends": ",".join(map(str, stop)), "first_end": stop[0] if stop else None}
        if node:
            up = key(parents[node])
            row |= {"up0": up[0], "up1": up[1]}
        elif block:  # the block above counts the members of a later block's top
            row |= {"n_convs": 0, "conv_id": None}
        yield row
    for conv, nodes in chains:
        for node in [*([] if block else [0]), *nodes]:
            here = key(node)
            yield {"kind": CHAIN, "conv_id": conv, "depth": depth[node], "key0": here[0], "key1": here[1]}


_EMITTED = ("kind int, conv_id long, depth long, key0 long, key1 long, up0 long, up1 long, parent_conv_id long, "
            "n_convs long, n_children long, n_leaves long, saved_tokens long, chars long, ends string, first_end long")


def _segments(paths: DataFrame, convs: DataFrame) -> tuple[DataFrame, int]:
    spark = paths.sparkSession
    paths = stored(spark, paths, "trie-paths")
    words = stored(spark, paths.select("mark").distinct().withColumn("id", F.monotonically_increasing_id()), "trie-dictionary")
    encoded = paths.join(words.hint("merge"), "mark").select(
        "conv_id", "depth", F.floor((F.col("depth") - 1) / SEGMENT).alias("block"), "id", "chars",
        F.xxhash64("depth", "id").alias("hash0"), F.xxhash64(F.lit(1), "depth", "id").alias("hash1"))
    turns = F.array_sort(F.collect_list(F.struct("depth", "id", "chars", "hash0", "hash1")))
    cut = stored(spark, encoded.groupBy("conv_id", "block").agg(
        turns.alias("turns"), F.bit_xor("hash0").alias("all0"), F.bit_xor("hash1").alias("all1")), "trie-cut")
    # Tops of later segments, and which segments go on: long conversations only.
    whole = Window.partitionBy("conv_id")
    along = whole.orderBy("block")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    long = stored(spark, (
        cut.select("conv_id", "block", "all0", "all1")
        .join(cut.where("block = 1").select("conv_id"), "conv_id", "left_semi")
        .select("conv_id", "block", F.bit_xor("all0").over(before).alias("top0"), F.bit_xor("all1").over(before).alias("top1"),
                F.lead("block").over(along).isNotNull().alias("goes_on"))
    ), "trie-tops")
    placed = cut.join(long, ["conv_id", "block"], "left").select(
        "conv_id", "block", F.coalesce("top0", F.lit(0)).cast("long").alias("top0"),
        F.coalesce("top1", F.lit(0)).cast("long").alias("top1"), *[
            F.col(f"turns.{c}").alias(n) for c, n in [("id", "ids"), ("chars", "chars"), ("hash0", "hash0"), ("hash1", "hash1")]],
        F.coalesce("goes_on", F.lit(False)).alias("goes_on"))
    types = dict(placed.dtypes)
    turnless = convs.join(cut.select("conv_id"), "conv_id", "left_anti").select("conv_id", *[
        (F.array() if t.startswith("array") else F.lit(False) if t == "boolean" else F.lit(0)).cast(t).alias(c)
        for c, t in types.items() if c != "conv_id"])
    return placed.unionByName(turnless), paths.count()


def _emitted(segments: DataFrame, shards: int) -> DataFrame:
    schema = arrow_schema(_EMITTED)

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held = [row for part in parts for row in part.to_pylist()]
        tops = [list(g) for _, g in groupby(held, key=lambda r: (r["block"], r["top0"], r["top1"]))]
        for i, top in enumerate(tops):
            yield from trie_rows(top, i == 0, i + 1 == len(tops))

    keys = ["block", "top0", "top1", "ids", "conv_id"]
    return segments.repartitionByRange(shards, *keys).sortWithinPartitions(*keys).mapInArrow(
        lambda parts: batched(rows(parts), schema, 5_000), _EMITTED)


def _digests(boundary: DataFrame) -> DataFrame:
    """SHA-256 of the conversations that end at each boundary node. Its pieces come in
    the order of conv_id and are hashed as they pass."""
    ddl = "depth long, key0 long, key1 long, ends_sha256 string"
    schema = arrow_schema(ddl)

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        at, digest = None, None
        for part in parts:
            for row in part.to_pylist():
                here = (row["depth"], row["key0"], row["key1"])
                if here != at:
                    if at is not None:
                        yield {**dict(zip(_KEY, at)), "ends_sha256": digest.hexdigest()}
                    at, digest = here, hashlib.sha256(row["ends"].encode())
                else:
                    digest.update(("," + row["ends"]).encode())
        if at is not None:
            yield {**dict(zip(_KEY, at)), "ends_sha256": digest.hexdigest()}

    return (
        boundary.where("first_end is not null").select(*_KEY, "first_end", "ends")
        .repartition(*_KEY).sortWithinPartitions(*_KEY, "first_end")
        .mapInArrow(lambda parts: batched(rows(parts), schema), ddl)
    )


def _merged(emitted: DataFrame) -> DataFrame:
    """Boundary nodes with all their columns, one row each, with their key."""
    spark = emitted.sparkSession
    boundary = emitted.where(F.col("kind") == BOUNDARY)
    nodes = stored(spark, boundary.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.max("chars").alias("chars"),
        F.max("up0").alias("up0"), F.max("up1").alias("up1"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")), "trie-boundary")
    more = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("up0").alias("key0"), F.col("up1").alias("key1")).agg(
        F.count(F.lit(1)).alias("more"))
    nodes = stored(spark, nodes.join(more, _KEY, "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more"), "trie-children")
    # What each node adds to the sums of all nodes above it, credited to one of the
    # paths that hold it; sums from the end of each path, then over the paths.
    chains = stored(spark, emitted.where(F.col("kind") == CHAIN).select("conv_id", *_KEY).distinct(), "trie-chains")
    credited = (
        nodes.select(*_KEY, (F.col("saved_tokens") + F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("chars"))
                             .otherwise(0)).alias("saves"),
                     (F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("ends"))
        .join(chains.groupBy(*_KEY).agg(F.min("conv_id").alias("conv_id")), _KEY)
    )
    amounts = stored(spark, (
        chains.join(credited, ["conv_id", *_KEY], "left")
        .select("conv_id", *_KEY, F.floor(F.col("depth") / SEGMENT).alias("block"),
                *[F.coalesce(c, F.lit(0)).alias(c) for c in ("saves", "ends")])
    ), "trie-amounts")
    later = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    after = amounts.groupBy("conv_id", "block").agg(F.sum("saves").alias("s"), F.sum("ends").alias("e")).select(
        "conv_id", "block", *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(n) for c, n in [("s", "later_s"), ("e", "later_e")]])
    inside = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    sums = (
        amounts.withColumns({c: F.sum(c).over(inside) for c in ("saves", "ends")})
        .join(stored(spark, after, "trie-later"), ["conv_id", "block"])
        .groupBy(*_KEY).agg(F.sum(F.col("saves") + F.col("later_s")).alias("saved_tokens"),
                            F.sum(F.col("ends") + F.col("later_e")).alias("n_leaves"))
    )
    digests = stored(spark, _digests(boundary), "trie-ends")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return stored(spark, (
        nodes.drop("saved_tokens", "n_leaves").join(stored(spark, sums, "trie-sums"), _KEY)
        .join(digests, _KEY, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
    ), "trie-merged")


def trie_of_paths(paths: DataFrame, convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of ``paths`` (conv_id, depth, mark, chars); ``convs`` holds every conv_id,
    those without a turn too. See ``prefix_trie``."""
    spark = paths.sparkSession
    segments, turns = _segments(paths, convs)
    emitted = stored(spark, _emitted(segments, max(1, ceil(turns / shard_turns))), "trie-emitted")
    merged = _merged(emitted)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    parents = merged.select((F.col("depth") + 1).alias("depth"), F.col("key0").alias("up0"), F.col("key1").alias("up1"),
                            F.col("conv_id").alias("parent_conv_id")).hint("merge")
    inner = emitted.where(F.col("kind") == INNER).withColumnRenamed("ends", "ends_sha256").select(columns)
    under = (
        emitted.where(F.col("kind") == UNDER_BOUNDARY).drop("parent_conv_id").withColumnRenamed("ends", "ends_sha256")
        .join(parents, ["depth", "up0", "up1"]).select(columns)
    )
    return inner.unionByName(under).unionByName(merged.join(parents, ["depth", "up0", "up1"], "left").select(columns))


def prefix_trie(rows: DataFrame, **sizes: int) -> DataFrame:
    """The prefix trie of the conversations of ``rows`` (conv_id, turn, role, text).

    Returns one row per node, that is per distinct beginning of d turns (role, text),
    from d = 0: conv_id (smallest member), depth, parent_conv_id (the parent's conv_id;
    null for the root), n_convs (members: conversations that begin so), n_children,
    n_leaves (nodes without children in its subtree, itself included), saved_tokens (over
    its subtree: members but one, times the code points of the node's last text), all
    long, and ends_sha256 (of the comma-joined conv_ids, ascending, that end here).

    - Turns are in the order of turn (null first), role, and the SHA-256 of role and
      text. Null roles and texts are empty. Rows without conv_id are left out.
    - Repeated rows are turns of their own. Equal conversations share all their nodes.
    - Other columns are not read. An empty table has no root: the result is empty.
    """
    turns = ordered_turns(rows)
    paths = turns.select("conv_id", (F.col("i") + 1).alias("depth"), "mark", "chars")
    return trie_of_paths(paths, rows.where("conv_id is not null").select(F.col("conv_id").cast("long")).distinct(), **sizes)


def rebuilt_trie(rows: DataFrame, shard_rows: int = SHARD_ROWS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The prefix trie of the contract's rebuilt conversations; columns as in
    ``prefix_trie``."""
    return trie_of_paths(*rebuilt(ordered_turns(rows, shard_rows)), shard_turns)
