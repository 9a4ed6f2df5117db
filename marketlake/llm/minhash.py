"""MinHash near-dedup with circulant signatures.

Two permutations make the whole signature: the first scatters the shingles over
the universe of 32-bit integers, the second is circularly shifted by 0, 1, 2, ...
to give every coordinate (C-MinHash). Signatures are cut into bands; documents
that agree in a band are candidates, and every link is confirmed on the full
shingle sets.

No step lists all pairs of a group:

1. Documents with the same shingle set become one class, kept by its smallest
   doc_id; a group of exact copies costs one row from here on.
2. In each band bucket every member is paired with the bucket's smallest member
   only (a star). Confirmed stars give components; in a group of near copies
   almost all members are joined here by a number of pairs that is linear in
   the group.
3. Only buckets that still hold several components are looked at again, in
   tiles of bounded size. There, pairs of different components are compared by
   their signatures, and those that may reach the threshold are confirmed on
   the full sets. A tile returns links that join components, not pairs.

Components are found with joins (``components``). Joins of tables that grow with
the data are sort-merge joins by hint: the plan is the same at every size, and
nothing of unproven size is sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from marketlake.llm.common import absent, discard, possible, ship_by_value, stored
from marketlake.llm.components import components
from marketlake.llm.shingles import mix64, shingle_sets, text_blocks

ship_by_value(__name__)

#: 40 bands of 6: of pairs at similarity 0.8, all but 5 in a million share a band.
BANDS, ROWS = 40, 6
#: Signature similarity below which a pair is not confirmed: four standard
#: deviations of the estimate under the threshold of 0.8.
MARGIN = 0.1
#: Shingles whose coordinates are made at a time (fits a core's cache).
CHUNK = 32_768
#: Documents of one block of a tile.
TILE_ROWS = 256

_U32, _U64 = np.uint32, np.uint64


def _permute(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit integers (a bijective finaliser)."""
    y = x >> _U32(16)
    y ^= x
    y *= _U32(0x85EBCA6B)
    y ^= y >> _U32(13)
    y *= _U32(0xC2B2AE35)
    return y


def signatures(hashes: np.ndarray, counts: np.ndarray, coordinates: int = BANDS * ROWS) -> np.ndarray:
    """A row of ``coordinates`` minima for every non-empty set; others stay 0."""
    out = np.zeros((len(counts), coordinates), dtype=_U32)
    filled = np.flatnonzero(counts)
    ends = np.cumsum(counts[filled])
    scattered = _permute((hashes ^ (hashes >> _U64(32))).astype(_U32))
    scattered ^= scattered >> _U32(16)
    at = 0
    while at < len(filled):
        begin = ends[at] - counts[filled[at]]
        upto = max(at + 1, int(np.searchsorted(ends, begin + CHUNK, "right")))
        x = scattered[begin:ends[upto - 1]]
        starts = ends[at:upto] - counts[filled[at:upto]] - begin
        for k in range(coordinates):
            out[filled[at:upto], k] = np.minimum.reduceat(_permute(x + _U32(k)), starts)
        at = upto
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    parts = signature.reshape(len(signature), BANDS, ROWS).astype(_U64)
    keys = np.broadcast_to(mix64(np.arange(1, BANDS + 1, dtype=_U64)), parts.shape[:2]).copy()
    for r in range(ROWS):
        keys = mix64(keys * _U64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return keys


def _sign(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for begin, texts in text_blocks(batch.column(1).to_pylist()):
            hashes, counts = shingle_sets(texts, size)
            made = signatures(hashes, counts)
            filled = np.flatnonzero(counts)
            starts = (np.cumsum(counts) - counts)[filled]
            sums = np.zeros((len(counts), 2), dtype=_U64)
            if len(filled):
                sums[filled, 0] = np.add.reduceat(hashes, starts)
                sums[filled, 1] = np.add.reduceat(mix64(hashes), starts)
            offsets = np.arange(len(counts) + 1, dtype=np.int32) * BANDS
            yield pa.RecordBatch.from_arrays([
                ids.slice(begin, len(texts)),
                pa.array(counts, pa.int64()),
                pa.array([r.tobytes() for r in sums], pa.binary()),
                pa.ListArray.from_arrays(offsets, pa.array(band_keys(made).reshape(-1).view(np.int64))),
                pa.array([r.tobytes() for r in made.astype(np.uint8)], pa.binary()),
            ], names=["doc_id", "n", "set_key", "bands", "sketch"])


def _shingle(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for begin, texts in text_blocks(batch.column(1).to_pylist()):
            hashes, counts = shingle_sets(texts, size)
            offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                ids.slice(begin, len(texts)),
                pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64))),
            ], names=["doc_id", "shingles"])


def _groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups out of sorted batches. A group is at most one tile."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        values = frame[keys].to_numpy()
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        if held and (held[-1][keys].to_numpy()[-1] != values[0]).any():
            yield pd.concat(held) if len(held) > 1 else held[0]
            held = []
        bounds = [0, *cuts.tolist(), len(frame)]
        for a, b in zip(bounds[:-1], bounds[1:]):
            held.append(frame.iloc[a:b])
            if b < len(frame):
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _tile_candidates(frames: Iterator[pd.DataFrame], least: int, percent: int) -> Iterator[pd.DataFrame]:
    """For every document of a tile with a partner in another component whose
    signature may reach the threshold: its partners with a larger place.
    A pair is reported in the first band that both share, so only once. Bands are
    compared by their whole keys, as buckets are: sketches may agree by chance in a
    band whose bucket the two do not share."""
    for tile in _groups(frames, ["key", "low", "high"]):
        ids, comp, n = (tile[c].to_numpy() for c in ("doc_id", "component", "n"))
        block, low, high, band = tile["block"].to_numpy(), *(tile[c].iat[0] for c in ("low", "high", "band"))
        sketch = np.frombuffer(b"".join(tile["sketch"]), dtype=np.uint8).reshape(len(tile), -1)
        earlier = np.concatenate(tile["earlier"].to_numpy()).reshape(len(tile), int(band))
        partners: dict[int, list[int]] = {}
        for i in range(len(tile) - 1):
            other = np.arange(i + 1, len(tile))
            other = other[(comp[other] != comp[i]) & (ids[other] != ids[i])
                          & (100 * np.minimum(n[other], n[i]) >= percent * np.maximum(n[other], n[i]))]
            if low != high:
                other = other[block[other] != block[i]]
            if not len(other):
                continue
            other = other[(sketch[other] == sketch[i]).sum(axis=1) >= least]
            if len(other):
                mine = other[~(earlier[other] == earlier[i]).any(axis=1)]
                if len(mine):
                    partners.setdefault(i, []).extend(ids[mine].tolist())
                    for j in mine.tolist():
                        partners.setdefault(j, [])
        if partners:
            at = list(partners)
            yield pd.DataFrame({
                "key": tile["key"].iat[0], "low": low, "high": high, "doc_id": ids[at],
                "component": comp[at], "partners": [partners[i] for i in at],
            })


def _tile_links(frames: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    """Links between components, confirmed on full sets: for each tile a forest."""
    for tile in _groups(frames, ["key", "low", "high"]):
        ids = tile["doc_id"].tolist()
        sets = dict(zip(ids, tile["shingles"]))
        comp = dict(zip(ids, tile["component"].tolist()))
        parent = {c: c for c in comp.values()}

        def root(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        found = []
        for i, partners in zip(ids, tile["partners"]):
            for j in partners:
                if root(comp[i]) == root(comp[j]):
                    continue
                a, b = sets[i], sets[j]
                both = len(a) + len(b) - len(np.union1d(a, b))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    parent[root(comp[i])] = root(comp[j])
                    found.append((i, j))
        if found:
            yield pd.DataFrame(found, columns=["a", "b"])


def near_groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Group near copies of ``docs`` (doc_id: long, text).

    Returns one row per input row: doc_id, n_shingles (long), component_id (the
    smallest doc_id reachable by links) and kept (doc_id = component_id). Two
    documents are linked when 100 * intersection >= ``percent`` * union of their
    sets of ``size``-word shingles (lower-cased A-Z, words split at white space).

    - A document with fewer words has its whole sequence as its one shingle; one
      without words, or with a null text, has none and is linked with nothing.
    - Rows that repeat a doc_id are one node of the graph: what any of their
      texts links is linked with all of them, and all carry the same kept.
    - A null doc_id is linked with nothing: component_id is null, kept is true.
    - Other columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(spark, texts.mapInArrow(
        lambda it: _sign(it, size), "doc_id long, n long, set_key binary, bands array<long>, sketch binary",
    ), "minhash-signatures")
    whole = signed.where("n > 0 and doc_id is not null")

    copies, reps = _classes(whole)
    member = reps.select("doc_id", F.posexplode("bands").alias("band", "key"))
    hubs = member.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).where("hub <> last")
    hubs = stored(spark, hubs.drop("last"), "minhash-hubs")
    shared = stored(spark, possible(member, hubs, "key").join(hubs, "key"), "minhash-buckets")

    stars = shared.where("doc_id <> hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    close = stored(spark, _close(stars, reps, percent), "minhash-stars")
    sets = _sets(texts, close.select(F.explode(F.array("a", "b")).alias("doc_id")), size)
    links = stored(spark, _confirmed(close, sets, percent).union(copies).distinct(), "minhash-links")
    discard(spark, sets)
    grouped = components(links)

    candidates = _cross_candidates(shared, reps, grouped, percent)
    sets = _sets(texts, candidates, size)
    more = stored(spark, _cross_links(candidates, sets, percent), "minhash-cross")
    discard(spark, sets)
    if not more.isEmpty():
        grouped = components(links.union(more))
    return (
        signed.select("doc_id", F.col("n").alias("n_shingles"))
        .join(grouped.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents of ``docs`` that stay, with all their columns: of each group of near
    copies the one with the smallest doc_id (a null one comes last).

    Groups are made of texts, not of doc_ids: a row goes only for its own text, whatever
    other rows share its doc_id. Rows that repeat both doc_id and text are one document
    and stay or go together. Texts without words are linked with nothing and stay. A
    text's node is a 64-bit hash of it."""
    spark = docs.sparkSession
    node = F.xxhash64(docs["text"])
    groups = stored(spark, (
        near_groups(docs.select(node.alias("doc_id"), docs["text"].alias("text")), size, percent).where("n_shingles > 0")
        .select(F.col("doc_id").alias("_x_node"), "component_id").distinct()
    ), "minhash-groups")
    row = F.struct(F.col("_x_id").isNull().alias("none"), F.col("_x_id").alias("id"), F.col("_x_node").alias("node"))
    members = stored(spark, (
        docs.select(docs["doc_id"].alias("_x_id"), node.alias("_x_node")).distinct()
        .join(groups.hint("merge"), "_x_node").select("component_id", row.alias("row"))
    ), "minhash-members")
    stays = stored(spark, (
        members.groupBy("component_id").agg(F.min("row").alias("first"), F.max("row").alias("last"))
        .where("first <> last").drop("last")
    ), "minhash-stays")
    dropped = (
        members.join(stays.hint("merge"), "component_id").where("row <> first")
        .select(F.col("row.id").alias("_x_id"), F.col("row.node").alias("_x_node"))
    )
    dropped = stored(spark, dropped, "minhash-dropped").hint("merge")
    return docs.join(dropped, docs["doc_id"].eqNullSafe(F.col("_x_id")) & (node == F.col("_x_node")), "left_anti")


def _classes(whole: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The links (a, b) of exact copies to the smallest doc_id of their set, and the rows
    (doc_id, n, bands, sketch) that stand for their class. Most sets have no copies; a
    bitmap tells them where they lie, and only the signatures of the others are moved.
    Those are joined with their set and doc_id: copies of one set go to many tasks."""
    spark = whole.sparkSession
    own = whole.select("set_key", "doc_id")
    first = F.min("doc_id").alias("rep")
    classes = stored(spark, (
        own.groupBy("set_key").agg(first, F.max("doc_id").alias("last")).where("rep <> last").select("set_key", "rep")
    ), "minhash-classes")
    copies = (
        possible(own, classes, "set_key").join(classes.hint("merge"), "set_key").where("doc_id <> rep")
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()
    )
    payload = ["doc_id", "n", "bands", "sketch"]
    # What passes the bitmap by chance is the first of its set like any other.
    firsts = possible(own, classes, "set_key").groupBy("set_key").agg(first).withColumnRenamed("rep", "doc_id")
    firsts = stored(spark, firsts, "minhash-firsts")
    chosen = stored(spark, (
        possible(whole, classes, "set_key").join(firsts.hint("merge"), ["set_key", "doc_id"]).select(*payload)
    ), "minhash-chosen")
    return copies, absent(whole, classes, "set_key").select(*payload).unionByName(chosen)


def _least_equal(percent: int) -> int:
    """Equal bytes of two sketches from which a pair is confirmed."""
    return int(np.ceil(BANDS * ROWS * ((percent / 100 - MARGIN) * 255 / 256 + 1 / 256)))


def _close(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures allow them to reach the threshold."""

    @pandas_udf("int")
    def equal(one: pd.Series, two: pd.Series) -> pd.Series:
        x, y = (np.frombuffer(b"".join(s), dtype=np.uint8).reshape(len(s), -1) for s in (one, two))
        return pd.Series((x == y).sum(axis=1), dtype=np.int32)

    def side(name: str) -> DataFrame:
        own = reps.select(F.col("doc_id").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}"))
        return possible(own, pairs, name)

    return (
        pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")
        .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        .where(equal("s_a", "s_b") >= _least_equal(percent)).select("a", "b")
    )


def _sets(texts: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """The full shingle sets of the documents in ``ids``. Only texts that pass the bitmap
    are moved."""
    ids = ids.select("doc_id").distinct()
    wanted = possible(texts, ids, "doc_id").join(ids.hint("merge"), "doc_id").select("doc_id", "text")
    return stored(texts.sparkSession, wanted.mapInArrow(
        lambda it: _shingle(it, size), "doc_id long, shingles array<long>"), "minhash-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(one.hint("merge"), "a").join(two.hint("merge"), "b")
        .where(100 * F.least(F.size("x"), F.size("y")) >= percent * F.greatest(F.size("x"), F.size("y")))
        .where(100 * both >= percent * (F.size("x") + F.size("y") - both))
        .select("a", "b")
    )


def _cross_candidates(shared: DataFrame, reps: DataFrame, grouped: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components of one bucket that may be links, as rows
    (tile, document, its partners)."""
    spark = shared.sparkSession
    placed = (
        shared.join(grouped.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id"))
    )
    # The largest component of a bucket, and what is outside it.
    sizes = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    open_keys = stored(spark, (
        sizes.groupBy("key").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("all"),
                                 F.count(F.lit(1)).alias("components"))
        .where("components > 1")
        .select("key", F.col("main.component").alias("main"),
                F.ceil(F.col("main.n") / TILE_ROWS).cast("int").alias("main_blocks"),
                F.ceil((F.col("all") - F.col("main.n")) / TILE_ROWS).cast("int").alias("blocks"))
    ), "minhash-open-keys")
    left = stored(spark, placed.join(open_keys, "key"), "minhash-open")
    # Blocks outside the main component meet all blocks, those inside it only the former.
    inside = F.col("component") == F.col("main")
    spread = F.xxhash64("doc_id")
    tiles = (
        left.join(possible(reps.select("doc_id", "n", "sketch", "bands"), left, "doc_id").hint("merge"), "doc_id")
        .withColumn("block", F.when(inside, F.col("blocks") + F.pmod(spread, F.col("main_blocks")))
                    .otherwise(F.pmod(spread, F.col("blocks"))).cast("int"))
        .withColumn("other", F.explode(F.sequence(
            F.lit(0), F.when(inside, F.col("blocks")).otherwise(F.col("blocks") + F.col("main_blocks")) - 1)))
        .select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                "block", "band", "doc_id", "component", "n", "sketch",
                F.slice("bands", 1, F.col("band")).alias("earlier"))
        .repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    )
    least = _least_equal(percent)
    return stored(spark, tiles.mapInPandas(
        lambda it: _tile_candidates(it, least, percent),
        "key long, low int, high int, doc_id long, component long, partners array<long>",
    ), "minhash-candidates")


def _cross_links(candidates: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components, confirmed on the full sets."""
    return (
        candidates.join(sets.hint("merge"), "doc_id")
        .repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
        .mapInPandas(lambda it: _tile_links(it, percent), "a long, b long")
    )
