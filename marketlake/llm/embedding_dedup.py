"""Embedding near-dedup over a robust-pruned flat graph.

Only vectors with the same label and dimension are compared. The work is dealt
into shards that fit a task:

1. Identical vectors become one class; a class travels as one row and a count.
2. A label is split into cells around centres picked from its own vectors; each
   vector belongs to its nearest ``OVERLAP`` cells. Cells that are still too
   large are split again. Centres keep a distance from each other, so a dense
   group of near copies is never torn apart by centres inside it: such a cell is
   cut into parts by a hash, and all pairs of its parts are searched.
3. Each shard (a part of a cell, at most about ``SHARD_ROWS`` vectors) builds a
   graph: near neighbours, robust-pruned, so that an edge is dropped when a kept
   neighbour is clearly nearer to its end. A vector's lists from its overlapping
   shards are united to one flat graph.
4. Each vector is searched in its shards, and in those that the edges of its united list
   lead to where they end near enough: greedy search from the medoid, then range expansion until no
   hit is left unexpanded. Hits are verified by their cosine in double precision.
5. The found links are audited against brute force over all rows for a bounded
   sample of queries, by link and by vector, so that a large group cannot hide lost
   pairs; under ``TARGET`` in either, the work is dealt again with one more cell a
   vector at every split and searched with a wider beam, and after ``WIDENINGS`` such
   rounds all pairs of a label are compared in blocks.

A shard returns a count of links and a spanning forest, never the pairs: a pair
that several shards hold is counted in one of them only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import ship_by_value, stored
from marketlake.llm.components import components

ship_by_value(__name__)

#: Vectors of one shard; cells a vector belongs to at first; rows per centre and most
#: centres of one split; cosine above which two centres are too near.
SHARD_ROWS, OVERLAP, CENTRE_ROWS, CENTRES, CENTRE_COSINE = 1024, 3, 150, 64, 0.75
#: Rows that share one copy of their cell's centres while cells are assigned.
SALT_ROWS = 4096
#: Out-degree of the graph, candidates that are pruned to it, and the slack
#: by which a kept neighbour must be nearer for an edge to be dropped.
DEGREE, CANDIDATES, ALPHA = 24, 64, 1.2
#: Width of the greedy search, and queries searched at a time.
BEAM, QUERY_ROWS = 16, 256
#: How far under the bound the end of an edge may be that is followed out of a vector's
#: own cells.
REACH = 0.06
#: How far under the bound nodes are expanded: hits may be joined through them only.
SLACK = 0.03
#: Queries of the audit (a bounded sample), the recall it asks for, of links and of
#: vectors, and how often a cell is added and the beam doubled to reach it.
AUDIT_ROWS, TARGET, WIDENINGS = 256, 0.95, 3

_LAST = np.iinfo(np.int64).max


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def robust_prune(near: np.ndarray, similarity: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Up to ``degree`` of each row's ``near`` candidates (nearest first, -1: none).

    Candidates are taken from the nearest on; one that was taken removes every
    later candidate that it is nearer to, by the factor ``alpha``, than the row
    is. ``similarity`` holds the cosines of all vectors of the shard.
    """
    distance = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * similarity))
    rows = np.arange(len(near))[:, None]
    own = np.where(near >= 0, distance[rows, near], np.inf)
    open_ = near >= 0
    taken = np.zeros(near.shape, dtype=bool)
    for t in range(near.shape[1]):
        take = open_[:, t] & (taken.sum(axis=1) < degree)
        taken[:, t] = take
        between = distance[near[:, t][:, None], near]
        open_ &= ~(take[:, None] & (alpha * between <= own))
    order = np.argsort(~taken, axis=1, kind="stable")[:, :degree]
    return np.where(np.take_along_axis(taken, order, 1), np.take_along_axis(near, order, 1), -1)


def build_graph(x: np.ndarray) -> np.ndarray:
    """Pruned out-neighbours (places in ``x``, -1: none) of every unit vector."""
    similarity = x @ x.T
    np.fill_diagonal(similarity, -np.inf)
    width = min(CANDIDATES, len(x) - 1)
    if width < 1:
        return np.full((len(x), 1), -1)
    near = np.argpartition(-similarity, width - 1, axis=1)[:, :width]
    rows = np.arange(len(x))[:, None]
    near = np.take_along_axis(near, np.argsort(-similarity[rows, near], axis=1, kind="stable"), 1)
    np.fill_diagonal(similarity, 1.0)
    return robust_prune(near, similarity)


def medoid(x: np.ndarray) -> int:
    return int(np.argmax(x @ x.mean(axis=0)))


def range_search(x: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, least: float,
                 beam: int = BEAM, doors: np.ndarray | None = None) -> np.ndarray:
    """Boolean matrix (query, node) of the nodes found with cosine >= ``least``.

    All queries advance together from ``start`` and from their own ``doors`` (places,
    -1: none): each expands its best unexpanded node of the beam until the beam is
    exhausted, then every node that is a hit or ``SLACK`` short of it and not expanded.
    """
    n, count = len(x), len(queries)
    score = np.full((count, n), -np.inf, dtype=np.float32)
    expanded = np.zeros((count, n), dtype=bool)
    every = np.arange(count)

    def look(q: np.ndarray, nodes: np.ndarray) -> None:
        fresh = nodes >= 0
        q, nodes = np.broadcast_to(q[:, None], nodes.shape)[fresh], nodes[fresh]
        fresh = score[q, nodes] == -np.inf
        q, nodes = q[fresh], nodes[fresh]
        for a in range(0, len(q), 65_536):
            at, to = q[a:a + 65_536], nodes[a:a + 65_536]
            score[at, to] = np.einsum("ij,ij->i", queries[at], x[to])

    look(every, np.full((count, 1), start))
    if doors is not None:
        look(every, doors)
    live = every
    while len(live):
        waiting = np.where(expanded[live], -np.inf, score[live])
        best = waiting.argmax(axis=1)
        top = waiting[np.arange(len(live)), best]
        if n > beam:
            edge = np.partition(score[live], n - beam, axis=1)[:, n - beam]
        else:
            edge = np.full(len(live), -np.inf, dtype=np.float32)
        go = (top > -np.inf) & (top >= edge)
        live, best = live[go], best[go]
        expanded[live, best] = True
        look(live, graph[best])
    # Cosines of the search are single precision: a hair below the bound still counts.
    bound = np.float32(least - 1e-5)
    while True:
        q, nodes = np.nonzero((score >= bound - np.float32(SLACK)) & ~expanded)
        if not len(q):
            return score >= bound
        expanded[q, nodes] = True
        look(q, graph[nodes])


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of row pairs in double precision, from the vectors as given."""
    dot = np.einsum("ij,ij->i", a, b)
    return dot / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))


def _grapher(least: float):
    def graph(frame: pd.DataFrame) -> pd.DataFrame:
        return _shard_graph(frame, least)

    return graph


def _shard_graph(frame: pd.DataFrame, least: float) -> pd.DataFrame:
    """Every vector's list, and the ends of it that are within ``REACH`` of a link."""
    frame = frame.sort_values("node")
    x = _unit(_matrix(frame["embedding"]))
    graph = build_graph(x)
    ids = frame["node"].to_numpy()
    reached = (np.einsum("ij,ikj->ik", x, x[graph]) >= least - REACH) & (graph >= 0)
    return pd.DataFrame({"node": ids, "near": [ids[row[row >= 0]] for row in graph],
                         "ends": [ids[row[mark]] for row, mark in zip(graph, reached)]})


def _found(x: np.ndarray, ids: np.ndarray, near: list, asked: np.ndarray, asked_near: list, least: float, beam: int) -> np.ndarray:
    """Search ``asked`` in the part of the united graph that holds ``ids``: from its
    medoid, and from the ends of the queries' own edges that lie in it."""
    start, graph, doors = medoid(x), _local_graph(ids, near), _local_graph(ids, asked_near)
    return np.concatenate([
        range_search(x, graph, start, asked[a:a + QUERY_ROWS], least, beam, doors[a:a + QUERY_ROWS])
        for a in range(0, len(asked), QUERY_ROWS)
    ])


def _local_graph(ids: np.ndarray, near: list) -> np.ndarray:
    """The lists ``near`` as places in ``ids``; ends that lie elsewhere are left out."""
    place = {v: i for i, v in enumerate(ids.tolist())}
    lists = [[place[v] for v in row if v in place] for row in near]
    graph = np.full((len(lists), max(1, max(map(len, lists)))), -1)
    for i, row in enumerate(lists):
        graph[i, :len(row)] = row
    return graph


def _padded(rows: pd.Series, filler: int) -> np.ndarray:
    out = np.full((len(rows), max(map(len, rows))), filler, dtype=np.int64)
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


def _shard_links(key: tuple, frame: pd.DataFrame, least: float, beam: int | None) -> pd.DataFrame:
    """Links between two parts of a cell (or inside one): for every vector with a
    link its number of new links and its smallest linked vector. Without a ``beam``
    all pairs are compared."""
    cell, low, high = (int(k) for k in key)
    visitors = frame[frame["visits"]].sort_values("node")
    frame = frame[~frame["visits"]].sort_values("node")
    raw = _matrix(frame["embedding"])
    x = _unit(raw).astype(np.float32) if len(frame) else raw
    ids, size, own = (frame[c].to_numpy() for c in ("node", "copies", "part"))
    near = frame["near"].tolist() if beam is not None else []
    one, two = np.flatnonzero(own == low), np.flatnonzero(own == high)
    if not len(one) or not len(two):
        return pd.DataFrame({"node": [], "links": [], "lowest": [], "visited": []}, dtype="Int64")
    if beam is None:
        hits = x[one] @ x[two].T >= np.float32(least - 1e-5)
    else:
        lists = [near[i] for i in one], [near[i] for i in two]
        hits = _found(x[two], ids[two], lists[1], x[one], lists[0], least, beam)
    if low == high:
        hits |= hits.T
        hits = np.triu(hits, 1)
    elif beam is not None:
        hits |= _found(x[one], ids[one], lists[0], x[two], lists[1], least, beam).T
    q, to = np.nonzero(hits)
    q, to = one[q], two[to]
    true = _verified(raw, q, to, least)
    q, to = q[true], to[true]
    # Of the cells that both belong to, the first one counts the link.
    counted = np.empty(len(q), dtype=bool)
    a, b = _padded(frame["cells"], _LAST), _padded(frame["cells"], -1)
    for i in range(0, len(q), 65_536):
        mine, other = a[q[i:i + 65_536]], b[to[i:i + 65_536]]
        shared = (mine[:, :, None] == other[:, None, :]).any(axis=2)
        counted[i:i + 65_536] = np.where(shared, mine, _LAST).min(axis=1) == cell
    links = np.zeros(len(ids), dtype=np.int64)
    np.add.at(links, q[counted], size[to[counted]])
    np.add.at(links, to[counted], size[q[counted]])
    lowest = np.full(len(ids), _LAST)
    np.minimum.at(lowest, q, ids[to])
    np.minimum.at(lowest, to, ids[q])
    some = np.flatnonzero(lowest != _LAST)
    # Chains of smallest partners may stay apart: one more link for each such seam.
    seams = _seams(ids, q, to, lowest)
    out = pd.DataFrame({
        "node": np.r_[ids[some], ids[seams[0]]],
        "links": np.r_[links[some], np.zeros(len(seams[0]), np.int64)],
        "lowest": np.r_[lowest[some], ids[seams[1]]],
        "visited": pd.array([None] * (len(some) + len(seams[0])), dtype="Int64"),
    })
    if len(visitors) and beam is not None:
        q, to = _visitor_links(visitors, frame, raw, x, one, lists[0], least, beam)
        out = pd.concat([out, pd.DataFrame({
            "node": visitors["node"].to_numpy()[q], "links": np.zeros(len(q), np.int64), "lowest": ids[to],
            "visited": pd.array(ids[to], dtype="Int64")})])
    return out


def _visitor_links(
    visitors: pd.DataFrame, frame: pd.DataFrame, raw: np.ndarray, x: np.ndarray, part: np.ndarray, lists: list,
    least: float, beam: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Links (places) between visitors and the vectors of a part that share no cell
    with them: those that do are linked there."""
    asked = _matrix(visitors["embedding"])
    q, to = np.nonzero(_found(
        x[part], frame["node"].to_numpy()[part], lists, _unit(asked).astype(np.float32), visitors["near"].tolist(), least, beam))
    to = part[to]
    true = np.empty(len(q), dtype=bool)
    homes, cells = _padded(visitors["cells"], _LAST), _padded(frame["cells"], -1)
    for i in range(0, len(q), 65_536):
        a, b = q[i:i + 65_536], to[i:i + 65_536]
        apart = ~(homes[a][:, :, None] == cells[b][:, None, :]).any(axis=(1, 2))
        true[i:i + 65_536] = apart & (_exact(asked[a], raw[b]) >= least)
    return q[true], to[true]


def _linker(least: float, beam: int | None):
    def link(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return _shard_links(key, frame, least, beam)

    return link


def _seams(ids: np.ndarray, q: np.ndarray, to: np.ndarray, lowest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (places) that join what the links to the smallest partner leave apart."""
    place = {v: i for i, v in enumerate(ids.tolist())}
    root = np.arange(len(ids))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in np.flatnonzero(lowest != _LAST).tolist():
        root[find(i)] = find(place[int(lowest[i])])
    ones, twos = [], []
    while True:
        for i in range(len(ids)):
            root[i] = find(i)
        apart = np.flatnonzero(root[q] != root[to])
        if not len(apart):
            return np.array(ones, dtype=np.int64), np.array(twos, dtype=np.int64)
        # One link for each tree in this pass; the number of trees at least halves.
        _, first = np.unique(root[q[apart]], return_index=True)
        for k in apart[first].tolist():
            i, j = find(q[k]), find(to[k])
            if i != j:
                root[i] = j
                ones.append(q[k])
                twos.append(to[k])


def _verified(raw: np.ndarray, q: np.ndarray, to: np.ndarray, least: float) -> np.ndarray:
    out = np.empty(len(q), dtype=bool)
    for a in range(0, len(q), 65_536):
        out[a:a + 65_536] = _exact(raw[q[a:a + 65_536]], raw[to[a:a + 65_536]]) >= least
    return out


def pick_centres(x: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of the unit vectors, in their order, none too near to another."""
    kept: list[int] = []
    for i in range(len(x)):
        if len(kept) < most and (not kept or (x[kept] @ x[i]).max() < CENTRE_COSINE):
            kept.append(i)
    return x[kept]


def _assign(frames: Iterator[pd.DataFrame], overlap: int) -> Iterator[pd.DataFrame]:
    """The nearest centres of every vector. Rows come sorted: for each (cell, salt)
    first the candidates for centres (``rank`` >= 0), then the vectors."""
    group, picked, centres = None, [], None
    for frame in frames:
        if not len(frame):
            continue
        keys = frame[["cell", "salt"]].to_numpy()
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(frame)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if group != tuple(keys[a]):
                group, picked, centres = tuple(keys[a]), [], None
            rows = frame.iloc[a:b]
            candidate = rows["rank"].to_numpy() >= 0
            if candidate.any():
                picked.append(rows[candidate])
            rows = rows[~candidate]
            if not len(rows):
                continue
            if centres is None and picked:
                own = pd.concat(picked)
                centres = pick_centres(_unit(_matrix(own["embedding"])), int(own["centres"].iat[0]))
            if centres is None or len(centres) < 2:
                near = np.full((len(rows), 1), -1)
            else:
                near = np.argsort(-(_unit(_matrix(rows["embedding"])) @ centres.T), axis=1, kind="stable")[:, :overlap]
            for k in range(near.shape[1]):
                yield pd.DataFrame({"node": rows["node"].to_numpy(), "cell": rows["cell"].to_numpy(), "centre": near[:, k]})


def _split(classes: DataFrame, overlap: int) -> DataFrame:
    """(node, cell) of every class; a vector is in its ``overlap`` nearest cells at
    the first split and in one less, but at least 2, at every later one."""
    spark = classes.sparkSession
    vectors = classes.select("node", "embedding")
    done = None
    members = stored(spark, classes.select("node", "cell"), "embedding-cells")
    level = 0
    while True:
        sizes = members.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
        large = sizes.where(F.col("size") > SHARD_ROWS)
        small = members.join(large, "cell", "left_anti")
        done = small if done is None else done.union(small)
        if large.isEmpty():
            return done
        centres = F.least(F.lit(CENTRES), F.ceil(F.col("size") / CENTRE_ROWS)).cast("int")
        rows = (
            members.join(large, "cell").join(vectors, "node")
            .withColumn("salts", F.ceil(F.col("size") / SALT_ROWS).cast("int"))
            .withColumn("centres", centres)
            .withColumn("chance", F.pmod(F.xxhash64("node", F.lit(level)), F.col("size")))
        )
        picks = (
            rows.where(F.col("chance") < 3 * F.col("centres"))
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
            .select("cell", "salt", F.col("chance").alias("rank"), "centres", "node", "embedding")
        )
        asked = rows.select(
            "cell", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"),
            F.lit(-1).cast("long").alias("rank"), "centres", "node", "embedding")
        dealt = (
            picks.union(asked).withColumn("first", F.col("rank") < 0)
            .repartition("cell", "salt").sortWithinPartitions("cell", "salt", "first", "rank", "node").drop("first")
        )
        own = overlap if level == 0 else max(2, overlap - 1)
        found = stored(spark, dealt.mapInPandas(
            lambda it, o=own: _assign(it, o), "node long, cell long, centre int"), "embedding-cells")
        # A cell without two centres is one dense group: it stays and is cut into parts.
        whole = found.where("centre < 0").select("node", "cell")
        below = found.where("centre >= 0").select(
            "node", F.xxhash64("cell", "centre").alias("child"), "cell")
        grown = below.groupBy("child", "cell").agg(F.count(F.lit(1)).alias("own")).join(sizes, "cell")
        # A child nearly as large as its cell would be split for ever.
        stuck = grown.where("own > 0.9 * size").select("child")
        children = below.select("node", F.col("child").alias("cell"))
        done = done.union(whole).union(children.join(stuck.withColumnRenamed("child", "cell"), "cell", "left_semi"))
        members = children.join(stuck.withColumnRenamed("child", "cell"), "cell", "left_anti")
        level += 1


def _usable(embedding) -> F.Column:
    finite = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(embedding.isNotNull() & finite & F.exists(embedding, lambda v: v != 0), F.lit(False))


def _dealt(classes: DataFrame, overlap: int, least: float) -> DataFrame:
    """Every pair of parts of a cell (``low``, ``high``) with its vectors and their graph."""
    spark = classes.sparkSession
    placed = stored(spark, _split(classes, overlap).distinct(), "embedding-placed")
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
    shards = (
        placed.join(sizes, "cell").withColumn("parts", F.ceil(F.col("size") / SHARD_ROWS).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .join(classes.select("node", "embedding", "copies"), "node")
    )
    graph = (
        shards.select("cell", "part", "node", "embedding").groupBy("cell", "part")
        .applyInPandas(_grapher(least), "node long, near array<long>, ends array<long>")
        .groupBy("node").agg(*[F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("near", "ends")])
    )
    cells = placed.groupBy("node").agg(F.sort_array(F.collect_list("cell")).alias("cells"))
    nodes = stored(spark, shards.join(graph, "node").join(cells, "node").select(
        "cell", "parts", "part", "node", "embedding", "copies", "near", "ends", "cells"), "embedding-graph")
    return _part_pairs(nodes.drop("ends")).withColumn("visits", F.lit(False)).unionByName(_visits(nodes, placed))


def _visits(nodes: DataFrame, placed: DataFrame) -> DataFrame:
    """The search of the united graph beyond a vector's own cells: it follows the edges of
    the vector's list that end within reach of a link into the cells of their ends, and
    is a query there."""
    spark = nodes.sparkSession
    own = nodes.dropDuplicates(["node"]).select("node", "embedding", "copies", "cells", "near", "ends")
    ends = own.select("node", "cells", F.explode("ends").alias("end"))
    doors = stored(spark, (
        ends.join(placed.select(F.col("node").alias("end"), "cell"), "end").where(~F.array_contains("cells", F.col("cell")))
        .select("node", "cell").distinct()
    ), "embedding-doors")
    parts = nodes.groupBy("cell").agg(F.max("parts").alias("parts"))
    return (
        doors.join(parts, "cell").join(own.drop("ends"), "node")
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("cell", "node", "embedding", "copies", "near", "cells",
                F.col("part").alias("low"), F.col("part").alias("high"), F.lit(-1).alias("part"), F.lit(True).alias("visits"))
        .select("cell", "part", "node", "embedding", "copies", "near", "cells", "low", "high", "visits")
    )


def _part_pairs(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumns({
        "low": F.least("part", "other"), "high": F.greatest("part", "other"),
    }).drop("other", "parts")


def _every_pair(classes: DataFrame) -> DataFrame:
    """Every pair of parts of a whole label: the exact way, whose work grows with the
    square of a label's vectors, in blocks of two parts."""
    sizes = stored(classes.sparkSession, classes.groupBy("cell").agg(F.count(F.lit(1)).alias("size")), "embedding-labels")
    nodes = (
        classes.join(sizes, "cell").withColumn("parts", F.ceil(F.col("size") / SHARD_ROWS).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .select("cell", "parts", "part", "node", "embedding", "copies", F.array("cell").alias("cells"), F.lit(False).alias("visits"))
    )
    return _part_pairs(nodes)


def _visited_links(found: DataFrame, classes: DataFrame) -> DataFrame:
    """What links found by visitors add to both ends. Both may have visited the other, and
    in several cells, so these pairs are made distinct first."""
    pairs = found.where("visited is not null").select(
        F.least("node", "visited").alias("a"), F.greatest("node", "visited").alias("b")).distinct()
    ends = pairs.select("a", "b").union(pairs.select("b", "a")).toDF("node", "other")
    copies = classes.select(F.col("node").alias("other"), F.col("copies").alias("links"))
    return ends.join(copies, "other").select("node", "links")


def near_vectors(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """Group near copies among ``vectors`` (vec_id: long, embedding: array, label).

    Returns one row per input row: vec_id, n_links (long, other vectors linked
    directly), component_id (smallest vec_id reachable by links), kept (vec_id =
    component_id), audited_recall (found links over true links of the audit's
    sample; 1.0 when that sample has no link) and audited_vector_recall (the same
    for each vector of the sample with a link, averaged). Linked are found pairs
    with the same label and dimension and a cosine of ``least`` or more.

    - A vector that is null, empty or zero, or holds a null or non-finite
      component, and one with a null label, link with nothing.
    - Identical vectors are linked with each other; each copy counts in n_links.
      Every row is a vector of its own, also where a vec_id repeats.
    - A null vec_id links with nothing: component_id is null, kept is true.
    - Other columns are not read. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    usable = _usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = stored(spark, (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                       F.col("embedding").cast("array<double>").alias("embedding"))
        .withColumn("usable", usable)
        # A class is known by 128 bits of hash and by a number of its own.
        .withColumns({"one": F.xxhash64("label", "embedding"), "two": F.xxhash64(F.lit(1), "label", "embedding")})
    ), "embedding-rows")
    classes = stored(spark, (
        rows.where("usable").groupBy("one", "two", "label", "embedding")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
        .withColumns({"cell": F.xxhash64("label", F.size("embedding")), "node": F.monotonically_increasing_id()})
    ), "embedding-classes")
    for widening in range(WIDENINGS + 2):
        exact = widening > WIDENINGS
        dealt = _every_pair(classes) if exact else _dealt(classes, OVERLAP + widening, least)
        found = stored(spark, dealt.groupBy("cell", "low", "high").applyInPandas(
            _linker(least, None if exact else BEAM << widening), "node long, links long, lowest long, visited long"), "embedding-links")
        links = found.select("node", "links").unionByName(_visited_links(found, classes)).groupBy("node").agg(
            F.sum("links").alias("links"))
        counted = stored(spark, classes.join(links, "node", "left").withColumn(
            "n_links", F.col("copies") - 1 + F.coalesce("links", F.lit(0))).drop("links"), "embedding-counts")
        recall, vector_recall = audit_recall(counted, least)
        if min(recall, vector_recall) >= TARGET:
            break
    grouped = components(found.select(F.col("node").alias("a"), F.col("lowest").alias("b")))
    known = counted.select("node", "one", "two", "rep", "n_links").join(grouped, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    smallest = stored(
        spark, known.groupBy("component").agg(F.min("rep").alias("component_id")), "embedding-components")
    known = known.join(smallest, "component").select("one", "two", "n_links", "component_id")
    linked = rows.where("usable").select("vec_id", "one", "two").join(known, ["one", "two"]).select(
        "vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id")
    alone = rows.where("not usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumns({
        "kept": F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)),
        "audited_recall": F.lit(recall),
        "audited_vector_recall": F.lit(vector_recall),
    })


def audit_recall(counted: DataFrame, least: float, queries: int = AUDIT_ROWS) -> tuple[float, float]:
    """Found links over true links of up to ``queries`` classes picked by a hash: of
    all their links, and the mean over the classes that have one.

    Every row is compared with the sample, a batch at a time in one product; the sample
    is bounded, so it is sent to all tasks, and only a count per query comes back.
    """
    spark = counted.sparkSession
    picked = counted.orderBy(F.xxhash64("node", F.lit(7)), "node").limit(queries).collect()
    sample = spark.sparkContext.broadcast(
        [(r["node"], r["label"], np.array(r["embedding"], dtype=np.float64)) for r in picked])

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        true = {q: 0 for q, _, _ in sample.value}
        asked: dict[tuple, tuple[list, np.ndarray]] = {}
        for q, label, vector in sample.value:
            asked.setdefault((label, len(vector)), ([], []))[0].append(q)
            asked[label, len(vector)][1].append(vector)
        for frame in frames:
            for (label, size), rows in frame.groupby([frame["label"], frame["embedding"].map(len)]):
                if (label, size) not in asked:
                    continue
                names, queries = asked[label, size]
                raw, queries = _matrix(rows["embedding"]), np.array(queries)
                near = _unit(raw) @ _unit(queries).T >= least - 1e-9
                to, q = np.nonzero(near & (rows["node"].to_numpy()[:, None] != np.array(names)[None, :]))
                sure = _exact(raw[to], queries[q]) >= least
                for i, n in zip(q[sure].tolist(), rows["copies"].to_numpy()[to[sure]].tolist()):
                    true[names[i]] += n
        yield pd.DataFrame({"node": list(true), "true": list(true.values())}, dtype=np.int64)

    true = {r["node"]: r["n"] for r in (
        counted.select("node", "label", "embedding", "copies").mapInPandas(count, "node long, true long")
        .groupBy("node").agg(F.sum("true").alias("n")).where("n > 0").collect()
    )}
    if not true:
        return 1.0, 1.0
    found = {r["node"]: r["n_links"] - (r["copies"] - 1) for r in picked if r["node"] in true}
    return sum(found.values()) / sum(true.values()), sum(found[q] / n for q, n in true.items()) / len(true)
