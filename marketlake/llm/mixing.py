"""Mixing sources to target weights: temperature and budgeted block permutations.

Source i with T_i tokens gets the weight T_i^a / sum T_j^a. The exponent a lies
between 0 (all sources alike) and 1 (as found); it is bisected until the
weights reach a target entropy, and raised again if the least source would
repeat more often than a limit. Weights become token budgets, and a budget is
spent in passes over the source: each pass is a new permutation of the source's
blocks, and of the documents inside each block; the last pass ends where the
budget does.

A source may hold a third of all rows, so no task ever sees a whole source:
documents are dealt into blocks by a hash, budgets are spent on the table of
block totals, and only the one block in which a budget ends is cut by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import SPACES, stored

#: Tokens of a block on average.
BLOCK_TOKENS = 200_000
#: Block keys are summed up in 2**RANGE_BITS ranges.
RANGE_BITS = 12
#: Points between the bounds that one pass of the bisection evaluates, and passes:
#: 12 passes narrow the exponent to 16**-12.
POINTS, PASSES = 15, 12


def token_count(text: Column) -> Column:
    """White-space separated words; a null text has none."""
    ones = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * (len(SPACES) - 1))
    return F.size(F.filter(F.split(ones, " "), lambda w: w != "")).cast("long")


def _shuffle_key(*parts: Column | str) -> Column:
    return F.xxhash64(*parts)


def _entropy(a: float) -> Column:
    # With u = T^a and S = sum u: H = ln S - sum(u ln u) / S.
    u = F.pow(F.col("tokens").cast("double"), F.lit(a))
    total = F.sum(u)
    return F.ln(total) - F.sum(u * F.ln(u)) / total


def _most_passes(a: float) -> Column:
    # Budgets scaled so that the largest source is passed over once.
    return F.pow(F.max("tokens") / F.min("tokens"), F.lit(1.0 - a))


def _bisect(sources: DataFrame, value, fits, low: float, high: float) -> float:
    """The boundary in [low, high]: ``fits`` holds up to it. Every pass evaluates
    ``POINTS`` exponents in one aggregate over the sources."""
    for _ in range(PASSES):
        points = [low + (high - low) * (k + 1) / (POINTS + 1) for k in range(POINTS)]
        row = sources.agg(*[value(a).alias(f"v{k}") for k, a in enumerate(points)]).first()
        good = [fits(row[f"v{k}"]) for k in range(POINTS)]
        k = good.index(False) if False in good else POINTS
        low, high = (points[k - 1] if k else low), (points[k] if k < POINTS else high)
    return low


def exponent(sources: DataFrame, entropy_share: float, repetition_limit: float) -> float:
    """The exponent for sources (tokens > 0): the largest with an entropy of at
    least ``entropy_share`` times that of equal weights, or, if larger, the
    smallest at which no source takes more than ``repetition_limit`` passes."""
    if sources.isEmpty():
        return 1.0
    goal = sources.agg(F.ln(F.count(F.lit(1)))).first()[0] * entropy_share
    as_found = sources.agg(_entropy(1.0)).first()[0]
    a = 1.0 if as_found >= goal else _bisect(sources, _entropy, lambda h: h >= goal, 0.0, 1.0)
    if sources.agg(_most_passes(a)).first()[0] > repetition_limit:
        a = 1.0 - _bisect(
            sources, lambda b: _most_passes(1.0 - b), lambda r: r <= repetition_limit, 0.0, 1.0 - a)
    return a


def _documents(docs: DataFrame) -> DataFrame:
    """(source, doc_id, sum, copy, tokens): repeated rows are told apart by ``copy``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("source", "doc_id", F.xxhash64(text).alias("sum"), token_count(F.col("text")).alias("tokens"))
    return (
        rows.groupBy("source", "doc_id", "sum", "tokens").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).drop("n")
    )


def mix(docs: DataFrame, entropy_share: float = 0.95, repetition_limit: float = 2.0, seed: int = 17) -> DataFrame:
    """Where every document stands in the mixture of ``docs`` (doc_id, text, source).

    Returns one row per placement: source, doc_id, sum (hash of the text), copy,
    tokens, pass (0, 1, ...), block (place of the block in the pass), slot (place
    in the block), weight (of the source). Budgets are scaled so that the source
    with the fewest passes is passed over exactly once: no document is left out,
    and under-represented sources are repeated.

    - The order of blocks and documents in a pass depends on ``seed``, the pass
      and the row alone.
    - The last pass of a source takes whole blocks while they fit the budget and
      then documents of the next block while they fit.
    - A null source is a source of its own. Sources without any token have weight
      0 and one pass. Repeated rows are placed one by one. An empty table gives
      an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = stored(spark, _documents(docs), "mix-documents")
    sources = stored(spark, rows.groupBy("source").agg(
        F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")), "mix-sources")
    a = exponent(sources.where("tokens > 0"), entropy_share, repetition_limit)
    whole = sources.where("tokens > 0").agg(
        F.sum(F.pow(F.col("tokens").cast("double"), F.lit(a))).alias("u"), F.max("tokens").alias("top")).first()
    scale, top = whole["u"] or 1.0, float(whole["top"] or 1.0)
    budgets = stored(spark, sources.select(
        F.col("source").alias("of"),
        F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(a)) / scale).otherwise(0.0).alias("weight"),
        F.greatest(F.lit(1), F.ceil(F.greatest(F.col("tokens") / BLOCK_TOKENS, F.col("rows") / BLOCK_TOKENS))).alias("blocks"),
        # Passes are (top / T)^(1 - a); the budget is that many times T.
        F.when(F.col("tokens") > 0, F.pow(F.lit(top) / F.col("tokens"), F.lit(1.0 - a))).otherwise(1.0).alias("passes"),
        F.col("tokens").alias("total"),
    ).withColumns({
        "full": F.floor(F.col("passes") + 1e-9),
        "left": F.floor((F.col("passes") - F.floor(F.col("passes") + 1e-9)) * F.col("total")),
    }), "mix-budgets")
    placed = stored(spark, (
        rows.join(budgets, F.col("source").eqNullSafe(F.col("of"))).drop("of")
        .withColumn("part", F.pmod(_shuffle_key("doc_id", "sum", "copy", F.lit(seed)), F.col("blocks")))
        .select("source", "doc_id", "sum", "copy", "tokens", "weight", "full", "left", "part")
    ), "mix-parts")
    totals = placed.groupBy("source", "part").agg(
        F.sum("tokens").alias("size"), F.first("full").alias("full"), F.first("left").alias("left"))
    # A pass is a permutation of the blocks. What it has spent before a block is summed
    # in two levels, by ranges of the block's key, so no task orders a whole source.
    blocks = stored(spark, (
        totals.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full"))))
        .withColumn("key", _shuffle_key("source", "part", "pass", F.lit(seed)))
        .withColumn("range", F.shiftright("key", 64 - RANGE_BITS))
    ), "mix-blocks")
    earlier = Window.partitionBy("source", "pass").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = stored(spark, (
        blocks.groupBy("source", "pass", "range").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        .select(F.col("source").alias("of"), F.col("pass").alias("of_pass"), F.col("range").alias("of_range"),
                F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"),
                F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("spent"))
    ), "mix-ranges")
    order = Window.partitionBy("source", "pass", "range").orderBy("key", "part")
    passes = (
        blocks.join(ranges, F.col("source").eqNullSafe(F.col("of")) & (F.col("pass") == F.col("of_pass"))
                    & (F.col("range") == F.col("of_range")))
        .withColumn("block", F.col("first") + F.row_number().over(order) - 1)
        .withColumn("before", F.col("spent") + F.coalesce(
            F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("room", F.when(F.col("pass") < F.col("full"), F.col("size")).otherwise(F.col("left") - F.col("before")))
        .where((F.col("pass") < F.col("full")) | (F.col("room") > 0))
        .select("of", F.col("part").alias("in"), "pass", "block", "room")
    )
    inside = Window.partitionBy("source", "pass", "part").orderBy("key", "doc_id", "sum", "copy")
    return (
        placed.drop("full", "left")
        .join(stored(spark, passes, "mix-passes"),
              F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in")))
        .withColumn("key", _shuffle_key("doc_id", "sum", "copy", "pass", F.lit(seed)))
        .withColumn("slot", F.row_number().over(inside) - 1)
        .withColumn("spent", F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .where(F.col("spent") <= F.col("room"))
        .select("source", "doc_id", "sum", "copy", "tokens", F.col("pass").cast("int").alias("pass"),
                F.col("block").cast("long").alias("block"), F.col("slot").cast("long").alias("slot"), "weight")
    )


def mixed_documents(docs: DataFrame, entropy_share: float = 0.95, repetition_limit: float = 2.0) -> DataFrame:
    """``docs`` with every document as often as the mixture places it, all columns
    kept. Rows that repeat source, doc_id and text together appear as often as all of
    them are placed: each its even share, the first ones once more where it leaves a
    remainder."""
    spark = docs.sparkSession
    key = ["_x_source", "_x_id", "_x_sum"]
    times = stored(spark, (
        mix(docs, entropy_share, repetition_limit)
        .groupBy(F.col("source").alias("_x_source"), F.col("doc_id").alias("_x_id"), F.col("sum").alias("_x_sum"))
        .agg(F.count(F.lit(1)).alias("_x_placed"), F.countDistinct("copy").alias("_x_rows"))
    ), "mix-times")
    text = F.coalesce(F.col("text"), F.lit(""))
    columns = [docs[c] for c in docs.columns]
    same = docs["source"].eqNullSafe(F.col("_x_source")) & docs["doc_id"].eqNullSafe(F.col("_x_id")) & (
        F.xxhash64(text) == F.col("_x_sum"))
    single = (
        docs.join(times.where("_x_rows = 1"), same)
        .withColumn("_x_at", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_x_placed")))).select(*columns)
    )
    # Equal rows are numbered where they were written, task by task, so that many of
    # them are not one task's.
    names = [f"_x_c{i}" for i in range(len(docs.columns))]
    repeated = stored(spark, docs.join(times.where("_x_rows > 1"), same).select(
        *[c.alias(n) for c, n in zip(columns, names)], *key, "_x_placed", "_x_rows",
        F.monotonically_increasing_id().alias("_x_at")), "mix-repeated").withColumn(
        "_x_task", F.shiftrightunsigned("_x_at", 33))
    earlier = Window.partitionBy(*key).orderBy("_x_task").rowsBetween(Window.unboundedPreceding, -1)
    begun = stored(spark, repeated.groupBy(*key, "_x_task").agg(F.count(F.lit(1)).alias("c")).select(
        *[F.col(k).alias(f"{k}_") for k in [*key, "_x_task"]], F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("_x_before")),
        "mix-begun")
    number = F.row_number().over(Window.partitionBy(*key, "_x_task").orderBy("_x_at")) - 1 + F.col("_x_before")
    share = F.floor(F.col("_x_placed") / F.col("_x_rows")) + F.when(number < F.col("_x_placed") % F.col("_x_rows"), 1).otherwise(0)
    on = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in [*key, "_x_task"]]
    dealt = (
        repeated.join(begun, on[0] & on[1] & on[2] & on[3]).withColumn("_x_share", share).where("_x_share > 0")
        .withColumn("_x_at", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_x_share"))))
        .select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
    )
    return single.unionByName(dealt)
