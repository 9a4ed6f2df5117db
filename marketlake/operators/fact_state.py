"""Hourly fact as mergeable state.

A batch of snapshots is reduced to partial aggregates per asset and hour. Partials of
any batches merge, in any order and grouping, into the partials of their union, so an
hour's fact never needs its snapshots again: a late batch only adds its partials. The
deviation is kept as count, mean and sum of squared deviations from that mean, which
merge pairwise without subtracting large sums of squares from each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.columns import processed_at, relative_volatility, spread
from marketlake.schema import BATCH_ID, FACT_KEYS, FACT_SCHEMA, PROCESSED_AT

#: Fact column -> the measure it is the mean of (the price's mean is in its moments).
MEANS = {
    "market_cap_medio": "market_cap",
    "volume_medio": "total_volume",
    "variacao_24h_media": "price_change_24h",
    "variacao_pct_24h_media": "price_change_percentage_24h",
}


def partial_facts(snapshots: DataFrame, keys: list[str] = FACT_KEYS) -> DataFrame:
    """Partial aggregates of ``snapshots`` per asset and hour (one hash aggregate)."""
    price = F.col("current_price")
    sums = [a for fact, of in MEANS.items() for a in (F.sum(of).alias(f"{fact}_sum"), F.count(of).alias(f"{fact}_n"))]
    return snapshots.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.struct(F.count(price).alias("n"), F.avg(price).alias("mean"),
                 (F.var_pop(price) * F.count(price)).alias("squares")).alias("moments"),
        F.min(price).alias("preco_min"), F.max(price).alias("preco_max"), *sums,
        F.max("high_24h").alias("high_24h"), F.min("low_24h").alias("low_24h"),
    )


def _merged_moments(one: Column, two: Column) -> Column:
    """Count, mean and squared deviations of the union of two groups."""
    n = one["n"] + two["n"]
    apart = two["mean"] - one["mean"]
    both = F.struct(
        n.alias("n"),
        (one["mean"] + apart * two["n"] / n).alias("mean"),
        (one["squares"] + two["squares"] + apart * apart * one["n"] * two["n"] / n).alias("squares"),
    )
    return F.when(one["n"] == 0, two).when(two["n"] == 0, one).otherwise(both)


def merge_facts(partials: DataFrame, keys: list[str] = FACT_KEYS) -> DataFrame:
    """Partials of the union of all groups in ``partials``, one row per asset and hour.

    What one group collects is a struct of three numbers per batch that holds the hour;
    they are folded in a fixed order, so the same partials always give the same bits."""
    moments = F.struct(F.col("moments.n").alias("n"), F.col("moments.mean").alias("mean"), F.col("moments.squares").alias("squares"))
    nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("mean"),
                       F.lit(None).cast("double").alias("squares"))
    sums = [F.sum(f"{fact}_{part}").alias(f"{fact}_{part}") for fact in MEANS for part in ("sum", "n")]
    return partials.groupBy(*keys).agg(
        F.sum("total_registros").alias("total_registros"),
        F.aggregate(F.array_sort(F.collect_list(moments)), nothing, _merged_moments).alias("moments"),
        F.min("preco_min").alias("preco_min"), F.max("preco_max").alias("preco_max"), *sums,
        F.max("high_24h").alias("high_24h"), F.min("low_24h").alias("low_24h"),
    )


def fact_of_partials(partials: DataFrame, clock: Column | None = None) -> DataFrame:
    """Fact rows (``FACT_SCHEMA``) of merged partials, one row per asset and hour."""
    n = F.col("moments.n")
    means = {fact: F.try_divide(F.col(f"{fact}_sum"), F.col(f"{fact}_n")) for fact in MEANS}
    return (
        partials.withColumns({
            "preco_medio": F.col("moments.mean"),
            "preco_desvio": F.when(n > 1, F.sqrt(F.col("moments.squares") / (n - 1))), **means,
        })
        .withColumn("spread_24h", spread("high_24h", "low_24h"))
        .withColumn("volatilidade_relativa", relative_volatility("preco_desvio", "preco_medio"))
        .withColumn(PROCESSED_AT, processed_at(clock))
        .select(*FACT_SCHEMA.fieldNames())
    )


def with_batch(partials: DataFrame, batch_id: int) -> DataFrame:
    return partials.withColumn(BATCH_ID, F.lit(int(batch_id)).cast("long"))
