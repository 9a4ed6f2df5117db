"""Serving queries over the Gold tables (the dashboard's views).

Each view is a DataFrame; only the few result rows are ever collected by the
caller. Top-N plans as TakeOrderedAndProject (per-partition top-N, then a
merge of N rows per partition), never a full sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.columns import spread
from marketlake.schema import SPREAD_TOP, TOP_N_DEFAULT


def current_snapshot(dim: DataFrame, as_of: str | None = None) -> DataFrame:
    """The dimension rows of one day: ``as_of`` or, by default, the latest day
    present. The latest day is a one-row global aggregate, so broadcasting it
    for the semi-join has a proven size of one row. Both sides start from the
    same ``dt is not null`` frame (the join drops null days and ``max`` ignores
    them anyway), so they plan the same subtree and its shuffle is reused."""
    if as_of is not None:
        return dim.filter(F.col("dt") == F.to_date(F.lit(as_of)))
    days = dim.filter(F.col("dt").isNotNull())
    latest = days.agg(F.max("dt").alias("dt"))
    return days.join(F.broadcast(latest), on="dt", how="left_semi")


def top_n(dim: DataFrame, n: int = TOP_N_DEFAULT) -> DataFrame:
    """N best-ranked assets; null ranks last, ties by id."""
    if n < 1:
        raise ValueError("n must be positive")
    return dim.orderBy(F.col("market_cap_rank").asc_nulls_last(), F.col("id").asc()).limit(n)


def kpis(dim: DataFrame) -> DataFrame:
    """Assets tracked, total market cap, total 24 h volume, largest 24 h move."""
    return dim.agg(
        F.count(F.lit(1)).alias("moedas_rastreadas"),
        F.sum("market_cap").alias("market_cap_total"),
        F.sum("total_volume").alias("volume_24h_total"),
        F.max("price_change_percentage_24h").alias("maior_variacao_24h"),
    )


def market_cap_view(top: DataFrame) -> DataFrame:
    """Top-N bars ordered by market cap (ascending), coloured by 24 h change."""
    return top.select("id", "symbol", "name", "market_cap", "price_change_percentage_24h").orderBy(
        F.col("market_cap").asc(), F.col("id").asc()
    )


def variation_view(top: DataFrame) -> DataFrame:
    """Top-N bars ordered by 24 h change."""
    return top.select("id", "symbol", "price_change_percentage_24h").orderBy(
        F.col("price_change_percentage_24h").asc(), F.col("id").asc()
    )


def top_spread(top: DataFrame, k: int = SPREAD_TOP) -> DataFrame:
    """Within the top-N: widest 24 h high-low spread first, first ``k``."""
    return (
        top.select("id", "symbol", spread("high_24h", "low_24h").alias("spread_24h"))
        .orderBy(F.col("spread_24h").desc_nulls_last(), F.col("id").asc())
        .limit(k)
    )


def symbols(fact: DataFrame) -> DataFrame:
    """Distinct symbols in sort order (the series selector)."""
    return fact.select("symbol").distinct().orderBy("symbol")


_SERIES = {
    "price": ["preco_medio", "preco_max", "preco_min"],
    "volume": ["volume_medio"],
    "volatility": ["volatilidade_relativa"],
}


def hourly_series(fact: DataFrame, symbol: str, measure: str = "price") -> DataFrame:
    """Hourly series of one symbol, ordered by (dt, hour). Symbol is not a key,
    so ``id`` is carried and several assets may share the series."""
    cols = _SERIES[measure]
    return (
        fact.filter(F.col("symbol") == F.lit(symbol))
        .select("id", "symbol", "dt", "hour", *cols)
        .orderBy("dt", "hour", "id")
    )


def default_series(fact: DataFrame, measure: str = "price") -> DataFrame:
    """Series of the first symbol in sort order (the selector's default). The
    minimum symbol is a one-row aggregate, broadcast for the semi-join."""
    first = fact.agg(F.min("symbol").alias("symbol"))
    cols = _SERIES[measure]
    return (
        fact.join(F.broadcast(first), on="symbol", how="left_semi")
        .select("id", "symbol", "dt", "hour", *cols)
        .orderBy("dt", "hour", "id")
    )
