"""Data quality: rule violations and layer counts, each in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.schema import MEASURES


def _rules() -> dict[str, Column]:
    """The rules that a snapshot is held against."""
    price, high, low = F.col("current_price"), F.col("high_24h"), F.col("low_24h")
    return {
        "no_id": F.col("id").isNull(),
        "no_time": F.col("ingestion_ts").isNull(),
        "no_rank": F.col("market_cap_rank").isNull(),
        "no_measure": F.greatest(*[F.col(c).isNull() for c in MEASURES]),
        "no_price": price.isNull(),
        "price_not_positive": price <= 0,
        "high_below_low": high < low,
        "price_outside_range": (price > high) | (price < low),
    }


def rule_counts(snapshots: DataFrame) -> DataFrame:
    """Violations by rule and day, by rule, by day and in all, from one scan.

    Every snapshot becomes one row for each rule it violates and one row ``(rows)``,
    which are counted under the grouping sets (rule, dt) and (rule). Returns level
    (``day`` or ``total``), dt (null at level total), rule, rows (violating, or all for
    the rule ``(rows)``) and share of the rows. A rule that cannot be decided because of
    a null is not violated. Rules without violations have no row."""
    broken = F.filter(
        F.array(F.lit("(rows)"), *[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in _rules().items()]),
        lambda n: n.isNotNull())
    exploded = snapshots.select("dt", F.explode(broken).alias("rule"))
    counts = (
        exploded.groupingSets([["rule", "dt"], ["rule"]], "rule", "dt")
        .agg(F.count(F.lit(1)).alias("rows"), F.grouping("dt").alias("all_days"))
    )
    # Day and total rows of one level meet in one group: a handful per day, so the share
    # needs no join.
    found = F.collect_list(F.struct("rule", "rows"))
    by_level = counts.groupBy("all_days", "dt").agg(
        found.alias("found"), F.max(F.when(F.col("rule") == "(rows)", F.col("rows"))).alias("all_rows"))
    return by_level.select(
        F.when(F.col("all_days") == 1, "total").otherwise("day").alias("level"), "dt", "all_rows", F.explode("found").alias("f")
    ).select("level", "dt", F.col("f.rule").alias("rule"), F.col("f.rows").alias("rows"),
             (F.col("f.rows") / F.col("all_rows")).alias("share"))


def layer_counts(snapshots: DataFrame) -> DataFrame:
    """Rows that the layers hold for ``snapshots``: bronze (all), silver (asset and hour),
    fact (one row per Silver row) and dimension (asset and day), from one scan.

    The keys of the layers are nested, so each is counted on the groups of the one below
    it: the counts of an asset-hour, then of an asset-day, then of all."""
    hours = snapshots.groupBy("id", "dt", "hour").agg(F.count(F.lit(1)).alias("bronze"))
    days = hours.groupBy("id", "dt").agg(F.sum("bronze").alias("bronze"), F.count(F.lit(1)).alias("silver"))
    one = days.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("bronze", "silver")], F.count(F.lit(1)).alias("dimension"))
    layers = [("bronze", "bronze"), ("silver", "silver"), ("fact", "silver"), ("dimension", "dimension")]
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("layer"), F.col(c).alias("rows")) for n, c in layers])).alias("l")).select("l.*")
