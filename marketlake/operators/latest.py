"""Latest row per key (top-1 per group).

Written as ``row_number() = 1`` over a window: Spark plans it with a partial
WindowGroupLimit *before* the shuffle, so every map task forwards at most one
row per key. A hot key therefore costs one row per map task in the exchange,
not its full size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RN = "_rn"


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str = "ingestion_ts",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row with the greatest ``order_col`` per ``keys`` (nulls last).

    Rows tied on ``order_col`` are resolved by ``tie_break`` (descending, nulls
    last); by default every remaining column, so the result is deterministic.
    """
    keys = list(keys)
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys and c != order_col]
    order = [F.col(order_col).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tie_break]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
