"""Scalar column logic shared by the layers.

Everything is expressed with ``pyspark.sql.functions`` so it stays inside
whole-stage codegen. ANSI mode stays on: malformed text becomes null through
``try_cast`` / ``try_to_timestamp`` instead of failing the job.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, TimestampNTZType, TimestampType

from marketlake.schema import MEASURES, PROCESSED_AT

NULL_POLICIES = ("zero", "keep")


def fill_nulls(df: DataFrame, policy: str = "zero") -> DataFrame:
    """Null / absent measures -> 0.0 (``policy="zero"``, the stream path) or
    left as they are (``"keep"``, the batch collector). The rank is never filled."""
    if policy not in NULL_POLICIES:
        raise ValueError(f"null policy must be one of {NULL_POLICIES}, got {policy!r}")
    if policy == "keep":
        return df
    present = [c for c in MEASURES if c in df.columns]
    return df.withColumns(
        {c: F.coalesce(F.col(c).try_cast(DoubleType()), F.lit(0.0)) for c in present}
    )


def _to_timestamp(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, TimestampType):
        return F.col(name)
    if isinstance(dtype, StringType):
        return F.try_to_timestamp(F.col(name))
    return F.col(name).try_cast(TimestampType())


def enforce_types(df: DataFrame, clock: Column | None = None) -> DataFrame:
    """Silver typing: the 7 measures to double, rank to int, ``ingestion_ts`` to a
    timestamp, plus the processing-time column. One projection, so Catalyst has
    a single Project to fuse with the scan."""
    typed = {c: F.col(c).try_cast(DoubleType()) for c in MEASURES if c in df.columns}
    if "market_cap_rank" in df.columns:
        typed["market_cap_rank"] = F.col("market_cap_rank").try_cast(IntegerType())
    if "ingestion_ts" in df.columns:
        typed["ingestion_ts"] = _to_timestamp(df, "ingestion_ts")
    typed[PROCESSED_AT] = processed_at(clock)
    return df.withColumns(typed)


def processed_at(clock: Column | _dt.datetime | None = None) -> Column:
    """Processing-time column; a fixed clock can be injected for reproducible runs."""
    if clock is None:
        return F.current_timestamp()
    if isinstance(clock, Column):
        return clock.cast(TimestampType())
    return F.lit(clock).cast(TimestampType())


def ingestion_metadata(df: DataFrame, ts_col: str = "ingestion_ts") -> DataFrame:
    """Attach ``ingestion_ts`` (now, when absent) and derive ``dt`` / ``hour``
    from it, so a snapshot never straddles its own partition."""
    if ts_col not in df.columns:
        df = df.withColumn(ts_col, F.current_timestamp())
    elif isinstance(df.schema[ts_col].dataType, (TimestampNTZType, StringType)):
        df = df.withColumn(ts_col, _to_timestamp(df, ts_col) if isinstance(
            df.schema[ts_col].dataType, StringType) else F.col(ts_col).cast(TimestampType()))
    return df.withColumns({
        "dt": F.to_date(F.col(ts_col)),
        "hour": F.hour(F.col(ts_col)).cast(IntegerType()),
    })


def spread(high: str | Column = "high_24h", low: str | Column = "low_24h") -> Column:
    """High minus low of the 24 h window."""
    high = F.col(high) if isinstance(high, str) else high
    low = F.col(low) if isinstance(low, str) else low
    return high - low


def relative_volatility(sd: str | Column = "preco_desvio", mean: str | Column = "preco_medio") -> Column:
    """Standard deviation as a percentage of the mean. A mean that is not
    positive (or null) gives 0; a single observation (null deviation) gives null.
    The guard also keeps ANSI mode from raising on a zero mean."""
    sd = F.col(sd) if isinstance(sd, str) else sd
    mean = F.col(mean) if isinstance(mean, str) else mean
    return F.when(mean > 0, sd / mean * F.lit(100.0)).otherwise(F.lit(0.0))


def is_sunday(day: str | Column) -> Column:
    """Weekly maintenance day (``weekday``: Monday = 0 ... Sunday = 6)."""
    day = F.col(day) if isinstance(day, str) else day
    return F.weekday(day) == 6


def retention_cutoff(now: _dt.datetime | Column | None = None, days: int = 7) -> Column:
    """``now - days`` as a timestamp literal / expression for use in predicates."""
    if now is None:
        base = F.current_timestamp()
    elif isinstance(now, Column):
        base = now.cast(TimestampType())
    else:
        base = F.lit(now).cast(TimestampType())
    return base - F.make_interval(days=F.lit(int(days)))
