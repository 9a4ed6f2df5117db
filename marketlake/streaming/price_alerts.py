"""Large-move alerts on a stream of snapshots.

The state of an asset is its last time and price and the run it is in, so a move is
found when its snapshot arrives, however far apart two snapshots are. Each micro-batch
sorts an asset's new rows, compares each with the one before it, and gives out one row
per large move with the run it belongs to. Rows older than what the state has seen
cannot be put back in order; they are given out as late and change nothing.

A micro-batch writes its alerts under its own ``batch_id``, so a replay replaces them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from marketlake.operators.alerts import LARGE_MOVE
from marketlake.schema import BATCH_ID, TRIGGER_INTERVAL
from marketlake.session import path_exists
from marketlake.sinks.writers import publish
from marketlake.streaming.bronze_ingest import claim_bronze_path

ALERT_SCHEMA = (
    "id string, ingestion_ts timestamp, current_price double, previous_price double, pct double, "
    "run_started_at timestamp, run_length long, late boolean, batch_id long")
_ROW = ("id string, at long, current_price double, previous_price double, pct double, run_started long, run_length long, "
        "late boolean")
_STATE = "at long, price double, run_started long, run_length long"


def _move_finder(threshold: float) -> Callable:
    def find(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts)).sort_values(["at", "current_price"], kind="stable")
        at, price = rows["at"].to_numpy(), rows["current_price"].to_numpy()
        last, held, started, length = state.get if state.exists else (None, None, None, 0)
        old = np.zeros(len(at), bool) if last is None else (at < last) | ((at == last) & (price < held))
        late = pd.DataFrame({"at": at[old], "current_price": price[old]})
        at, price = at[~old], price[~old]
        before = np.r_[np.nan if held is None else held, price[:-1]]
        with np.errstate(divide="ignore", invalid="ignore"):
            pct = np.where(before > 0, (price / before - 1.0) * 100.0, np.nan)
            large = np.abs(pct) >= threshold
        # The place of the last quiet row before each one; -1: the run came in with the state.
        place = np.arange(len(at))
        quiet = np.maximum.accumulate(np.where(large, -1, place)) if len(at) else place
        carried = (quiet < 0) & (length > 0)
        run_length = place - quiet + np.where(carried, length, 0)
        run_started = np.where(carried, started if length else 0, at[np.minimum(quiet + 1, len(at) - 1)] if len(at) else at)
        if len(at):
            if large[-1]:
                state.update((int(at[-1]), float(price[-1]), int(run_started[-1]), int(run_length[-1])))
            else:
                state.update((int(at[-1]), float(price[-1]), 0, 0))
        alerts = pd.DataFrame({
            "at": at[large], "current_price": price[large], "previous_price": before[large], "pct": pct[large],
            "run_started": run_started[large], "run_length": run_length[large]})
        out = pd.concat([alerts.assign(late=False), late.assign(late=True)])
        out.insert(0, "id", key[0])
        for c in ("run_started", "run_length"):
            out[c] = out[c].astype("Int64")
        yield out[["id", "at", "current_price", "previous_price", "pct", "run_started", "run_length", "late"]]

    return find


def large_moves(snapshots: DataFrame, threshold: float = LARGE_MOVE) -> DataFrame:
    """Alerts of a stream of snapshots (id, ingestion_ts, current_price), for output mode
    ``append``. Rows without one of the three are left out."""
    seen = snapshots.select("id", F.unix_micros("ingestion_ts").alias("at"), "current_price").dropna()
    found = seen.groupBy("id").applyInPandasWithState(
        _move_finder(threshold), _ROW, _STATE, "append", GroupStateTimeout.NoTimeout)
    return found.select(
        "id", F.timestamp_micros("at").alias("ingestion_ts"), "current_price", "previous_price", "pct",
        F.timestamp_micros("run_started").alias("run_started_at"), "run_length", "late")


def start_alert_stream(
    snapshots: DataFrame, path: str, checkpoint: str, threshold: float = LARGE_MOVE, available_now: bool = False,
    interval: str = TRIGGER_INTERVAL,
) -> StreamingQuery:
    """Write the alerts of a stream to ``path`` (``batch_id`` partitions)."""
    if not checkpoint:
        raise ValueError("a checkpoint location is required: it holds the state")

    def process(batch: DataFrame, batch_id: int) -> None:
        publish(batch.withColumn(BATCH_ID, F.lit(int(batch_id)).cast("long")), path, (BATCH_ID,), mode="dynamic")

    claim_bronze_path(snapshots.sparkSession, path, checkpoint)
    writer = large_moves(snapshots, threshold).writeStream.outputMode("append").foreachBatch(process).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], ALERT_SCHEMA)
    return spark.read.schema(ALERT_SCHEMA).parquet(path)


def runs_of_alerts(alerts: DataFrame) -> DataFrame:
    """The runs that alerts belong to, as ``operators.alert_runs`` gives them."""
    return alerts.where("not late").groupBy("id", F.col("run_started_at").alias("started_at")).agg(
        F.max("ingestion_ts").alias("ended_at"), F.max("run_length").alias("length"), F.max(F.abs("pct")).alias("extreme_pct"))
