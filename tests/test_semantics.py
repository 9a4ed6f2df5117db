"""Unit tests on tiny literal frames for the pipeline's semantic decisions."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from marketlake.functions.columns import (
    enforce_types,
    fill_nulls,
    ingestion_metadata,
    is_sunday,
    relative_volatility,
    retention_cutoff,
)
from marketlake.operators import maintenance, serving
from marketlake.operators.gold import daily_dimension, hourly_fact
from marketlake.operators.latest import latest_per_key
from marketlake.operators.silver import silver_from_bronze
from marketlake.plans.jobs import LayerPaths, run_day, run_gold, run_silver, run_vacuum
from marketlake.schema import BRONZE_SCHEMA, FACT_TABLE, PAYLOAD_SCHEMA, SILVER_SCHEMA, SILVER_TABLE
from marketlake.sinks.writers import append_bronze, compact, publish
from marketlake.sources.bronze import explode_pages, read_bronze
from marketlake.sources.tables import read_table
from marketlake.streaming.bronze_ingest import bronze_batch_writer, prepare_bronze, start_bronze_stream

T0 = dt.datetime(2024, 1, 14, 10, 15, 0)


def snap(i="a", price=1.0, ts=T0, rank=1, sym=None, **kw):
    p = 1.0 if price is None else price
    row = dict(id=i, symbol=sym or i.upper(), name=f"Asset {i}", current_price=price,
               market_cap=p * 10, total_volume=5.0, price_change_24h=0.1,
               price_change_percentage_24h=1.0, market_cap_rank=rank, high_24h=p * 1.1,
               low_24h=p * 0.9, ingestion_ts=ts)
    row.update(kw)
    return row


TICK_SCHEMA = StructType(PAYLOAD_SCHEMA.fields + [StructField("ingestion_ts", TimestampType())])


def frame(spark, rows, with_partitions=True):
    schema = TICK_SCHEMA
    df = spark.createDataFrame([tuple(r[f] for f in schema.fieldNames()) for r in rows], schema)
    return ingestion_metadata(df) if with_partitions else df


# --- D2 / D5: degenerate and guarded statistics ------------------------------

def test_single_row_group_has_null_deviation_and_volatility(spark):
    out = hourly_fact(frame(spark, [snap()])).first()
    assert out.total_registros == 1
    assert out.preco_desvio is None
    assert out.volatilidade_relativa is None
    assert out.preco_min == out.preco_max == out.preco_medio == 1.0


def test_volatility_zero_when_mean_not_positive(spark):
    rows = [snap(price=-1.0), snap(price=-3.0, ts=T0 + dt.timedelta(minutes=1))]
    out = hourly_fact(frame(spark, rows)).first()
    assert out.preco_desvio > 0
    assert out.volatilidade_relativa == 0.0
    df = spark.createDataFrame([(None, None), (0.0, 0.0), (2.0, 1.0)], "m double, s double")
    got = [r.v for r in df.select(relative_volatility("s", "m").alias("v")).collect()]
    assert got == [0.0, 0.0, 50.0]


def test_fact_statistics(spark):
    rows = [snap(price=p, ts=T0 + dt.timedelta(minutes=k)) for k, p in enumerate([1.0, 2.0, 3.0])]
    out = hourly_fact(frame(spark, rows)).first()
    assert out.total_registros == 3
    assert out.preco_medio == pytest.approx(2.0)
    assert out.preco_desvio == pytest.approx(1.0)
    assert out.volatilidade_relativa == pytest.approx(50.0)
    assert out.spread_24h == pytest.approx(3.3 - 0.9)


# --- D6: latest row, nulls last, deterministic ties --------------------------

def test_latest_prefers_newest_and_puts_null_time_last(spark):
    rows = [snap(price=1.0, ts=None), snap(price=2.0, ts=T0), snap(price=3.0, ts=T0 - dt.timedelta(minutes=5))]
    df = frame(spark, rows, with_partitions=False)
    got = latest_per_key(df, ["id"]).collect()
    assert [r.current_price for r in got] == [2.0]


def test_ties_resolved_the_same_way_whatever_the_input_order(spark):
    rows = [snap(price=1.0), snap(price=5.0), snap(price=3.0)]
    a = latest_per_key(frame(spark, rows), ["id", "dt", "hour"]).first().current_price
    b = latest_per_key(frame(spark, rows[::-1]), ["id", "dt", "hour"]).first().current_price
    assert a == b == 5.0


def test_silver_is_one_row_per_asset_hour(spark):
    rows = [snap(ts=T0 + dt.timedelta(minutes=k), price=float(k)) for k in range(5)]
    rows += [snap(i="b", ts=T0 + dt.timedelta(hours=1))]
    silver = silver_from_bronze(frame(spark, rows)).collect()
    assert len(silver) == 2
    assert {r.id: r.current_price for r in silver}["a"] == 4.0


# --- D4: malformed text does not fail under ANSI -----------------------------

def test_malformed_numbers_and_times_become_null(spark):
    df = spark.createDataFrame(
        [("x", "abc", "7", "2024-01-01 10:00:00"), ("y", "1.5", "n/a", "not a time")],
        "id string, current_price string, market_cap_rank string, ingestion_ts string")
    got = {r.id: r for r in enforce_types(df).collect()}
    assert got["x"].current_price is None and got["x"].market_cap_rank == 7
    assert got["y"].current_price == 1.5 and got["y"].market_cap_rank is None
    assert got["y"].ingestion_ts is None
    assert got["x"].ingestion_ts == dt.datetime(2024, 1, 1, 10, 0)


# --- D3: null policy ---------------------------------------------------------

def test_null_policy_zero_fills_measures_not_rank(spark):
    df = frame(spark, [snap(price=None, rank=None, total_volume=None)], with_partitions=False)
    z = fill_nulls(df, "zero").first()
    assert z.current_price == 0.0 and z.total_volume == 0.0 and z.market_cap_rank is None
    k = fill_nulls(df, "keep").first()
    assert k.current_price is None
    with pytest.raises(ValueError):
        fill_nulls(df, "drop")


# --- D7: partitions derived from the snapshot time ---------------------------

def test_dt_and_hour_come_from_ingestion_ts(spark):
    ts = dt.datetime(2024, 1, 31, 23, 59, 59, 999000)
    r = ingestion_metadata(frame(spark, [snap(ts=ts)], with_partitions=False)).first()
    assert (r.dt, r.hour) == (dt.date(2024, 1, 31), 23)


# --- S2 / P1: page parsing ---------------------------------------------------

def test_pages_extra_keys_missing_keys_and_malformed(spark):
    good = json.dumps([{"id": "a", "symbol": "A", "current_price": 2.5, "extra": [1, 2]},
                       {"id": "b", "market_cap_rank": 3}])
    error = json.dumps({"status": {"error_code": 429}})
    partly = ' \n[null, {"symbol": "no id"}, {"id": "c"}]'
    pages = spark.createDataFrame(
        [(1, good), (2, "{not json"), (3, "[]"), (4, error), (5, None), (6, "null"), (7, partly)], "page int, body string")
    obs = Observation("p")
    rows = explode_pages(pages, observation=obs).collect()
    assert sorted(r.id for r in rows) == ["a", "b", "c"]
    a = [r for r in rows if r.id == "a"][0]
    assert a.current_price == 2.5 and a.name is None and "extra" not in rows[0].asDict()
    assert obs.get == {"pages": 7, "malformed_pages": 4, "dropped_items": 2}


# --- D8 / D1 / D12: Silver job -------------------------------------------------

def _land(spark, paths, rows):
    append_bronze(prepare_bronze(frame(spark, rows, with_partitions=False)), paths.bronze)


def test_missing_day_is_a_noop(spark, tmp_root):
    paths = LayerPaths(tmp_root)
    counts = run_silver(spark, paths, "2024-01-01")
    assert counts == {"bronze_rows": 0, "silver_rows": 0}
    assert read_table(spark, paths.silver, SILVER_SCHEMA).count() == 0


def test_rerun_is_idempotent_and_other_days_survive(spark, tmp_root):
    paths = LayerPaths(tmp_root)
    d1 = [snap(ts=dt.datetime(2024, 1, 14, 10, m), price=float(m)) for m in range(3)]
    d2 = [snap(ts=dt.datetime(2024, 1, 15, 11, m), price=float(m)) for m in range(2)]
    _land(spark, paths, d1 + d2)
    c1 = run_silver(spark, paths, "2024-01-14")
    assert c1 == {"bronze_rows": 3, "silver_rows": 1}
    run_silver(spark, paths, "2024-01-15")
    run_silver(spark, paths, "2024-01-14")  # re-run
    silver = read_table(spark, paths.silver, SILVER_SCHEMA)
    assert sorted((str(r.dt), r.current_price) for r in silver.collect()) == [
        ("2024-01-14", 2.0), ("2024-01-15", 1.0)]
    run_gold(spark, paths, "2024-01-15")
    run_gold(spark, paths, "2024-01-15")
    from marketlake.schema import FACT_SCHEMA
    assert read_table(spark, paths.fact, FACT_SCHEMA).count() == 1


def test_replace_mode_replaces_whole_table(spark, tmp_root):
    df = frame(spark, [snap(ts=dt.datetime(2024, 1, 14, 1)), snap(ts=dt.datetime(2024, 1, 15, 1))])
    publish(df, tmp_root, ("dt",))
    publish(df.filter("dt = DATE'2024-01-15'"), tmp_root, ("dt",), mode="replace")
    assert [str(r.dt) for r in spark.read.parquet(tmp_root).select("dt").collect()] == ["2024-01-15"]


def test_gold_from_bronze_input_has_real_statistics(spark, tmp_root):
    paths = LayerPaths(tmp_root)
    _land(spark, paths, [snap(ts=dt.datetime(2024, 1, 14, 10, m), price=float(m + 1)) for m in range(3)])
    run_silver(spark, paths, "2024-01-14")
    run_gold(spark, paths, "2024-01-14", fact_input="bronze")
    from marketlake.schema import FACT_SCHEMA
    r = read_table(spark, paths.fact, FACT_SCHEMA).first()
    assert r.total_registros == 3 and r.preco_desvio == pytest.approx(1.0)


# --- Serving -------------------------------------------------------------------

def test_top_n_puts_null_rank_last_and_breaks_ties_by_id(spark):
    rows = [snap(i="z", rank=None), snap(i="b", rank=2), snap(i="a", rank=2), snap(i="c", rank=1)]
    got = [r.id for r in serving.top_n(frame(spark, rows), 4).collect()]
    assert got == ["c", "a", "b", "z"]
    with pytest.raises(ValueError):
        serving.top_n(frame(spark, rows), 0)


def test_current_snapshot_is_latest_day(spark):
    rows = [snap(i="a", ts=dt.datetime(2024, 1, 14, 1)), snap(i="b", ts=dt.datetime(2024, 1, 15, 1))]
    dim = daily_dimension(frame(spark, rows))
    assert [r.id for r in serving.current_snapshot(dim).collect()] == ["b"]
    assert [r.id for r in serving.current_snapshot(dim, "2024-01-14").collect()] == ["a"]


def test_series_carries_every_asset_of_a_symbol(spark):
    rows = [snap(i="a", sym="S"), snap(i="b", sym="S"), snap(i="c", sym="T")]
    fact = hourly_fact(frame(spark, rows))
    assert sorted(r.id for r in serving.hourly_series(fact, "S").collect()) == ["a", "b"]
    assert sorted(r.id for r in serving.default_series(fact).collect()) == ["a", "b"]
    assert [r.symbol for r in serving.symbols(fact).collect()] == ["S", "T"]


# --- Streaming (D11) -----------------------------------------------------------

def test_replayed_batch_replaces_its_own_output(spark, tmp_root):
    df = frame(spark, [snap(), snap(i="b")], with_partitions=False)
    writer = bronze_batch_writer(tmp_root)
    writer(df, 7)
    writer(df, 7)  # replay of the same batch
    writer(df.limit(1), 8)
    assert read_bronze(spark, tmp_root).count() == 3


def test_stream_restart_with_same_checkpoint_adds_nothing(spark, tmp_root):
    landing, bronze, ckpt = f"{tmp_root}/landing", f"{tmp_root}/bronze", f"{tmp_root}/_ckpt"
    schema = TICK_SCHEMA
    frame(spark, [snap(), snap(i="b")], with_partitions=False).write.parquet(landing)
    for _ in range(2):
        src = spark.readStream.schema(schema).parquet(landing)
        q = start_bronze_stream(src, bronze, ckpt, available_now=True)
        assert q.awaitTermination(300)
    assert read_bronze(spark, bronze).count() == 2
    with pytest.raises(ValueError):
        start_bronze_stream(src, bronze, "", available_now=True)
    with pytest.raises(ValueError, match="own Bronze path"):
        start_bronze_stream(src, bronze, f"{tmp_root}/_other_ckpt", available_now=True)
    assert read_bronze(spark, bronze).count() == 2


# --- Maintenance -----------------------------------------------------------------

def _files(path):
    return [os.path.join(d, f) for d, _, fs in os.walk(path.replace("file:", "")) for f in fs
            if f.endswith(".parquet")]


def test_compaction_preserves_rows_and_reduces_files(spark, tmp_root):
    rows = [snap(i=f"a{k}", ts=dt.datetime(2024, 1, 14 + k % 2, 1, k % 60)) for k in range(200)]
    df = frame(spark, rows)
    df.repartition(16).write.partitionBy("dt").parquet(tmp_root)
    before = len(_files(tmp_root))
    content = sorted(map(tuple, spark.read.parquet(tmp_root).collect()))
    compact(spark, tmp_root, spark.read.parquet(tmp_root).schema)
    after = len(_files(tmp_root))
    assert after < before and after >= 2
    assert sorted(map(tuple, spark.read.parquet(tmp_root).collect())) == content


def test_compaction_leaves_compact_partitions_alone(spark, tmp_root):
    frag = [snap(i=f"a{k}", ts=dt.datetime(2024, 1, 14, 1, k)) for k in range(40)]
    one = [snap(i=f"b{k}", ts=dt.datetime(2024, 1, 15, 1, k)) for k in range(40)]
    frame(spark, frag).repartition(8).write.partitionBy("dt").parquet(tmp_root)
    frame(spark, one).coalesce(1).write.mode("append").partitionBy("dt").parquet(tmp_root)
    day15 = sorted(f for f in _files(tmp_root) if "dt=2024-01-15" in f)
    summary = compact(spark, tmp_root, spark.read.parquet(tmp_root).schema)
    assert summary == {"partitions": 2, "files": 9, "small_files": 9, "partitions_rewritten": 1, "files_after": 2}
    assert sorted(f for f in _files(tmp_root) if "dt=2024-01-15" in f) == day15  # untouched
    assert len([f for f in _files(tmp_root) if "dt=2024-01-14" in f]) == 1
    assert spark.read.parquet(tmp_root).count() == 80


def test_file_stats_on_known_layout(spark, tmp_root):
    rows = [snap(i=f"a{k}", ts=dt.datetime(2024, 1, 14 + k % 2, 1)) for k in range(30)]
    frame(spark, rows).repartition(3).write.partitionBy("dt").parquet(tmp_root)
    stats = {str(r.dt): r for r in maintenance.file_stats(spark.read.parquet(tmp_root), ["dt"]).collect()}
    assert set(stats) == {"2024-01-14", "2024-01-15"}
    assert sum(r.rows for r in stats.values()) == 30
    assert sum(r.files for r in stats.values()) == len(_files(tmp_root))
    assert all(r.bytes > 0 for r in stats.values())


def test_expired_snapshots_always_keep_the_newest(spark):
    log = spark.createDataFrame(
        [("t1", 1, dt.datetime(2024, 1, 1)), ("t1", 2, dt.datetime(2024, 1, 2)),
         ("t2", 3, dt.datetime(2024, 1, 1)), ("t2", 4, dt.datetime(2024, 3, 1)),
         ("t3", 5, dt.datetime(2024, 1, 1)), ("t3", 6, dt.datetime(2024, 1, 1))],
        "table_name string, snapshot_id long, committed_at timestamp")
    got = sorted(r.snapshot_id for r in maintenance.expired_snapshots(log, "2024-02-01").collect())
    assert got == [1, 3, 5]  # t1 keeps 2 (newest though old), t3 keeps the larger id on a tie


def test_orphan_files_in_warehouse(spark, tmp_root):
    paths = LayerPaths(tmp_root)
    _land(spark, paths, [snap(ts=dt.datetime(2024, 1, 14, 10))])
    run_silver(spark, paths, None)
    run_gold(spark, paths, None)
    stray_dir = f"{paths.root}/old_table/dt=2024-01-01".replace("file:", "")
    os.makedirs(stray_dir)
    stray = f"{stray_dir}/part-0.parquet"
    open(stray, "wb").write(b"x")
    old = (dt.datetime.now() - dt.timedelta(days=30)).timestamp()
    os.utime(stray, (old, old))
    results, cands = run_vacuum(spark, paths)
    got = [r.file_path for r in cands.collect()]
    assert got == [stray]
    assert {r.status for r in results} == {"ok"}
    _, none_young = run_vacuum(spark, paths, retention_days=60)
    assert none_young.count() == 0


def test_sunday_helpers(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 8),)], "dt date")
    assert [r.dt for r in maintenance.vacuum_days(df).collect()] == [dt.date(2024, 1, 7)]
    assert maintenance.is_vacuum_day("2024-01-07") and not maintenance.is_vacuum_day("2024-01-08")
    r = spark.range(1).select(
        (retention_cutoff(dt.datetime(2024, 1, 8), 7) == F.lit(dt.datetime(2024, 1, 1))).alias("ok"),
        is_sunday(F.lit(dt.date(2024, 1, 7))).alias("sun")).first()
    assert r.ok and r.sun


def test_run_day_on_sunday_runs_vacuum(spark, tmp_root):
    paths = LayerPaths(tmp_root)
    _land(spark, paths, [snap(ts=dt.datetime(2024, 1, 7, 10))])
    report = run_day(spark, paths, "2024-01-07")
    assert report["silver"]["silver_rows"] == 1
    assert {r.status for r in report["compaction"]} == {"ok"}
    assert "vacuum" in report and report["orphan_candidates"].count() == 0
    report = run_day(spark, paths, "2024-01-08")
    assert "vacuum" not in report


def test_cli_requires_execution_date():
    from marketlake.plans.cli import main

    with pytest.raises(SystemExit):
        main(["silver", "--warehouse", "/nonexistent"])


def test_several_days_are_pruned_together(spark, tmp_root):
    rows = [snap(ts=dt.datetime(2024, 1, d, 3)) for d in (13, 14, 15)]
    append_bronze(prepare_bronze(frame(spark, rows, with_partitions=False)), tmp_root)
    got = read_bronze(spark, tmp_root, ["2024-01-13", "2024-01-15"])
    assert sorted(str(r.dt) for r in got.collect()) == ["2024-01-13", "2024-01-15"]
    # Only those days' folders are listed: one that cannot be read does not matter.
    broken = f"{tmp_root}/dt=2024-01-14/odd=1/hour=x".replace("file:", "")
    os.makedirs(broken)
    open(f"{broken}/part-0.json", "w").write("{")
    assert read_bronze(spark, tmp_root, ["2024-01-13", "2024-01-15"]).count() == 2
    assert read_bronze(spark, tmp_root, "2024-01-20").count() == 0


def test_stream_equals_batch_bronze(spark, tmp_root):
    rows = [snap(i=f"a{k}", ts=dt.datetime(2024, 1, 14, k % 24, k % 60), price=float(k)) for k in range(50)]
    df = frame(spark, rows, with_partitions=False)
    landing = f"{tmp_root}/landing"
    df.repartition(3).write.parquet(landing)
    src = spark.readStream.schema(TICK_SCHEMA).option("maxFilesPerTrigger", 1).parquet(landing)
    q = start_bronze_stream(src, f"{tmp_root}/stream", f"{tmp_root}/_ckpt", available_now=True)
    assert q.awaitTermination(300)
    append_bronze(prepare_bronze(df), f"{tmp_root}/batch")
    a = read_bronze(spark, f"{tmp_root}/stream")
    b = read_bronze(spark, f"{tmp_root}/batch")
    assert a.select("batch_id").distinct().count() == 3  # one micro-batch per landed file
    assert sorted(map(tuple, a.drop("batch_id").collect())) == sorted(map(tuple, b.drop("batch_id").collect()))


def test_rate_trigger_source_is_a_stream(spark):
    from marketlake.sources.stream import rate_trigger_stream

    df = rate_trigger_stream(spark)
    assert df.isStreaming and {"timestamp", "value"} <= set(df.columns)


def test_vacuum_reports_leftovers_of_crashed_writes(spark, tmp_root):
    paths = LayerPaths(tmp_root)
    _land(spark, paths, [snap(ts=dt.datetime(2024, 1, 14, 10))])
    run_silver(spark, paths, None)
    run_gold(spark, paths, None)
    root = paths.root.replace("file:", "")
    old = (dt.datetime.now() - dt.timedelta(days=30)).timestamp()
    leftovers = [
        f"{root}/{SILVER_TABLE}/.spark-staging-abc/dt=2024-01-01/part-0.parquet",
        f"{root}/{SILVER_TABLE}/_temporary/0/_temporary/attempt_1/dt=2024-01-01/part-1.parquet",
        f"{root}/{FACT_TABLE}/_temporary/0/task_2/dt=2024-01-01/part-2.parquet",
    ]
    young = f"{root}/{FACT_TABLE}/.spark-staging-run/dt=2024-01-02/part-3.parquet"
    for f in leftovers + [young]:
        os.makedirs(os.path.dirname(f))
        open(f, "wb").write(b"x")
        if f != young:
            os.utime(f, (old, old))
    results, cands = run_vacuum(spark, paths)
    assert sorted(r.file_path for r in cands.collect()) == sorted(leftovers)
    assert {r.status for r in results} == {"ok"}


def test_cluster_session_without_checkpoint_dir_is_refused():
    from marketlake.session import checkpoint_root

    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class NoJvmSession:  # e.g. a remote session: no JVM handle
        def __init__(self, values):
            self.conf = Conf(values)

        @property
        def sparkContext(self):
            raise RuntimeError("no JVM")

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(NoJvmSession({"spark.master": "yarn"}))
    shared = "/shared/ckpt"
    assert checkpoint_root(NoJvmSession({"spark.master": "yarn", "spark.checkpoint.dir": shared + "/"})) == shared


# --- Replay, one layout, folding ------------------------------------------------

def test_replay_after_the_hour_adds_nothing(spark, tmp_root):
    landing, bronze = f"{tmp_root}/landing", f"{tmp_root}/bronze"
    body = json.dumps([{"id": "a", "current_price": 1.0}, {"id": "b"}])
    spark.createDataFrame([(body,), ('{"status": {"error_code": 429}}',)], "value string").repartition(2).write.text(landing)
    old = dt.datetime(2024, 1, 14, 10, 59, 59, tzinfo=dt.timezone.utc).timestamp()
    for d, _, fs in os.walk(landing.replace("file:", "")):
        for f in fs:
            os.utime(f"{d}/{f}", (old, old))
    source = spark.read.option("wholetext", "true").text(landing).select(
        F.col("value").alias("body"), F.col("_metadata.file_modification_time").alias("fetched_at"))
    from marketlake.streaming.bronze_ingest import rows_of_pages

    writer = bronze_batch_writer(bronze)
    for _ in range(2):  # the wall clock has moved on; the rows' time has not
        writer(rows_of_pages(source), 7)
    rows = read_bronze(spark, bronze).collect()
    assert sorted(r.id for r in rows) == ["a", "b"]
    assert {(str(r.dt), r.hour, r.batch_id) for r in rows} == {("2024-01-14", 10, 7)}
    with pytest.raises(ValueError, match="ingestion_ts"):
        writer(frame(spark, [snap()], with_partitions=False).drop("ingestion_ts"), 8)


def test_batch_and_stream_share_a_layer_and_folding_keeps_its_rows(spark, tmp_root):
    from marketlake.plans.jobs import ingest_bronze_batch
    from marketlake.sinks.writers import fold_bronze

    paths = LayerPaths(tmp_root)
    rows = [snap(i=f"a{k}", ts=dt.datetime(2024, 1, 14, 10 + k % 2, k), price=float(k)) for k in range(20)]
    df = frame(spark, rows, with_partitions=False)
    used = ingest_bronze_batch(spark, paths, df.limit(5))
    assert used < 0
    writer = bronze_batch_writer(paths.bronze)
    for n in range(3):
        writer(df.filter(F.col("id").isin([f"a{k}" for k in range(5 + n * 5, 10 + n * 5)])), n)
    with pytest.raises(ValueError):
        ingest_bronze_batch(spark, paths, df, batch_id=3)
    before = sorted(map(tuple, read_bronze(spark, paths.bronze).drop("batch_id").collect()))
    assert len(before) == 20
    run_silver(spark, paths, "2024-01-14")
    silver = sorted(map(tuple, read_table(spark, paths.silver, SILVER_SCHEMA).drop("_processed_at").collect()))
    assert fold_bronze(spark, paths.bronze, "2024-01-14") == 2
    assert fold_bronze(spark, paths.bronze, ["2024-01-14", "2024-01-15"]) == 0
    after = read_bronze(spark, paths.bronze)
    assert sorted(map(tuple, after.drop("batch_id").collect())) == before
    assert after.select("hour", "batch_id").distinct().count() == 2
    run_silver(spark, paths, "2024-01-14")
    assert sorted(map(tuple, read_table(spark, paths.silver, SILVER_SCHEMA).drop("_processed_at").collect())) == silver


def test_interrupted_swap_loses_nothing(spark, tmp_root, monkeypatch):
    import marketlake.sinks.rewrite as rewrite

    rows = [snap(i=f"a{k}", ts=dt.datetime(2024, 1, 14 + k % 3, 1, k)) for k in range(60)]
    frame(spark, rows).repartition(6).write.partitionBy("dt").parquet(tmp_root)
    schema = spark.read.parquet(tmp_root).schema
    content = sorted(map(tuple, spark.read.parquet(tmp_root).collect()))
    move, calls = rewrite.move_folder, []

    def dies(s, source, target):
        calls.append(target)
        if len(calls) == 4:  # the second folder is aside, its copy not yet in place
            raise OSError("driver lost")
        move(s, source, target)

    monkeypatch.setattr(rewrite, "move_folder", dies)
    with pytest.raises(OSError):
        compact(spark, tmp_root, schema)
    monkeypatch.setattr(rewrite, "move_folder", move)
    assert spark.read.schema(schema).parquet(tmp_root).count() < 60
    assert rewrite.recover(spark, tmp_root, 1) == 1
    assert sorted(map(tuple, spark.read.schema(schema).parquet(tmp_root).collect())) == content
    compact(spark, tmp_root, schema)
    assert sorted(map(tuple, spark.read.schema(schema).parquet(tmp_root).collect())) == content
    assert not os.path.exists(f"{tmp_root}{rewrite.WORK_SUFFIX}".replace("file:", ""))


def test_rewrite_that_loses_rows_changes_nothing(spark, tmp_root):
    from marketlake.sinks.rewrite import rewrite_folders

    frame(spark, [snap(i=f"a{k}") for k in range(10)]).write.partitionBy("dt").parquet(tmp_root)
    schema = spark.read.parquet(tmp_root).schema
    with pytest.raises(RuntimeError, match="same rows"):
        rewrite_folders(
            spark, tmp_root, ["dt=2024-01-14"], ["dt"],
            lambda base, folders: spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders]),
            lambda df, base: df.limit(9).write.partitionBy("dt").parquet(base))
    assert spark.read.parquet(tmp_root).count() == 10


# --- Vacuum: live files are never candidates --------------------------------------

def _old(path):
    old = (dt.datetime.now() - dt.timedelta(days=30)).timestamp()
    for d, _, fs in os.walk(path.replace("file:", "")):
        for f in fs:
            os.utime(f"{d}/{f}", (old, old))


@pytest.mark.parametrize("name", ["plain", "with space", "per%20cent %41"])
def test_vacuum_spares_live_files_whatever_the_path(spark, tmp_root, name):
    paths = LayerPaths(f"{tmp_root}/{name}")
    _land(spark, paths, [snap(ts=dt.datetime(2024, 1, 14, 10))])
    run_silver(spark, paths, None)
    run_gold(spark, paths, None)
    root = paths.root.replace("file:", "")
    # A file without rows and one that is no Parquet at all belong to their tables.
    frame(spark, [snap()]).limit(0).coalesce(1).drop("dt").write.parquet(f"{paths.fact}/dt=2024-01-20")
    os.makedirs(f"{root}/{SILVER_TABLE}/dt=2024-01-21")
    open(f"{root}/{SILVER_TABLE}/dt=2024-01-21/part-9.parquet", "wb").write(b"broken")
    # A sibling whose name begins like a table's is not that table.
    os.makedirs(f"{root}/{SILVER_TABLE}_old/dt=2024-01-01")
    stray = f"{root}/{SILVER_TABLE}_old/dt=2024-01-01/part 1%.parquet"
    open(stray, "wb").write(b"x")
    _old(paths.root)
    results, found = run_vacuum(spark, paths)
    assert [r.file_path for r in found.collect()] == [stray]
    assert {r.status for r in results} == {"ok"}
    assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString().replace("FileScan binaryFile", "")


def test_vacuum_goes_on_when_one_table_fails(spark, tmp_root, monkeypatch):
    import marketlake.plans.jobs as jobs

    paths = LayerPaths(tmp_root, silver=f"{tmp_root}-elsewhere/silver")
    _land(spark, paths, [snap(ts=dt.datetime(2024, 1, 14, 10))])
    run_silver(spark, paths, None)
    run_gold(spark, paths, None)
    strays = [f"{paths.root}/old/x.parquet", f"{paths.silver}/not-a-partition/y.parquet", f"{paths.fact}/not-a-partition/z.parquet"]
    for f in [s.replace("file:", "") for s in strays]:
        os.makedirs(os.path.dirname(f))
        open(f, "wb").write(b"x")
    _old(paths.root), _old(paths.silver)
    listing = jobs.file_inventory
    monkeypatch.setattr(jobs, "recover", lambda s, path, n: (_ for _ in ()).throw(OSError("unreadable")) if path.endswith(FACT_TABLE) else 0)
    results, found = run_vacuum(spark, paths)
    assert {r.table: r.status for r in results}[FACT_TABLE] == "failed"
    assert sorted(r.file_path for r in found.collect()) == sorted(s.replace("file:", "") for s in strays[:2])
    assert listing is jobs.file_inventory


def test_vacuum_cutoff_is_an_instant(spark, tmp_root):
    """The same instant in another zone gives the same candidates."""
    paths = LayerPaths(tmp_root)
    folder = f"{paths.root}/old".replace("file:", "")
    os.makedirs(folder)
    now = dt.datetime(2024, 3, 10, 12, 0, tzinfo=dt.timezone.utc)
    for name, age in (("young", -60), ("aged", 60)):
        open(f"{folder}/{name}", "wb").write(b"x")
        at = (now - dt.timedelta(days=7, seconds=age)).timestamp()
        os.utime(f"{folder}/{name}", (at, at))
    west = now.astimezone(dt.timezone(dt.timedelta(hours=-3)))
    for instant in (now, west, now.replace(tzinfo=None)):
        _, found = run_vacuum(spark, paths, now=instant)
        assert [r.file_path.rsplit("/", 1)[1] for r in found.collect()] == ["aged"]
    _, none = run_vacuum(spark, paths, now=now, retention_days=8)
    assert none.count() == 0


# --- Gold views and the command line ----------------------------------------------

def test_gold_views_check_their_range(spark, tmp_root):
    from marketlake.plans.jobs import open_gold

    paths = LayerPaths(tmp_root)
    empty = open_gold(spark, paths)
    assert empty.latest_day() is None and empty.kpis().first().moedas_rastreadas == 0
    _land(spark, paths, [snap(i=f"a{k}", rank=k, ts=dt.datetime(2024, 1, 13 + k % 2, 10)) for k in range(30)])
    run_silver(spark, paths, None)
    run_gold(spark, paths, None)
    gold = open_gold(spark, paths)
    assert gold.latest_day() == "2024-01-14" and gold.top_n(10).count() == 10
    assert {str(r.dt) for r in gold.top_n(100, as_of="2024-01-13").collect()} == {"2024-01-13"}
    for n in (9, 101):
        with pytest.raises(ValueError):
            gold.top_n(n)


def test_commands_ingest_day_and_vacuum(spark, tmp_root, capsys):
    from marketlake.plans.cli import main
    from marketlake.schema import FACT_SCHEMA

    landing = f"{tmp_root}/landing"
    bodies = [json.dumps([{"id": "a", "symbol": "A", "name": "Asset a", "current_price": 2.0}]), "{}"]
    spark.createDataFrame([(b,) for b in bodies], "value string").repartition(2).write.text(landing)
    at = dt.datetime(2024, 1, 14, 10, 30, tzinfo=dt.timezone.utc).timestamp()  # a Sunday
    for d, _, fs in os.walk(landing.replace("file:", "")):
        for f in fs:
            os.utime(f"{d}/{f}", (at, at))
    warehouse = ["--warehouse", f"{tmp_root}/warehouse"]
    main(["ingest", *warehouse, "--landing", landing, "--checkpoint", f"{tmp_root}/ckpt", "--available_now"])
    main(["collect", *warehouse, "--landing", landing, "--out", f"{tmp_root}/collected"])
    assert spark.read.json(f"{tmp_root}/collected").count() == 1
    main(["day", *warehouse, "--execution_date", "2024-01-14"])
    paths = LayerPaths(f"{tmp_root}/warehouse")
    fact = read_table(spark, paths.fact, FACT_SCHEMA).collect()
    assert [(r.id, str(r.dt), r.hour, r.preco_medio) for r in fact] == [("a", "2024-01-14", 10, 2.0)]
    stray = f"{paths.root}/stray.bin".replace("file:", "")
    open(stray, "wb").write(b"xyz")
    capsys.readouterr()
    main(["vacuum", *warehouse, "--retention_days", "-1", "--candidates", f"{tmp_root}/candidates"])
    said = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert said["candidates"]["files"] == 1 and said["candidates"]["bytes"] == 3
    assert [r.file_path for r in spark.read.json(f"{tmp_root}/candidates").collect()] == [stray]
    for bad in (["ingest", *warehouse], ["collect", *warehouse, "--landing", landing]):
        with pytest.raises(SystemExit):
            main(bad)


# --- Landing of pages -------------------------------------------------------------

def _small_events(spark, root, n=5000):
    """``n`` events (20 pages of 250), one of them without a number: a page of its own."""
    spark.range(n + 1).select(
        F.when(F.col("id") < n, F.col("id")).alias("event_id"),
        F.timestamp_seconds(F.lit(1705226400) + F.col("id")).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 90).alias("user_id"), F.lit("view").alias("event_type"), (F.col("id") % 100 * 1.0).alias("value"),
        F.lit("{}").alias("props")).coalesce(1).write.parquet(f"{root}/events.parquet")
    return root


def test_failed_pages_are_dealt_with_their_pages(spark, tmp_root):
    from marketlake.catalog import _pages

    pages = _pages(spark, _small_events(spark, tmp_root))
    failed = F.col("body").startswith("{")
    dealt = pages.groupBy(F.spark_partition_id()).agg(
        F.count_if(~failed).alias("good"), F.count_if(failed).alias("bad")).collect()
    assert sum(r.good for r in dealt) == 21 and all(r.good == r.bad for r in dealt)
    ids = [r.page_id for r in pages.collect()]
    assert sorted(i for i in ids if i is not None) == list(range(-20, 20)) and ids.count(None) == 2


def test_page_stream_lands_one_file_a_page_in_few_folders(spark, tmp_root, monkeypatch):
    from marketlake import catalog

    sf_dir, made = _small_events(spark, tmp_root), {}
    monkeypatch.setattr(catalog, "scratch_dir", lambda s, name: made.setdefault(name, f"{tmp_root}/{name}"))
    rows = catalog.q_bronze_page_stream(spark, sf_dir)
    assert rows.count() == 5001 and rows.where("current_price = 7").count() == 50
    folders = {}
    for d, _, fs in os.walk(made["landed-pages"].replace("file:", "")):
        bodies = [open(f"{d}/{f}").read() for f in fs if f.startswith("part-")]
        assert all(b.count("\n") == 1 for b in bodies)  # one page, whole
        if bodies:
            folders[d] = len(bodies)
    # One folder a task that writes, not one a page.
    assert sum(folders.values()) == 42 and len(folders) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
