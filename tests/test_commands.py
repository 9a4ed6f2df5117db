"""Rows without a time in the daily job, folding as part of it, and the commands."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest

from marketlake import catalog
from marketlake.plans.cli import main
from marketlake.plans.jobs import LayerPaths, run_day
from marketlake.schema import FACT_SCHEMA
from marketlake.sinks.writers import append_bronze
from marketlake.sources.bronze import days_present, read_bronze, untimed_rows
from marketlake.sources.tables import read_table
from marketlake.streaming.bronze_ingest import prepare_bronze
from marketlake.streaming.progress import read_progress
from tests.conftest import SF_SMALL
from tests.test_semantics import frame, snap


def land(spark, paths, rows, batch_id=None):
    append_bronze(prepare_bronze(frame(spark, rows, with_partitions=False)), paths.bronze, batch_id=batch_id)


@pytest.mark.parametrize("dates", [None, "2024-01-14"])
def test_rows_without_a_time_are_counted_and_set_aside(spark, tmp_root, dates):
    paths = LayerPaths(tmp_root)
    rows = [snap(ts=dt.datetime(2024, 1, 14, 10)), snap(i="b", ts=None), snap(i="c", ts=None)]
    for _ in range(2):  # a replay replaces them like any other row
        land(spark, paths, rows, batch_id=5)
    assert days_present(spark, paths.bronze) == ["2024-01-14"]
    assert sorted(r.id for r in untimed_rows(spark, paths.bronze).collect()) == ["b", "c"]
    report = run_day(spark, paths, dates)
    assert report["untimed_rows"] == 2 and report["silver"]["silver_rows"] == 1
    assert report["orphan_candidates"].count() == 0
    assert [r.id for r in read_table(spark, paths.fact, FACT_SCHEMA).collect()] == ["a"]
    assert not [d for d in os.listdir(paths.silver.replace("file:", "")) if "HIVE_DEFAULT" in d]


def test_the_daily_job_folds_days_that_cannot_be_replayed(spark, tmp_root):
    paths = LayerPaths(tmp_root)
    for batch in range(3):
        land(spark, paths, [snap(price=float(batch), ts=dt.datetime(2024, 1, day, 10, batch)) for day in (12, 13)], batch_id=batch)
    report = run_day(spark, paths, None, fold_before="2024-01-13")
    assert report["folded_hours"] == 1 and report["silver"] == {"bronze_rows": 6, "silver_rows": 2}
    rows = read_bronze(spark, paths.bronze)
    batches = {str(d): rows.where(f"dt = '{d}'").select("batch_id").distinct().count() for d in ("2024-01-12", "2024-01-13")}
    assert batches == {"2024-01-12": 1, "2024-01-13": 3} and rows.count() == 6


def landed_pages(spark, root):
    bodies = [json.dumps([{"id": "a", "symbol": "A", "name": "Asset a", "current_price": 2.0}]), "{}"]
    spark.createDataFrame([(b,) for b in bodies], "value string").repartition(2).write.text(f"{root}/landing")
    at = dt.datetime(2024, 1, 14, 10, 30, tzinfo=dt.timezone.utc).timestamp()
    for d, _, fs in os.walk(f"{root}/landing".replace("file:", "")):
        for f in fs:
            os.utime(f"{d}/{f}", (at, at))
    return f"{root}/landing"


def test_ingest_writes_its_progress(spark, tmp_root, capsys):
    landing = landed_pages(spark, tmp_root)
    main(["ingest", "--warehouse", f"{tmp_root}/w", "--landing", landing, "--checkpoint", f"{tmp_root}/c", "--available_now",
          "--progress", f"{tmp_root}/p"])
    assert [(r.batch_id, r.rows) for r in read_progress(spark, f"{tmp_root}/p").collect()] == [(0, 2)]


def test_collected_files_are_loaded_into_bronze_once(spark, tmp_root, capsys):
    landing, warehouse = landed_pages(spark, tmp_root), ["--warehouse", f"{tmp_root}/w"]
    main(["collect", *warehouse, "--landing", landing, "--out", f"{tmp_root}/out"])
    for _ in range(2):
        main(["load", *warehouse, "--out", f"{tmp_root}/out", "--batch", "7"])
    rows = read_bronze(spark, LayerPaths(f"{tmp_root}/w").bronze).collect()
    assert [(r.id, r.current_price, str(r.dt), r.hour, r.batch_id) for r in rows] == [("a", 2.0, "2024-01-14", 10, -7)]
    for bad in (["load", *warehouse, "--out", "x"], ["load", *warehouse, "--out", "x", "--batch", "0"]):
        with pytest.raises(SystemExit):
            main(bad)


def test_vacuum_deletes_from_the_list_only(spark, tmp_root, capsys):
    paths = LayerPaths(f"{tmp_root}/w")
    land(spark, paths, [snap(ts=dt.datetime(2024, 1, 14, 10))])
    run_day(spark, paths, "2024-01-14")
    warehouse = ["vacuum", "--warehouse", paths.root, "--retention_days", "-1"]
    strays = [f"{paths.root}/stray {k}.bin".replace("file:", "") for k in range(2)]
    open(strays[0], "wb").write(b"x")
    main([*warehouse, "--candidates", f"{tmp_root}/list"])
    open(strays[1], "wb").write(b"y")  # an orphan too, but not on the list
    capsys.readouterr()
    main([*warehouse, "--candidates", f"{tmp_root}/list", "--delete", f"{tmp_root}/done"])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"deleted": 1}
    assert [os.path.exists(f) for f in strays] == [False, True]
    assert read_table(spark, paths.fact, FACT_SCHEMA).count() == 1
    with pytest.raises(SystemExit):
        main([*warehouse, "--delete", f"{tmp_root}/done"])


def test_views_see_changed_input(spark, tmp_root):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.where("user_id % 60 % 20 <> 0").write.parquet(f"{tmp_root}/events.parquet")
    symbols = catalog.QUERIES["serve_symbols"]
    assert "s0" not in {r.symbol for r in symbols(spark, tmp_root).collect()}
    events.write.mode("overwrite").parquet(f"{tmp_root}/events.parquet")
    assert "s0" in {r.symbol for r in symbols(spark, tmp_root).collect()}


def test_batches_are_appended_once_and_replaced_when_replayed(spark, tmp_root):
    def append(price, batch_id):
        df = frame(spark, [snap(i=f"b{batch_id}", price=price, ts=dt.datetime(2024, 1, 14, h)) for h in (10, 11)], with_partitions=False)
        append_bronze(prepare_bronze(df), tmp_root, batch_id=batch_id)

    append(1.0, 0)
    append(1.0, 1)
    local = tmp_root.replace("file:", "")
    # A driver that was lost while batch 2 was written left part of its output.
    append(9.0, 2)
    os.remove(next(f"{d}/{f}" for d, _, fs in os.walk(f"{local}/dt=2024-01-14/hour=10/batch_id=2") for f in fs if f.endswith(".json")))
    append(2.0, 2)
    append(3.0, 1)  # a replay of an earlier batch
    append(4.0, -3)
    append(5.0, -3)
    rows = sorted((r.id, r.hour, r.current_price) for r in read_bronze(spark, tmp_root).collect())
    assert rows == sorted((i, h, p) for i, p in [("b-3", 5.0), ("b0", 1.0), ("b1", 3.0), ("b2", 2.0)] for h in (10, 11))
    assert os.listdir(f"{local}/_last_batch").count("2") == 1
