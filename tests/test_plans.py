"""Physical-plan checks: pruning, pushdown, map-side reduction, no Python UDFs."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_mod
from marketlake.sinks.writers import publish
from marketlake.sources.tables import read_table
from marketlake.sources.ticks import read_ticks
from marketlake.operators.silver import silver_from_bronze
from marketlake.operators import serving
from marketlake.operators.gold import daily_dimension
from marketlake.schema import SILVER_SCHEMA
from tests.conftest import SF_SMALL, plan_text

PURE = [
    "silver_dedup", "gold_hourly_fact_silver", "gold_hourly_fact_ticks", "gold_daily_dimension",
    "silver_typing", "serve_top_n", "serve_market_cap", "serve_variation", "serve_top_spread",
    "serve_kpis", "serve_symbols", "serve_hourly_series", "serve_hourly_volume",
    "serve_hourly_volatility", "serve_default_series", "bronze_page_explode", "bronze_null_fill",
    "bronze_metadata", "bronze_metadata_keep_nulls", "maint_expired_snapshots",
    "maint_orphan_files", "maint_vacuum_days", "quality_row_counts",
]
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF", "MapInArrow")


@pytest.mark.parametrize("name", PURE)
def test_no_python_in_plan(spark, name):
    text = plan_text(entry_mod.queries()[name](spark, SF_SMALL))
    assert not any(n in text for n in PYTHON_NODES), name


def test_dedup_reduces_before_the_shuffle(spark):
    text = plan_text(entry_mod.queries()["silver_dedup"](spark, SF_SMALL))
    assert re.search(r"WindowGroupLimit.*\n(.*\n)*?.*Exchange", text) or "Partial" in text
    assert "row_number(), 1, Partial" in text


def test_fact_is_partially_aggregated_and_scan_is_pruned(spark):
    text = plan_text(entry_mod.queries()["gold_hourly_fact_ticks"](spark, SF_SMALL))
    assert "partial_avg" in text and "partial_stddev_samp" in text
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", text).group(1)
    assert "props" not in schema and "event_type" not in schema


def test_top_n_uses_take_ordered(spark):
    text = plan_text(entry_mod.queries()["serve_top_n"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in text


def test_latest_day_semi_join_is_a_one_row_broadcast(spark):
    dim = daily_dimension(silver_from_bronze(read_ticks(spark, SF_SMALL)))
    text = plan_text(serving.current_snapshot(dim))
    assert "BroadcastExchange" in text and "LeftSemi" in text


def test_day_filter_prunes_partitions(spark, tmp_root):
    publish(silver_from_bronze(read_ticks(spark, SF_SMALL)), tmp_root, ("dt",))
    text = plan_text(read_table(spark, tmp_root, SILVER_SCHEMA, "2024-01-15"))
    assert re.search(r"PartitionFilters: \[.*dt", text)
    direct = silver_from_bronze(read_ticks(spark, SF_SMALL)).filter("dt = DATE'2024-01-15'").count()
    assert read_table(spark, tmp_root, SILVER_SCHEMA, "2024-01-15").count() == direct > 0


def test_orphan_anti_join_dedups_references_first(spark):
    text = plan_text(entry_mod.queries()["maint_orphan_files"](spark, SF_SMALL))
    assert "LeftAnti" in text
    assert "LessThan(o_orderdate," in text
    # referenced keys are aggregated (de-duplicated) before they reach the join
    assert re.search(r"HashAggregate \(\d+\)\n\s+\+- Exchange", text)


@pytest.mark.parametrize("name", ["serve_top_n", "serve_market_cap", "serve_variation", "serve_top_spread", "serve_kpis"])
def test_views_read_one_day_of_the_published_dimension(spark, name):
    text = plan_text(entry_mod.queries()[name](spark, SF_SMALL))
    assert re.search(r"PartitionFilters: \[[^\n]*dt#\d+ = ", text), text
    assert "Window" not in text and "events.parquet" not in text
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" not in text


def test_compaction_reads_only_chosen_folders_in_groups(spark, tmp_root, monkeypatch):
    import marketlake.sinks.writers as writers

    ticks = read_ticks(spark, SF_SMALL)
    days = [f"2024-01-{d:02d}" for d in range(10, 15)]
    ticks.filter(ticks.dt.isin(days)).repartition(8).write.partitionBy("dt").parquet(tmp_root)
    whole = ticks.filter("dt = DATE'2024-01-16'").coalesce(1)
    whole.write.mode("append").partitionBy("dt").parquet(tmp_root)
    groups = []
    rewrite = writers.rewrite_folders
    monkeypatch.setattr(writers, "rewrite_folders", lambda s, p, folders, *a: (groups.append(folders), rewrite(s, p, folders, *a)))
    before = {k: v for k, v in [(r.dt, r["count"]) for r in spark.read.parquet(tmp_root).groupBy("dt").count().collect()]}
    summary = writers.compact(spark, tmp_root, ticks.schema, group_size=2)
    assert summary["partitions_rewritten"] == 5 and summary["files_after"] < summary["files"]
    assert groups == [[f"dt={d}" for d in days[k:k + 2]] for k in (0, 2, 4)]
    assert before == {r.dt: r["count"] for r in spark.read.parquet(tmp_root).groupBy("dt").count().collect()}
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") != str(128 * 1024 * 1024)
