"""Event-time streams, mergeable state, late rows, star join, rules, alerts, progress
and the deleting step, on small literal frames."""

from __future__ import annotations

import datetime as dt
import math
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from marketlake.functions.columns import ingestion_metadata
from marketlake.operators.alerts import alert_runs, moves
from marketlake.operators.fact_state import fact_of_partials, merge_facts, partial_facts
from marketlake.operators.gold import daily_dimension, hourly_fact
from marketlake.operators.quality import layer_counts, rule_counts
from marketlake.operators.silver import silver_from_bronze
from marketlake.operators.star import daily_profile, star
from marketlake.plans.cleanup import delete_orphans, store_candidates
from marketlake.plans.jobs import LayerPaths, run_vacuum
from marketlake.schema import DIMENSION_SCHEMA, FACT_KEYS, FACT_SCHEMA, PROCESSED_AT, SILVER_SCHEMA
from marketlake.sinks.writers import publish
from marketlake.sources.stream import landing_stream
from marketlake.sources.tables import read_table
from marketlake.streaming.event_time import read_closed, start_watermarked_fact, start_watermarked_silver
from marketlake.streaming.incremental_fact import (
    FactPaths,
    fact_batch_writer,
    read_batches,
    read_state,
    start_incremental_fact,
)
from marketlake.streaming.price_alerts import read_alerts, runs_of_alerts, start_alert_stream
from marketlake.streaming.progress import batch_totals, read_progress, run_until_stopped
from tests.conftest import plan_text
from tests.test_semantics import TICK_SCHEMA, frame, snap

DAY = dt.datetime(2024, 1, 14)


def at(hour, minute=0, day=0):
    return DAY + dt.timedelta(days=day, hours=hour, minutes=minute)


def random_ticks(seed, n, days=2, assets=3):
    rng = random.Random(seed)
    return [snap(i=f"a{rng.randrange(assets)}", price=rng.choice([1e9, 1.0, None]) and rng.uniform(0.5, 2.0) * rng.choice([1.0, 1e9]),
                 ts=at(0, day=rng.randrange(days)) + dt.timedelta(seconds=rng.randrange(86_400))) for _ in range(n)]


def facts(df):
    return {(r.id, r.dt, r.hour): r.asDict() for r in df.drop(PROCESSED_AT).collect()}


def same_facts(got, want, tolerance=1e-9):
    assert set(got) == set(want)
    for k, row in want.items():
        for c, v in row.items():
            if isinstance(v, float):
                assert math.isclose(got[k][c], v, rel_tol=tolerance, abs_tol=tolerance), (k, c)
            else:
                assert got[k][c] == v, (k, c)


# --- Mergeable state -----------------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2, 3])
def test_partials_merge_in_any_order_and_grouping(spark, seed):
    df = frame(spark, random_ticks(seed, 400) + [snap(price=None), snap(price=5e8, ts=at(3))])
    want = facts(hourly_fact(df))
    batched = df.withColumn("batch", (F.rand(seed) * 9).cast("int"))
    partials = partial_facts(batched, [*FACT_KEYS, "batch"]).repartition(5)
    once = merge_facts(partials)
    twice = merge_facts(merge_facts(partials.where("batch % 2 = 0")).unionByName(merge_facts(partials.where("batch % 2 = 1"))))
    same_facts(facts(fact_of_partials(once)), want)
    same_facts(facts(fact_of_partials(twice)), want)


def test_deviation_of_nearly_equal_large_prices(spark):
    # Sums of squares would lose every digit of the deviation here.
    rows = [snap(price=1e9 + k * 1e-3, ts=at(1, k)) for k in range(40)]
    df = frame(spark, rows).withColumn("batch", F.minute("ingestion_ts") % 7)
    fact = fact_of_partials(merge_facts(partial_facts(df, [*FACT_KEYS, "batch"]))).first()
    exact = [1e9 + k * 1e-3 for k in range(40)]
    mean = math.fsum(exact) / 40
    assert math.isclose(fact.preco_desvio, math.sqrt(math.fsum((x - mean) ** 2 for x in exact) / 39), rel_tol=1e-5)


# --- Streams closed by a watermark ---------------------------------------------------

def landed(spark, root, rows):
    frame(spark, rows, with_partitions=False).coalesce(1).write.mode("append").parquet(f"{root}/landing")
    return landing_stream(spark, f"{root}/landing", TICK_SCHEMA)


def closed_before(df, time):
    return df.where(F.col("dt").cast("timestamp") + F.make_interval(hours=F.col("hour") + 1) <= F.lit(time))


@pytest.mark.parametrize("kind", ["fact", "silver"])
def test_watermarked_streams_equal_batch_on_closed_hours(spark, tmp_root, kind):
    waves = [[snap(i=f"a{k % 3}", price=float(k), ts=at(h, k)) for k in range(1, 12) for h in hours] for hours in ((0, 1), (2, 3), (5,))]
    waves[1].append(snap(i="a0", price=9.0, ts=None))
    waves[0].append(snap(i="a1", price=77.0, ts=at(1, 11), rank=None))  # a tie in time
    start = start_watermarked_fact if kind == "fact" else start_watermarked_silver
    path, checkpoint, held = f"{tmp_root}/out", f"{tmp_root}/ckpt", []
    for wave in waves:  # each run goes on from the state of the one before
        query = start(landed(spark, tmp_root, wave), path, checkpoint, available_now=True)
        assert query.awaitTermination(300)
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(held) <= 2 * 3  # assets x hours that are open, not the hours seen
    rows = frame(spark, [r for w in waves for r in w if r["ingestion_ts"]])
    schema = FACT_SCHEMA if kind == "fact" else SILVER_SCHEMA
    batch = hourly_fact(rows) if kind == "fact" else silver_from_bronze(rows)
    got = read_closed(spark, path, schema).drop(PROCESSED_AT)
    want = closed_before(batch, at(4, 11)).select(got.columns)
    assert got.count() > 0 and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_watermarked_stream_needs_its_checkpoint(spark, tmp_root):
    source = landed(spark, tmp_root, [snap()])
    assert start_watermarked_fact(source, f"{tmp_root}/out", f"{tmp_root}/one", available_now=True).awaitTermination(300)
    with pytest.raises(ValueError, match="checkpoint"):
        start_watermarked_fact(source, f"{tmp_root}/out", f"{tmp_root}/two", available_now=True)
    with pytest.raises(ValueError, match="checkpoint"):
        start_watermarked_fact(source, f"{tmp_root}/other", "", available_now=True)


# --- Late rows -----------------------------------------------------------------------

def published(spark, root):
    return facts(read_table(spark, FactPaths(root).fact, FACT_SCHEMA).select(FACT_SCHEMA.fieldNames()))


def test_a_late_file_changes_exactly_its_hours(spark, tmp_root):
    root, checkpoint = f"{tmp_root}/inc", f"{tmp_root}/ckpt"

    def run(rows):
        assert start_incremental_fact(landed(spark, tmp_root, rows), root, checkpoint, available_now=True).awaitTermination(300)

    first = [snap(i=f"a{k % 2}", price=float(k + 1), ts=at(h, k, day)) for day in (0, 1) for h in (1, 5, 9) for k in range(6)]
    run(first)
    run([snap(ts=at(20, 0, 1))])
    before = published(spark, root)
    files = {f: os.path.getmtime(f) for f in _files(FactPaths(root).fact)}
    late = [snap(i="a0", price=100.0, ts=at(5, 30, 0)), snap(i="new", price=3.0, ts=at(2, 0, 0))]
    run(late + [snap(ts=at(20, 30, 1)), snap(ts=None, price=4.0)])
    after = published(spark, root)
    day = DAY.date()
    assert {k for k in after if after[k] != before.get(k)} == {("a0", day, 5), ("new", day, 2)}
    assert set(before) <= set(after)
    # The other day was not written again.
    kept = {f for f in files if f"dt={day}" not in f}
    assert kept and all(os.path.exists(f) and os.path.getmtime(f) == files[f] for f in kept)
    counts = [(r.batch_id, r.rows, r.on_time, r.late, r.untimed) for r in read_batches(spark, FactPaths(root)).collect()]
    assert sorted(counts) == [(0, 36, 36, 0, 0), (1, 1, 1, 0, 0), (2, 4, 1, 2, 1)]
    aside = spark.read.parquet(FactPaths(root).late).collect()
    assert sorted((r.id, r.ingestion_ts is None) for r in aside) == [("a", True), ("a0", False), ("new", False)]
    same_facts(after, facts(closed_before(hourly_fact(frame(spark, first + late)), at(19, 30, 1))))


def _files(path):
    return [f"{d}/{f}" for d, _, names in os.walk(path.replace("file:", "")) for f in names if f.endswith(".parquet")]


def test_replayed_batch_leaves_state_record_and_fact_as_they_were(spark, tmp_root):
    process = fact_batch_writer(FactPaths(tmp_root))
    batches = [frame(spark, random_ticks(s, 80, days=1), with_partitions=False) for s in (1, 2)]
    batches.append(frame(spark, [snap(ts=at(23, 59))], with_partitions=False))
    batches.append(frame(spark, random_ticks(3, 40, days=1), with_partitions=False))
    for i, batch in enumerate(batches):
        process(batch, i)
    once = published(spark, tmp_root), sorted(map(str, read_batches(spark, FactPaths(tmp_root)).collect()))
    rows = read_state(spark, FactPaths(tmp_root)).count(), spark.read.parquet(FactPaths(tmp_root).late).count()
    assert rows[1] > 0
    process(batches[-1], len(batches) - 1)
    process(batches[-1].limit(0), len(batches))  # an empty batch writes nothing
    assert (published(spark, tmp_root), sorted(map(str, read_batches(spark, FactPaths(tmp_root)).collect()))) == once
    assert (read_state(spark, FactPaths(tmp_root)).count(), spark.read.parquet(FactPaths(tmp_root).late).count()) == rows


# --- Star ----------------------------------------------------------------------------

def gold(spark, rows):
    df = frame(spark, rows)
    return hourly_fact(df).select(FACT_SCHEMA.fieldNames()), daily_dimension(silver_from_bronze(df)).select(DIMENSION_SCHEMA.fieldNames())


def test_star_keeps_facts_without_a_dimension_row(spark):
    fact, dimension = gold(spark, [snap(i="a", price=2.0, ts=at(1)), snap(i="a", price=4.0, ts=at(2)), snap(i="b", ts=at(1), rank=None)])
    out = {(r.id, r.hour): (r.close_price, r.market_cap_rank) for r in star(fact, dimension.where("id = 'a'")).collect()}
    assert out == {("a", 1): (4.0, 1), ("a", 2): (4.0, 1), ("b", 1): (None, None)}
    assert star(fact, dimension.where("id = 'a'"), keep_unmatched=False).count() == 2
    profile = {r.id: r for r in daily_profile(star(fact, dimension)).collect()}
    assert (profile["a"].hours, profile["a"].snapshots, profile["a"].mean_price) == (2, 2, 3.0)
    assert profile["a"].close_vs_mean_pct == pytest.approx(100 / 3)
    assert star(fact.limit(0), dimension).count() == 0 and star(fact, dimension.limit(0)).count() == 3


def test_star_prunes_days_by_the_filtered_dimension(spark, tmp_root):
    fact, dimension = gold(spark, [snap(i=f"a{k}", rank=k, price=float(d), ts=at(k, 0, d)) for d in range(1, 9) for k in range(1, 5)])
    paths = LayerPaths(tmp_root)
    publish(fact, paths.fact)
    publish(dimension, paths.dimension)
    fact, dimension = read_table(spark, paths.fact, FACT_SCHEMA), read_table(spark, paths.dimension, DIMENSION_SCHEMA)
    out = star(fact, dimension, where=(F.col("current_price") >= 7.5) & (F.col("market_cap_rank") == 2))
    assert "dynamicpruning" in plan_text(out).lower()
    assert [(r.id, r.hour) for r in out.collect()] == [("a2", 2)]
    assert "dynamicpruning" not in plan_text(star(fact, dimension)).lower()  # nothing to prune by


def test_star_of_a_day_that_holds_most_rows(spark):
    rows = [snap(i="hot", price=1.0, ts=at(h, m)) for h in range(24) for m in range(0, 60, 3)]
    rows += [snap(i=f"a{k}", price=2.0, ts=at(3, 0, k)) for k in range(1, 20)]
    df = frame(spark, rows)
    per_minute = df.withColumn("name", F.concat("name", F.minute("ingestion_ts").cast("string")))  # many facts of one asset and day
    fact, dimension = hourly_fact(per_minute), daily_dimension(silver_from_bronze(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan_text(star(fact, dimension))
        out = star(fact, dimension).groupBy("id").agg(F.count("close_price").alias("n"))
        assert {r.id: r.n for r in out.collect()} == {"hot": 480} | {f"a{k}": 1 for k in range(1, 20)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- Rules and counts ----------------------------------------------------------------

def test_rules_are_counted_in_one_pass(spark, tmp_root):
    rows = [snap(i="a"), snap(i="b", price=None), snap(i="c", price=-1.0), snap(i=None, sym="S", rank=None), snap(i="d", ts=at(1, 0, 1)),
            snap(i="e", high_24h=1.0, low_24h=2.0, current_price=1.5, ts=at(1, 0, 1)), snap(i="f", market_cap=None)]
    publish(frame(spark, rows), tmp_root)
    df = spark.read.schema(frame(spark, []).schema).parquet(tmp_root)
    got = {(r.level, str(r.dt), r.rule): (r.rows, r.share) for r in rule_counts(df).collect()}
    one, two = str(DAY.date()), str(at(0, 0, 1).date())
    assert got["total", "None", "(rows)"] == (7, 1.0) and got["day", one, "(rows)"] == (5, 1.0)
    assert got["day", one, "no_price"] == (1, 0.2) and got["total", "None", "no_id"] == (1, 1 / 7)
    assert got["day", one, "price_not_positive"][0] == 1 and got["day", one, "no_rank"][0] == 1
    assert got["day", two, "high_below_low"] == (1, 0.5) and got["day", two, "price_outside_range"] == (1, 0.5)
    assert got["total", "None", "no_measure"][0] == 2 and ("day", two, "no_price") not in got
    assert plan_text(rule_counts(df)).count("Scan parquet") == plan_text(layer_counts(df)).count("Scan parquet") == 2  # tree and detail
    assert rule_counts(df.limit(0)).count() == 0
    assert {r.layer: r.rows for r in layer_counts(df.limit(0)).collect()} == dict.fromkeys(["bronze", "silver", "fact", "dimension"], 0)


# --- Alerts --------------------------------------------------------------------------

def runs_brute(rows, threshold):
    out, by_id = [], {}
    for r in rows:
        if r["id"] is not None and r["ingestion_ts"] is not None and r["current_price"] is not None:
            by_id.setdefault(r["id"], []).append((r["ingestion_ts"], r["current_price"]))
    for i, seen in by_id.items():
        seen.sort()
        run = []
        for (_, before), (time, price) in zip([(None, 0.0), *seen], [*seen, (None, 0.0)]):
            pct = (price / before - 1.0) * 100.0 if before > 0 and time else 0.0
            if abs(pct) >= threshold:
                run.append((time, abs(pct)))
            elif run:
                out.append((i, run[0][0], run[-1][0], len(run), max(p for _, p in run)))
                run = []
    return sorted(out)


def tick_rows(seed, n=300):
    rng = random.Random(seed)
    rows = [snap(i=rng.choice(["a", "b", "c", None]), sym="S", price=rng.choice([1.0, 1.2, 2.0, 5.0, 0.0, None]),
                 ts=at(rng.randrange(24), rng.randrange(60), rng.choice([0, 1, 1, 2, 5]))) for _ in range(n)]
    rows += [snap(i="night", price=float(2 ** k), ts=at(k, 30, -1) + dt.timedelta(hours=k * 5)) for k in range(12)]  # runs on over days
    return rows + [snap(i="a", price=1.0, ts=None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_alert_runs_equal_brute_force(spark, seed):
    rows = tick_rows(seed)
    got = sorted(map(tuple, alert_runs(frame(spark, rows), 50.0).collect()))
    assert got == runs_brute(rows, 50.0)
    assert any(r[0] == "night" and r[1].date() != r[2].date() for r in got)
    assert alert_runs(frame(spark, rows).limit(0)).count() == 0


def test_alerts_partition_by_asset_and_day(spark):
    text = plan_text(moves(frame(spark, tick_rows(1))))
    heavy = [line for line in text.splitlines() if "lag(current_price" in line and "Arguments" in line]
    assert heavy and all("dt#" in line.split("],")[1] for line in heavy)


def test_alert_stream_equals_batch_and_replay_adds_nothing(spark, tmp_root):
    rows = sorted((r for r in tick_rows(3) if r["ingestion_ts"]), key=lambda r: (r["ingestion_ts"], r["current_price"] or 0))
    cut = [0, 100, 101, 220, len(rows)]
    path, checkpoint = f"{tmp_root}/alerts", f"{tmp_root}/ckpt"

    def run(source):
        query = start_alert_stream(source, path, checkpoint, 50.0, available_now=True)
        assert query.awaitTermination(300)

    for a, b in zip(cut, cut[1:]):
        run(landed(spark, tmp_root, rows[a:b]))
    got = runs_of_alerts(read_alerts(spark, path))
    want = runs_brute(rows, 50.0)
    assert sorted(tuple(r[c] for c in ("id", "started_at", "ended_at", "length", "extreme_pct")) for r in got.collect()) == want
    before = read_alerts(spark, path).count()
    run(landing_stream(spark, f"{tmp_root}/landing", TICK_SCHEMA))  # nothing new has landed
    assert read_alerts(spark, path).count() == before
    # A row older than the state cannot be put in order any more.
    run(landed(spark, tmp_root, [snap(i="a", price=50.0, ts=at(0, 0, -9))]))
    late = read_alerts(spark, path).where("late").collect()
    assert [(r.id, r.current_price, r.pct) for r in late] == [("a", 50.0, None)]
    assert sorted(tuple(r[c] for c in ("id", "started_at", "ended_at", "length", "extreme_pct"))
                  for r in runs_of_alerts(read_alerts(spark, path)).collect()) == want


# --- Progress and a clean end --------------------------------------------------------

def test_progress_table_over_restarts(spark, tmp_root):
    for n in (3, 2):
        source = landed(spark, tmp_root, [snap(i=f"a{k}", ts=at(n, k)) for k in range(n)])
        run_until_stopped(spark, lambda: start_alert_stream(source, f"{tmp_root}/a", f"{tmp_root}/c", available_now=True), f"{tmp_root}/p")
    rows = [(r.batch_id, r.rows, r.state_rows) for r in batch_totals(read_progress(spark, f"{tmp_root}/p")).orderBy("batch_id").collect()]
    assert rows == [(0, 3, 3), (1, 2, 3)]
    assert read_progress(spark, f"{tmp_root}/none").count() == 0


def test_marker_ends_a_running_stream_after_its_batch(spark, tmp_root):
    source = landed(spark, tmp_root, [snap(i=f"a{k}") for k in range(4)])
    marker = f"{tmp_root}/stop"
    local = marker.replace("file:", "")
    timer = threading.Timer(4.0, lambda: open(local, "w").close())
    timer.start()
    query = run_until_stopped(
        spark, lambda: start_alert_stream(source, f"{tmp_root}/a", f"{tmp_root}/c", interval="1 seconds"), f"{tmp_root}/p", marker, 1.0)
    timer.join()
    assert not query.isActive and query.exception() is None and not os.path.exists(local)
    assert batch_totals(read_progress(spark, f"{tmp_root}/p")).agg(F.sum("rows")).first()[0] in (4, None)


# --- Deleting orphans ----------------------------------------------------------------

def test_delete_step_believes_nothing_on_the_list(spark, tmp_root):
    paths = LayerPaths(tmp_root)
    df = frame(spark, [snap(ts=at(1))])
    publish(hourly_fact(df).select(*FACT_SCHEMA.fieldNames()), paths.fact)
    root = paths.root.replace("file:", "")
    old = (dt.datetime.now() - dt.timedelta(days=30)).timestamp()
    names = {n: f"{root}/stray {n}.bin" for n in ("gone", "touched", "young", "live", "plain")}
    for f in names.values():
        with open(f, "wb") as out:
            out.write(b"xyz")
        os.utime(f, (old, old))
    results, found = run_vacuum(spark, paths)
    candidates = store_candidates(found, f"{tmp_root}__list")
    assert sorted(r.file_path for r in candidates.collect()) == sorted(names.values())
    live = f"{root}/{paths.silver.rsplit('/', 1)[1]}/dt=2024-01-14/part-0.parquet"
    os.makedirs(os.path.dirname(live))
    os.rename(names["live"], live)  # became part of a table
    moved = spark.createDataFrame([(live, dt.datetime.fromtimestamp(old), 3)], candidates.schema)
    os.utime(names["young"])
    os.utime(names["touched"], (old + 60, old + 60))
    os.remove(names["gone"])
    listed = candidates.unionByName(moved)
    done = {r.file_path: r.status for r in delete_orphans(spark, paths, listed, f"{tmp_root}__done").collect()}
    assert done == {names["plain"]: "deleted", names["gone"]: "missing", names["touched"]: "kept", names["young"]: "kept",
                    names["live"]: "missing", live: "kept"}
    assert not os.path.exists(names["plain"]) and all(os.path.exists(names[n]) for n in ("touched", "young")) and os.path.exists(live)
    again = {r.status for r in delete_orphans(spark, paths, listed, f"{tmp_root}__again").collect()}
    assert again == {"missing", "kept"}  # a repeated task does no harm
    assert read_table(spark, paths.fact, FACT_SCHEMA).count() == 1
