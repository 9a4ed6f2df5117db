"""DuckDB SQL of the queries in ``catalog_events``."""

from __future__ import annotations

from marketlake.oracles import DIM, SILVER, TICKS, fact_sql

_CLOSED = "dt + to_hours(hour + 1) <= (SELECT max(ingestion_ts) FROM ticks) - INTERVAL 1 HOUR"

# Waves as the rows land; every 50th event is held back to the last one.
_LANDED = """landed AS (
  SELECT *, CASE WHEN event_id % 50 = 0 OR dt >= DATE '2024-01-21' THEN 2 WHEN dt >= DATE '2024-01-11' THEN 1 ELSE 0 END AS wave
  FROM ticks),
marks AS (
  SELECT wave, max(max(ingestion_ts)) OVER (ORDER BY wave ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 HOUR AS mark
  FROM landed GROUP BY wave)"""

_RUNS = """seen AS (
  SELECT id, ingestion_ts, current_price, lag(current_price) OVER w AS before, row_number() OVER w AS n
  FROM ticks WINDOW w AS (PARTITION BY id ORDER BY ingestion_ts, current_price)),
moved AS (
  SELECT *, CASE WHEN before > 0 THEN (current_price / before - 1.0E0) * 100.0E0 END AS pct FROM seen),
large AS (
  SELECT *, n - row_number() OVER (PARTITION BY id ORDER BY n) AS run FROM moved WHERE abs(pct) >= 50),
runs AS (
  SELECT id, min(ingestion_ts) AS started_at, max(ingestion_ts) AS ended_at, count(*) AS length, round(max(abs(pct)), 6) AS extreme_pct
  FROM large GROUP BY id, run)"""

_FAULTY = """faulty AS (
  SELECT event_id, id, ingestion_ts, market_cap_rank, dt, total_volume, price_change_24h, price_change_percentage_24h,
         CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 13 = 0 THEN -current_price ELSE current_price END AS price,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE market_cap END AS cap,
         CASE WHEN event_id % 17 = 0 THEN low_24h ELSE high_24h END AS high,
         CASE WHEN event_id % 17 = 0 THEN high_24h ELSE low_24h END AS low
  FROM ticks),
broken AS (
  SELECT dt, '(rows)' AS rule FROM faulty
  UNION ALL SELECT dt, 'no_rank' FROM faulty WHERE market_cap_rank IS NULL
  UNION ALL SELECT dt, 'no_measure' FROM faulty WHERE price IS NULL OR cap IS NULL
  UNION ALL SELECT dt, 'no_price' FROM faulty WHERE price IS NULL
  UNION ALL SELECT dt, 'price_not_positive' FROM faulty WHERE price <= 0
  UNION ALL SELECT dt, 'high_below_low' FROM faulty WHERE high < low
  UNION ALL SELECT dt, 'price_outside_range' FROM faulty WHERE price > high OR price < low),
counted AS (
  SELECT CASE WHEN grouping(dt) = 1 THEN 'total' ELSE 'day' END AS level, dt, rule, count(*) AS rows
  FROM broken GROUP BY GROUPING SETS ((rule, dt), (rule)))"""

_STAR = f"""fact AS ({fact_sql('ticks')}),
star AS (
  SELECT f.*, d.market_cap_rank, d.current_price AS close_price, d.market_cap AS close_market_cap, d.total_volume AS close_volume
  FROM fact f LEFT JOIN dim d USING (id, dt))"""

ORACLES: dict[str, str] = {
    "stream_hourly_fact": f"WITH {TICKS} SELECT * FROM ({fact_sql('ticks')}) WHERE {_CLOSED}",
    "stream_incremental_fact": f"WITH {TICKS} SELECT * FROM ({fact_sql('ticks')}) WHERE {_CLOSED}",
    "stream_late_rows": f"""WITH {TICKS}, {_LANDED}
SELECT wave AS batch_id, count(*) AS rows, count(*) - count(*) FILTER (dt + to_hours(hour + 1) <= mark) AS on_time,
       count(*) FILTER (dt + to_hours(hour + 1) <= mark) AS late, 0 AS untimed
FROM landed JOIN marks USING (wave) GROUP BY wave""",
    "fact_state_merge": f"WITH {TICKS} {fact_sql('ticks')}",
    "stream_silver_dedup": f"WITH {TICKS}, {SILVER} SELECT * FROM silver WHERE {_CLOSED}",
    "star_join": f"""WITH {TICKS}, {SILVER}, {DIM},
p AS (
  SELECT id, symbol, name, dt, count(DISTINCT hour) AS hours, count(*) AS snapshots, min(current_price) AS low,
         max(current_price) AS high, avg(current_price) AS mean_price
  FROM ticks GROUP BY id, symbol, name, dt)
SELECT p.id, p.symbol, p.name, dt, d.market_cap_rank, round(d.current_price, 6) AS close_price,
       round(d.market_cap, 6) AS close_market_cap, round(d.total_volume, 6) AS close_volume, hours, snapshots, round(low, 6) AS low,
       round(high, 6) AS high, round(mean_price, 6) AS mean_price,
       round((d.current_price - mean_price) / mean_price * 100.0E0, 6) AS close_vs_mean_pct
FROM p LEFT JOIN dim d USING (id, dt)""",
    "star_top_assets": f"""WITH {TICKS}, {SILVER}, {DIM}, {_STAR}
SELECT id, dt, hour, market_cap_rank, round(close_price, 6) AS close_price, preco_medio, preco_max
FROM star WHERE market_cap_rank <= 3 AND close_price >= 90""",
    "quality_rules": f"""WITH {TICKS}, {_FAULTY}
SELECT c.level, c.dt, c.rule, c.rows, round(c.rows / a.rows, 6) AS share
FROM counted c JOIN counted a ON a.rule = '(rows)' AND a.level = c.level AND a.dt IS NOT DISTINCT FROM c.dt""",
    "alert_runs": f"WITH {TICKS}, {_RUNS} SELECT * FROM runs",
    "stream_alert_runs": f"WITH {TICKS}, {_RUNS} SELECT * FROM runs",
    "maint_delete_orphans": f"""WITH {TICKS}
SELECT dt, CASE WHEN dt = DATE '2024-01-15' THEN 'kept' ELSE 'deleted' END AS status, 1 AS files FROM ticks GROUP BY dt""",
    "stream_progress": f"""WITH {TICKS},
waves AS (
  SELECT *, CASE WHEN dt >= DATE '2024-01-21' THEN 2 WHEN dt >= DATE '2024-01-11' THEN 1 ELSE 0 END AS wave FROM ticks),
firsts AS (SELECT id, min(wave) AS wave FROM waves GROUP BY id)
SELECT wave AS batch_id, count(*) AS rows, (SELECT count(*) FROM firsts f WHERE f.wave <= w.wave) AS state_rows, 0 AS dropped_rows
FROM waves w GROUP BY wave""",
}
