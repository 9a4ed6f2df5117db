"""DuckDB-runnable SQL equivalents of the registered queries (the oracle side of
the correctness check). Views ``events``, ``orders``, ``lineitem`` ... are
registered by the caller over the same parquet files."""

from __future__ import annotations

PAYLOAD = (
    "id, symbol, name, current_price, market_cap, total_volume, price_change_24h, "
    "price_change_percentage_24h, market_cap_rank, high_24h, low_24h"
)

TICKS = """ticks AS (
  SELECT event_id,
         concat('c', CAST(user_id % 60 AS VARCHAR))      AS id,
         concat('s', CAST(user_id % 60 % 20 AS VARCHAR)) AS symbol,
         concat('Asset ', CAST(user_id % 60 AS VARCHAR)) AS name,
         value                                           AS current_price,
         value * 1000.0E0                                AS market_cap,
         CAST(event_id % 997 AS DOUBLE) * 10.0E0         AS total_volume,
         value - 50.0E0                                  AS price_change_24h,
         (value - 50.0E0) / 50.0E0 * 100.0E0             AS price_change_percentage_24h,
         CASE WHEN user_id % 60 % 17 = 0 THEN NULL
              ELSE CAST(floor(user_id % 60 / 2) AS INTEGER) + 1 END AS market_cap_rank,
         value * 1.1E0                                   AS high_24h,
         value * 0.9E0                                   AS low_24h,
         CAST(ts AS TIMESTAMP)                           AS ingestion_ts,
         CAST(ts AS DATE)                                AS dt,
         CAST(extract(hour FROM ts) AS INTEGER)          AS hour
  FROM events)"""

SILVER = f"""silver AS (
  SELECT {PAYLOAD}, ingestion_ts, dt, hour FROM (
    SELECT *, row_number() OVER (PARTITION BY id, dt, hour ORDER BY ingestion_ts DESC) AS rn FROM ticks)
  WHERE rn = 1)"""

DIM = f"""dim AS (
  SELECT {PAYLOAD}, dt FROM (
    SELECT *, row_number() OVER (PARTITION BY id, dt ORDER BY ingestion_ts DESC) AS rn FROM silver)
  WHERE rn = 1),
cur AS (SELECT * FROM dim WHERE dt = (SELECT max(dt) FROM dim)),
top AS (SELECT * FROM cur ORDER BY market_cap_rank ASC NULLS LAST, id LIMIT 20),
top40 AS (SELECT * FROM cur ORDER BY market_cap_rank ASC NULLS LAST, id LIMIT 40)"""


def fact_sql(src: str) -> str:
    return f"""SELECT id, symbol, name, dt, hour,
       count(*) AS total_registros,
       round(avg(current_price), 6) AS preco_medio,
       round(min(current_price), 6) AS preco_min,
       round(max(current_price), 6) AS preco_max,
       round(stddev_samp(current_price), 6) AS preco_desvio,
       round(avg(market_cap), 6) AS market_cap_medio,
       round(avg(total_volume), 6) AS volume_medio,
       round(avg(price_change_24h), 6) AS variacao_24h_media,
       round(avg(price_change_percentage_24h), 6) AS variacao_pct_24h_media,
       round(max(high_24h), 6) AS high_24h,
       round(min(low_24h), 6) AS low_24h,
       round(max(high_24h) - min(low_24h), 6) AS spread_24h,
       round(CASE WHEN avg(current_price) > 0
                  THEN stddev_samp(current_price) / avg(current_price) * 100.0E0
                  ELSE 0.0E0 END, 6) AS volatilidade_relativa
FROM {src} GROUP BY id, symbol, name, dt, hour"""


def _series(cols: str, symbol: str = "'s0'") -> str:
    return f"""WITH {TICKS}, fact AS ({fact_sql('ticks')})
SELECT id, symbol, dt, hour, {cols} FROM fact WHERE symbol = {symbol}"""


_NULLED = """nulled AS (
  SELECT event_id, id, symbol, name,
         CASE WHEN event_id % 11 = 0 OR event_id % 7 = 0 THEN NULL ELSE current_price END AS current_price,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE market_cap END AS market_cap,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE total_volume END AS total_volume,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE price_change_24h END AS price_change_24h,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE price_change_percentage_24h END AS price_change_percentage_24h,
         market_cap_rank,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE high_24h END AS high_24h,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE low_24h END AS low_24h,
         ingestion_ts, dt, hour
  FROM ticks)"""

_MEASURES = ["current_price", "market_cap", "total_volume", "price_change_24h",
             "price_change_percentage_24h", "high_24h", "low_24h"]


def _typed_from_text() -> str:
    m = {c: f"CASE WHEN event_id % 13 = 0 THEN NULL ELSE {c} END AS {c}" for c in _MEASURES}
    return f"""WITH {TICKS}
SELECT id, symbol, name, {m['current_price']}, {m['market_cap']}, {m['total_volume']},
       {m['price_change_24h']}, {m['price_change_percentage_24h']},
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE market_cap_rank END AS market_cap_rank,
       {m['high_24h']}, {m['low_24h']}, ingestion_ts, dt, hour
FROM ticks"""


def _filled() -> str:
    cols = ", ".join(f"coalesce({c}, 0.0E0) AS {c}" for c in _MEASURES)
    return f"""WITH {TICKS}, {_NULLED}
SELECT id, symbol, name, market_cap_rank, {cols}, ingestion_ts FROM nulled"""


ORACLES: dict[str, str] = {
    "silver_dedup": f"WITH {TICKS}, {SILVER} SELECT * FROM silver",
    "gold_hourly_fact_silver": f"WITH {TICKS}, {SILVER} {fact_sql('silver')}",
    "gold_hourly_fact_ticks": f"WITH {TICKS} {fact_sql('ticks')}",
    "gold_daily_dimension": f"WITH {TICKS}, {SILVER}, {DIM} SELECT * FROM dim",
    "silver_typing": _typed_from_text(),
    "serve_top_n": f"WITH {TICKS}, {SILVER}, {DIM} SELECT * FROM top",
    "serve_market_cap": f"""WITH {TICKS}, {SILVER}, {DIM}
SELECT id, symbol, name, market_cap, price_change_percentage_24h FROM top""",
    "serve_variation": f"""WITH {TICKS}, {SILVER}, {DIM}
SELECT id, symbol, price_change_percentage_24h FROM top""",
    "serve_top_spread": f"""WITH {TICKS}, {SILVER}, {DIM}
SELECT id, symbol, round(high_24h - low_24h, 6) AS spread_24h FROM top40
ORDER BY high_24h - low_24h DESC NULLS LAST, id LIMIT 20""",
    "serve_kpis": f"""WITH {TICKS}, {SILVER}, {DIM}
SELECT count(*) AS moedas_rastreadas,
       round(sum(market_cap), 6) AS market_cap_total,
       round(sum(total_volume), 6) AS volume_24h_total,
       round(max(price_change_percentage_24h), 6) AS maior_variacao_24h
FROM cur""",
    "serve_symbols": f"WITH {TICKS} SELECT DISTINCT symbol FROM ticks",
    "serve_hourly_series": _series("preco_medio, preco_max, preco_min"),
    "serve_hourly_volume": _series("volume_medio"),
    "serve_hourly_volatility": _series("volatilidade_relativa"),
    "serve_default_series": _series("preco_medio, preco_max, preco_min", "(SELECT min(symbol) FROM ticks)"),
    "bronze_page_explode": f"WITH {TICKS} SELECT {PAYLOAD} FROM ticks",
    "bronze_null_fill": _filled(),
    "bronze_metadata": f"WITH {TICKS} SELECT {PAYLOAD}, ingestion_ts, dt, hour FROM ticks",
    "bronze_metadata_keep_nulls": f"WITH {TICKS}, {_NULLED} SELECT {PAYLOAD}, ingestion_ts, dt, hour FROM nulled",
    "bronze_partition_scan": f"""WITH {TICKS}
SELECT {PAYLOAD}, date_trunc('millisecond', ingestion_ts) AS ingestion_ts, dt, hour
FROM ticks WHERE dt = DATE '2024-01-15'""",
    "bronze_stream_ingest": f"""WITH {TICKS}
SELECT {PAYLOAD}, date_trunc('millisecond', ingestion_ts) AS ingestion_ts, dt, hour FROM ticks""",
    "landing_ndjson_roundtrip": f"""WITH {TICKS}
SELECT {PAYLOAD}, fetched AS ingestion_ts, CAST(fetched AS DATE) AS dt,
       CAST(extract(hour FROM fetched) AS INTEGER) AS hour
FROM (SELECT *, max(ingestion_ts) OVER (PARTITION BY event_id // 250) AS fetched FROM ticks)""",
    "silver_publish_roundtrip": f"WITH {TICKS}, {SILVER} SELECT * FROM silver",
    "silver_daily_filter": f"WITH {TICKS}, {SILVER} SELECT * FROM silver WHERE dt = DATE '2024-01-15'",
    "gold_publish_roundtrip": f"WITH {TICKS}, {SILVER} {fact_sql('silver')}",
    "gold_dimension_roundtrip": f"WITH {TICKS}, {SILVER}, {DIM} SELECT * FROM dim",
    "daily_job_run": f"WITH {TICKS}, {SILVER} SELECT *, TRUE AS healthy, 0 AS orphans FROM ({fact_sql('silver')})",
    "maint_compact": f"WITH {TICKS} SELECT {PAYLOAD}, ingestion_ts, dt, hour, TRUE AS fewer_files FROM ticks",
    "maint_vacuum": f"WITH {TICKS} SELECT 'old export/dt=' || dt AS folder, 1 AS files FROM ticks GROUP BY dt",
    "maint_file_stats": f"WITH {TICKS} SELECT dt, count(*) AS rows, TRUE AS sound FROM ticks GROUP BY dt",
    "bronze_page_stream": f"WITH {TICKS} SELECT {PAYLOAD} FROM ticks",
    "maint_expired_snapshots": """WITH log AS (
  SELECT o_orderstatus AS table_name, o_orderkey AS snapshot_id,
         CAST(o_orderdate AS TIMESTAMP) AS committed_at FROM orders),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY committed_at DESC, snapshot_id DESC) AS rn
  FROM log)
SELECT table_name, snapshot_id, committed_at FROM ranked
WHERE committed_at < TIMESTAMP '2001-07-25' AND rn > 1""",
    "maint_orphan_files": """SELECT o_orderkey AS file_path, CAST(o_orderdate AS TIMESTAMP) AS modified_at
FROM orders o
WHERE CAST(o_orderdate AS TIMESTAMP) < TIMESTAMP '2001-07-29'
  AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
    "maint_vacuum_days": f"WITH {TICKS} SELECT DISTINCT dt FROM ticks WHERE isodow(dt) = 7",
    "quality_row_counts": f"""WITH {TICKS}
SELECT 'bronze' AS layer, count(*) AS rows FROM ticks
UNION ALL SELECT 'silver', count(*) FROM (SELECT DISTINCT id, dt, hour FROM ticks)
UNION ALL SELECT 'fact', count(*) FROM (SELECT DISTINCT id, symbol, name, dt, hour FROM ticks)
UNION ALL SELECT 'dimension', count(*) FROM (SELECT DISTINCT id, dt FROM ticks)""",
}
