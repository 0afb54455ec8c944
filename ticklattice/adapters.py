"""Views of the driver's tables in lane shape, in SQL that Spark and DuckDB both run.

{MS} is the engine's expression for epoch milliseconds of events.ts.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SPARK_MS, DUCK_MS = "unix_millis(CAST(ts AS TIMESTAMP))", "(epoch_us(ts) // 1000)"

VIEWS = {
    "ev": """
        SELECT event_id, event_type AS symbol, {MS} AS timestamp_ms, user_id, value, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events
    """,
    "v_trades": """
        SELECT symbol, timestamp_ms, event_id AS trade_id, event_id * 2 AS seq, CASE WHEN event_id % 503 = 0 THEN 'Buy' WHEN event_id % 2 = 0 THEN 'buy' ELSE
        'sell' END AS side, value AS price, CASE WHEN event_id % 509 = 0 THEN 0e0 ELSE CAST(k + 1 AS DOUBLE) END AS quantity FROM ev UNION ALL SELECT symbol,
        timestamp_ms, event_id, event_id * 2 + 1, 'buy', value, CAST(k + 1 AS DOUBLE) FROM ev WHERE event_id % 997 = 0
    """,
    "v_diffs": """
        SELECT symbol, timestamp_ms, u, CASE WHEN event_id % 97 = 0 THEN pu0 - 1 ELSE pu0 END AS pu, side, price, qty FROM (SELECT event_id, symbol,
        timestamp_ms, event_id + 1 AS u, lag(event_id + 1) OVER (PARTITION BY symbol ORDER BY event_id) AS pu0, CASE WHEN event_id % 2 = 0 THEN 'bid' ELSE
        'ask' END AS side, CAST(CASE WHEN event_id % 194 IN (0,20,40,60,80,100,120) THEN 97 WHEN event_id % 2 = 0 THEN 36 + CAST(floor(value) AS BIGINT) % 59
        ELSE 96 + CAST(floor(value) AS BIGINT) % 60 END AS DOUBLE) AS price, CAST(CASE WHEN event_id % 194 = 0 THEN 1 WHEN event_id % 194 IN
        (20,40,60,80,100,120) THEN 0 ELSE k % 10 END AS DOUBLE) AS qty FROM ev) t
    """,
    "v_snaps": """
        SELECT s.symbol, e.timestamp_ms, e.event_id + 1 AS last_update_id, CASE WHEN p.i < 2 THEN 'bid' ELSE 'ask' END AS side, CAST(94 + p.i AS DOUBLE) AS
        price, CAST(p.i + 1 AS DOUBLE) AS qty FROM (SELECT max(timestamp_ms) AS timestamp_ms, max(event_id) AS event_id FROM ev GROUP BY
        timestamp_ms - timestamp_ms % 25200000) e CROSS JOIN (SELECT DISTINCT symbol FROM ev) s CROSS JOIN (SELECT 0 AS i UNION ALL SELECT 1 UNION ALL
        SELECT 2 UNION ALL SELECT 3) p
    """,
    "v_bars": """
        SELECT symbol, timestamp_ms - timestamp_ms % 3600000 AS timestamp_ms, min_by(value, event_id) AS open, max(value) AS high, CASE WHEN min(event_id) %
        211 = 0 THEN max(value) + 1e0 ELSE min(value) END AS low, max_by(value, event_id) AS close, CAST(sum(k + 1) AS DOUBLE) AS volume FROM ev GROUP BY
        symbol, timestamp_ms - timestamp_ms % 3600000
    """,
    "v_liquidations": """
        SELECT symbol, timestamp_ms, event_id AS seq, CASE WHEN event_id % 20 = 0 THEN 'sell' ELSE 'buy' END AS side, value AS price, CAST(k + 1 AS DOUBLE) AS
        quantity, value * (k + 1) * CASE WHEN event_id % 70 = 0 THEN 15e-1 ELSE 1e0 END AS value FROM ev
    """,
    "v_funding": """
        SELECT symbol, timestamp_ms, event_id AS seq, CASE WHEN event_id % 221 = 0 THEN 35e-1 ELSE value / 1e5 END AS funding_rate, timestamp_ms -
        timestamp_ms % 28800000 + 28800000 AS next_funding_time FROM ev
    """,
    "v_open_interest": """
        SELECT symbol, timestamp_ms, event_id AS seq, value AS mark_price, CAST((k + 1) * 10 AS DOUBLE) AS open_interest, value * ((k + 1) * 10) * CASE WHEN
        event_id % 121 = 0 THEN 2e0 ELSE 1e0 END AS oi_value FROM ev
    """,
    "v_long_short": """
        SELECT symbol, timestamp_ms, event_id AS seq, CASE event_id % 3 WHEN 0 THEN 'global' WHEN 1 THEN 'top_trader_account' ELSE 'top_trader_position' END
        AS ratio_type, 3e-1 + (k % 41) / 1e2 AS long_ratio, 7e-1 - (k % 41) / 1e2 + CASE WHEN event_id % 77 = 0 THEN 1e-1 ELSE 0e0 END AS short_ratio, (3e-1 +
        (k % 41) / 1e2) / (7e-1 - (k % 41) / 1e2) AS long_short_ratio FROM ev
    """,
    "v_taker": """
        SELECT symbol, timestamp_ms, event_id AS seq, CAST(k + 1 AS DOUBLE) AS buy_volume, value AS sell_volume, CASE WHEN event_id % 65 = 0 THEN 99e-1 WHEN
        value <> 0 THEN (k + 1) / value END AS buy_sell_ratio FROM ev
    """,
    "v_requests": """
        SELECT event_id, timestamp_ms, symbol AS endpoint, user_id % 10 AS route, event_id % 19 <> 0 AS success, CASE k % 4 WHEN 0 THEN 2 WHEN 1 THEN 5 WHEN 2
        THEN 10 ELSE 20 END AS weight FROM ev
    """,
    "v_contracts": """
        SELECT concat('P', CAST(p_partkey AS VARCHAR(20)), 'USDT') AS symbol, CASE WHEN p_size % 10 = 0 THEN 'BREAK' ELSE 'TRADING' END AS status, CASE WHEN
        p_size % 7 = 0 THEN 'CURRENT_QUARTER' ELSE 'PERPETUAL' END AS contract_type, CASE WHEN p_size % 11 = 0 THEN 'PREMARKET' WHEN p_size % 2 = 0 THEN NULL
        ELSE 'COIN' END AS underlying_type, concat(CASE WHEN p_partkey % 50 = 0 THEN '1000' WHEN p_partkey % 51 = 0 THEN '10000' ELSE '' END, 'P',
        CAST(p_partkey AS VARCHAR(20))) AS base_asset, CASE WHEN p_size % 13 = 0 THEN 'USDC' ELSE 'USDT' END AS quote_asset FROM part
    """,
    "v_log_lines": """
        SELECT conv_id AS file_name, turn AS seq, CASE WHEN turn % 3 = 1 THEN NULL WHEN role = 'user' THEN 'WARN' ELSE 'INFO' END AS level,
        text AS line FROM conversations
    """,
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "conversations")


def needed(sql: str) -> list[str]:
    """Views that a statement reads, each after those it reads itself."""
    found: list[str] = []
    for name in VIEWS:
        if re.search(rf"\b{name}\b", sql):
            found += [x for x in [*needed(VIEWS[name]), name] if x not in found]
    return found


def duck(sql: str) -> str:
    """The statement for DuckDB, with the views it reads as common table expressions."""
    with_views = ", ".join(f"{name} AS ({' '.join(VIEWS[name].split())})" for name in needed(sql))
    body = " ".join(sql.split())
    if not with_views:
        return body
    if body.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {with_views}, {body[15:]}".replace("{MS}", DUCK_MS)
    full = f"WITH {with_views}, {body[5:]}" if body.startswith("WITH ") else f"WITH {with_views} {body}"
    return full.replace("{MS}", DUCK_MS)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One adapter view (or table) as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name].replace("{MS}", SPARK_MS)
    inner = {x: view(spark, sf_dir, x) for x in (*VIEWS, *TABLES) if x != name and re.search(rf"(FROM|JOIN) {x}\b", text)}
    for x in inner:
        text = re.sub(rf"(FROM|JOIN) {x}\b", rf"\1 {{{x}}}", text)
    return spark.sql(text, **inner)
