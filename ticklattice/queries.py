"""Registered queries: each applies operators to adapter views of the driver's tables, with an equivalent for DuckDB."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import functions as fn
from .adapters import duck, view
from .operators import aggregates as agg
from .operators import book, filters, joins, quality, windows
from .operators.filters import MAX_SYMBOLS
from .plans import coverage, merged_matrix, replay_at, replay_day, request_audit, soak_report, symbol_detail
from .schemas import DAY, HOUR, RATIO_TYPES
from .sources import messages
from .sources.lanes import health, is_live
from .sources.sinks import export_book, export_bundle
from .streaming import ingest, state

#: Instants inside the tables' month, and the time at which "now" is asked.
T = 1_705_320_000_000
FROM, TO = 1_705_000_000_000, 1_705_600_000_000
NOW = 1_706_572_800_000
#: The end of that month, and the age at which a lane is quiet.
END, QUIET_AGE = 1_706_659_200_000, 25 * 60_000
WINDOWS = {"trades": HOUR, "orderbooks": 2 * HOUR, "liquidations": 3 * HOUR, "funding_rates": 8 * HOUR}
LANE_VIEWS = {"trades": "v_trades", "orderbooks": "v_diffs", "liquidations": "v_liquidations", "funding_rates": "v_funding"}

_found: dict[str, tuple[Callable, str | None]] = {}
_text: dict[str, str | None] = {}


def query(sql: str | None = None):
    def put(f: Callable) -> Callable:
        _found[f.__name__] = (f, duck(sql) if sql else None)
        _text[f.__name__] = sql
        return f

    return put


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import lake_queries  # noqa: F401  (registers those that go through files)

    return {name: f for name, (f, _) in _found.items()}


def oracle_sql() -> dict[str, str]:
    from . import lake_queries  # noqa: F401

    return {name: sql for name, (_, sql) in _found.items() if sql}


def lanes(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {lane: view(spark, d, v) for lane, v in LANE_VIEWS.items()}


ROWS = "rows_ AS (" + " UNION ALL ".join(f"SELECT '{lane}' AS lane, symbol, timestamp_ms FROM {v}" for lane, v in LANE_VIEWS.items()) + ")"
SEEN = "seen AS (SELECT lane, symbol, max(timestamp_ms) AS last_ms FROM rows_ GROUP BY lane, symbol)"
WINDOW_CASE = "CASE lane " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in WINDOWS.items()) + " END"
DAY_MS = f"timestamp_ms - timestamp_ms % {DAY}"


def events_of(spark: SparkSession, d: str) -> DataFrame:
    """Diffs as level events."""
    return view(spark, d, "v_diffs").select("symbol", "timestamp_ms", "u", F.col("u").alias("seq"), "side", F.lit(0).alias("pos"), "price", "qty")


def diffs_of(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_diffs").select("symbol", "timestamp_ms", "u", "pu", F.col("u").alias("first_u"), F.col("u").alias("seq"))


# ---- grids, bars, as-of joins -------------------------------------------------------------------------------------------


@query(f"SELECT symbol, timestamp_ms - timestamp_ms % {HOUR} AS timestamp_ms, count(*) AS n FROM v_trades GROUP BY 1, 2")
def e01_bucket(spark, d):
    return view(spark, d, "v_trades").groupBy("symbol", fn.bucket(F.col("timestamp_ms"), HOUR).alias("timestamp_ms")).agg(F.count("*").alias("n"))


VWAP = "CAST(sum(CAST(price * quantity AS DECIMAL(28,8))) AS DOUBLE) / nullif(CAST(sum(CAST(quantity AS DECIMAL(28,8))) AS DOUBLE), 0)"


@query(f"SELECT symbol, timestamp_ms - timestamp_ms % {HOUR} AS timestamp_ms, count(*) AS trade_count, {VWAP} AS trade_vwap FROM v_trades GROUP BY 1, 2")
def e02_trade_buckets(spark, d):
    return agg.trade_buckets(view(spark, d, "v_trades"), HOUR)


@query(f"SELECT symbol, timestamp_ms - timestamp_ms % {HOUR} AS timestamp_ms, count(*) AS liq_count, CAST(sum(CAST(coalesce(value, 0) AS DECIMAL(28,8))) AS DOUBLE) AS liq_value FROM v_liquidations GROUP BY 1, 2")
def e03_liq_buckets(spark, d):
    return agg.liq_buckets(view(spark, d, "v_liquidations"), HOUR)


GRID = f"grid AS (SELECT symbol, unnest(range({FROM - FROM % HOUR}, {TO + 1}, {HOUR})) AS timestamp_ms FROM (SELECT DISTINCT symbol FROM v_trades))"


def grid_of(spark: SparkSession, d: str) -> DataFrame:
    return joins.grid_for(spark, view(spark, d, "v_trades").select("symbol").distinct(), FROM, TO, HOUR)


@query(f"WITH {GRID} SELECT symbol, timestamp_ms FROM grid")
def d02_grid(spark, d):
    return grid_of(spark, d)


@query(f"WITH {GRID}, b AS (SELECT symbol, timestamp_ms - timestamp_ms % {HOUR} AS timestamp_ms, count(*) AS trade_count, {VWAP} AS trade_vwap FROM v_trades GROUP BY 1, 2) SELECT grid.symbol, grid.timestamp_ms, trade_count, trade_vwap FROM grid LEFT JOIN b USING (symbol, timestamp_ms)")
def d01_trade_grid(spark, d):
    return grid_of(spark, d).join(agg.trade_buckets(view(spark, d, "v_trades"), HOUR), ["symbol", "timestamp_ms"], "left")


@query(f"WITH {GRID} SELECT grid.symbol, grid.timestamp_ms, open, close, volume FROM grid LEFT JOIN v_bars b USING (symbol, timestamp_ms)")
def d03_join_bars(spark, d):
    bars = view(spark, d, "v_bars").withColumn("seq", F.col("timestamp_ms"))
    return joins.join_bars(grid_of(spark, d), bars, {"open": "open", "close": "close", "volume": "volume"}, HOUR)


def _asof_sql(v: str, col: str, tolerance: int) -> str:
    return f"WITH {GRID}, r AS (SELECT symbol, timestamp_ms AS at_ms, arg_max({col}, seq) AS {col} FROM {v} GROUP BY 1, 2) SELECT grid.symbol, grid.timestamp_ms, CASE WHEN grid.timestamp_ms - at_ms <= {tolerance} THEN {col} END AS {col}, CASE WHEN grid.timestamp_ms - at_ms <= {tolerance} THEN at_ms END AS matched_ms FROM grid ASOF LEFT JOIN r ON grid.symbol = r.symbol AND grid.timestamp_ms >= r.at_ms"


@query(_asof_sql("v_funding", "funding_rate", 8 * HOUR))
def d04_asof_funding(spark, d):
    return joins.asof_join(grid_of(spark, d), view(spark, d, "v_funding"), {"funding_rate": "funding_rate"}, 8 * HOUR)


@query(_asof_sql("v_open_interest", "open_interest", HOUR))
def d04_asof_open_interest(spark, d):
    return joins.asof_join(grid_of(spark, d), view(spark, d, "v_open_interest"), {"open_interest": "open_interest"}, HOUR)


TOPS = "tops AS (SELECT symbol, timestamp_ms AS at_ms, max(CASE WHEN side = 'bid' THEN price END) AS best_bid, min(CASE WHEN side = 'ask' THEN price END) AS best_ask FROM v_snaps GROUP BY 1, 2)"


@query(f"WITH {GRID}, {TOPS}, m AS (SELECT grid.symbol, grid.timestamp_ms, CASE WHEN grid.timestamp_ms - at_ms <= {DAY} THEN best_bid END AS b, CASE WHEN grid.timestamp_ms - at_ms <= {DAY} THEN best_ask END AS a, CASE WHEN grid.timestamp_ms - at_ms <= {DAY} THEN at_ms END AS matched_ms FROM grid ASOF LEFT JOIN tops ON grid.symbol = tops.symbol AND grid.timestamp_ms >= tops.at_ms) SELECT symbol, timestamp_ms, CASE WHEN a IS NOT NULL THEN b END AS best_bid, CASE WHEN b IS NOT NULL THEN a END AS best_ask, matched_ms FROM m")
def d05_asof_book(spark, d):
    return joins.asof_book(grid_of(spark, d), agg.top_of_book(view(spark, d, "v_snaps")), DAY)


@query(f"SELECT symbol, arg_max(funding_rate, timestamp_ms * 1000000 - seq % 1000000) AS funding_rate, max(timestamp_ms) AS timestamp_ms FROM v_funding WHERE timestamp_ms BETWEEN {T - T % DAY - DAY} AND {T} GROUP BY symbol")
def d06_asof_point(spark, d):
    return joins.asof_point(view(spark, d, "v_funding"), T, ["funding_rate"])


@query(f"SELECT symbol, arg_max(long_short_ratio, seq) AS long_short_ratio, arg_max(timestamp_ms, seq) AS timestamp_ms FROM v_long_short WHERE ratio_type = 'global' AND timestamp_ms BETWEEN {T - T % DAY - DAY} AND {T} GROUP BY symbol")
def d07_asof_ratio(spark, d):
    return joins.asof_ratio(view(spark, d, "v_long_short"), T, ["long_short_ratio"])


@query(f"WITH seen AS (SELECT DISTINCT symbol FROM v_trades), fresh AS (SELECT symbol FROM v_trades GROUP BY symbol HAVING {END} - max(timestamp_ms) < {QUIET_AGE}), b AS (SELECT symbol FROM v_diffs GROUP BY symbol HAVING {END} - max(timestamp_ms) < {HOUR}) SELECT symbol FROM seen WHERE symbol NOT IN (SELECT symbol FROM fresh) AND symbol IN (SELECT symbol FROM b)")
def d09_quiet_symbols(spark, d):
    age = lambda v: view(spark, d, v).groupBy("symbol").agg((END - F.max("timestamp_ms")).alias("age"))
    return joins.quiet_symbols(view(spark, d, "v_trades"), age("v_trades").filter(F.col("age") < QUIET_AGE), age("v_diffs").filter(F.col("age") < HOUR))


# ---- filters and sets ---------------------------------------------------------------------------------------------------


@query(f"SELECT symbol, timestamp_ms, trade_id, seq, side, price, quantity FROM v_trades WHERE timestamp_ms BETWEEN {FROM} AND {TO}")
def c01_time_slice(spark, d):
    return filters.time_slice(view(spark, d, "v_trades"), FROM, TO).select("symbol", "timestamp_ms", "trade_id", "seq", "side", "price", "quantity")


TEXTS = "CASE event_id % 5 WHEN 0 THEN CAST({MS} AS VARCHAR(20)) WHEN 1 THEN CAST({MS} // 1000 AS VARCHAR(20)) WHEN 2 THEN 'garbage' WHEN 3 THEN '0' ELSE '4999999999999' END"


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN timestamp_ms WHEN 1 THEN timestamp_ms // 1000 * 1000 END AS ms FROM ev")
def c04_parse_instant(spark, d):
    k, ms = F.col("event_id") % 5, F.col("timestamp_ms")
    text = F.when(k == 0, ms.cast("string")).when(k == 1, F.floor(ms / 1000).cast("string")).when(k == 2, "garbage").when(k == 3, "0").otherwise("4999999999999")
    return view(spark, d, "ev").select("event_id", fn.parse_instant(text).alias("ms"))


@query("SELECT count(*) FILTER (WHERE regexp_matches(p_name, '^[A-Za-z0-9]{1,24}$')) AS named, count(*) FILTER (WHERE regexp_matches(p_brand, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')) AS dated FROM part")
def c06_valid_parts(spark, d):
    return view(spark, d, "part").agg(F.count_if(fn.valid_symbol(F.col("p_name"))).alias("named"), F.count_if(fn.valid_date(F.col("p_brand"))).alias("dated"))


@query(f"SELECT symbol, user_id, timestamp_ms FROM (SELECT *, max(timestamp_ms) OVER (PARTITION BY symbol, user_id) AS m FROM ev) WHERE timestamp_ms < m")
def c08_drop_open_bucket(spark, d):
    return filters.drop_open_bucket(view(spark, d, "ev"), ["symbol", "user_id"]).select("symbol", "user_id", "timestamp_ms")


UNIVERSE = "uni AS (SELECT DISTINCT symbol FROM ev WHERE k % 2 = 0 AND symbol < 's')"


@query("SELECT count(*) AS n, sum(seq)::BIGINT AS ids FROM v_liquidations WHERE symbol IN (SELECT symbol FROM ev WHERE value > 300 OR symbol < 'l')")
def c09_in_universe(spark, d):
    universe = view(spark, d, "ev").filter("value > 300 or symbol < 'l'").select("symbol").distinct()
    return filters.in_universe(view(spark, d, "v_liquidations"), universe).agg(F.count("*").alias("n"), F.sum("seq").alias("ids"))


@query("SELECT symbol, timestamp_ms, funding_rate FROM v_funding WHERE symbol IN (SELECT symbol FROM ev WHERE symbol < 's') AND symbol NOT IN (SELECT symbol FROM ev WHERE symbol < 'd')")
def c10_universe_not_delisted(spark, d):
    names = view(spark, d, "ev").select("symbol").distinct()
    return filters.in_universe_not_delisted(view(spark, d, "v_funding"), names.filter("symbol < 's'"), names.filter("symbol < 'd'")).select("symbol", "timestamp_ms", "funding_rate")


@query("SELECT symbol, timestamp_ms, open_interest FROM v_open_interest WHERE symbol >= 'd'")
def c11_drop_delisted(spark, d):
    return filters.drop_delisted(view(spark, d, "v_open_interest"), view(spark, d, "ev").filter("symbol < 'd'").select("symbol").distinct()).select("symbol", "timestamp_ms", "open_interest")


@query("SELECT symbol, trade_id, seq FROM v_trades WHERE symbol >= 'd'")
def b05_drop_unpersisted(spark, d):
    names = view(spark, d, "ev").filter("symbol < 'd'").select(F.upper("symbol").alias("symbol")).distinct()
    return filters.drop_unpersisted(view(spark, d, "v_trades"), names).select("symbol", "trade_id", "seq")


TRADABLE = "status = 'TRADING' AND contract_type = 'PERPETUAL' AND quote_asset = 'USDT' AND underlying_type IS DISTINCT FROM 'PREMARKET'"


@query(f"SELECT symbol, base_asset FROM v_contracts WHERE {TRADABLE}")
def c12_tradable(spark, d):
    return filters.tradable(view(spark, d, "v_contracts")).select("symbol", "base_asset")


LISTS = {"stable": "p_size = 1", "large": "p_size IN (2, 3, 4)", "exceptions": "p_size = 4", "symbols": "p_size = 5", "anchors": "p_size IN (7, 10, 30)"}
BASE = "regexp_replace(upper(base_asset), '^(1000000|10000|1000)(P)', '\\2')"
EXCLUDED = f"SELECT symbol FROM v_contracts WHERE {TRADABLE} AND {BASE} NOT IN (SELECT concat('P', p_partkey) FROM part WHERE p_size IN (1, 2, 3)) AND symbol NOT IN (SELECT concat('P', p_partkey, 'USDT') FROM part WHERE p_size = 5)"


def lists_of(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    part = view(spark, d, "part")
    name = lambda k: F.concat(F.lit("P"), F.col("p_partkey").cast("string"), F.lit("USDT" if k in ("symbols", "anchors") else ""))
    return {k: part.filter(where).select(name(k).alias("name")) for k, where in LISTS.items()}


@query(EXCLUDED)
def c13_apply_exclusions(spark, d):
    x = lists_of(spark, d)
    return filters.apply_exclusions(filters.tradable(view(spark, d, "v_contracts")), x["stable"], x["large"], x["exceptions"], x["symbols"]).select("symbol")


@query(f"{EXCLUDED} UNION SELECT symbol FROM v_contracts WHERE status = 'TRADING' AND symbol IN (SELECT concat('P', p_partkey, 'USDT') FROM part WHERE p_size IN (7, 10, 30))")
def c14_with_anchors(spark, d):
    return filters.with_anchors(c13_apply_exclusions(spark, d), view(spark, d, "v_contracts"), lists_of(spark, d)["anchors"])


@query(f"SELECT lower(symbol) AS symbol FROM ({EXCLUDED} UNION SELECT symbol FROM v_contracts WHERE status = 'TRADING' AND symbol IN (SELECT concat('P', p_partkey, 'USDT') FROM part WHERE p_size IN (7, 10, 30)))")
def m18_discover(spark, d):
    return filters.select_universe(None, c14_with_anchors(spark, d))


@query("SELECT symbol, CASE WHEN n = 1 THEN 'added' ELSE 'removed' END AS change FROM (SELECT symbol, max(o) AS o, max(n) AS n FROM (SELECT symbol, 1 AS o, 0 AS n FROM v_contracts WHERE status = 'TRADING' UNION ALL SELECT symbol, 0, 1 FROM v_contracts WHERE quote_asset = 'USDT') GROUP BY symbol) WHERE o <> n")
def hs4_universe_diff(spark, d):
    c = view(spark, d, "v_contracts")
    return filters.universe_diff(c.filter("status = 'TRADING'"), c.filter("quote_asset = 'USDT'"))


@query(f"SELECT symbol, timestamp_ms, value FROM v_liquidations WHERE timestamp_ms > {T - DAY} AND timestamp_ms <= {T}")
def c17_events_near(spark, d):
    return filters.events_near(view(spark, d, "v_liquidations"), T, DAY).select("symbol", "timestamp_ms", "value")


@query("SELECT symbol, timestamp_ms, long_short_ratio FROM v_long_short WHERE ratio_type = 'global'")
def c19_ratio(spark, d):
    return filters.ratio(view(spark, d, "v_long_short")).select("symbol", "timestamp_ms", "long_short_ratio")


@query("SELECT symbol, timestamp_ms FROM v_funding UNION ALL SELECT symbol, timestamp_ms FROM v_open_interest")
def b07_union_lanes(spark, d):
    return filters.union_lanes([view(spark, d, "v_funding").select("symbol", "timestamp_ms"), view(spark, d, "v_open_interest")])


@query("SELECT symbol, timestamp_ms, seq FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp_ms DESC, seq DESC) AS n FROM v_liquidations) WHERE n <= 512")
def b10_gap_log(spark, d):
    rows = view(spark, d, "v_liquidations").select("symbol", "timestamp_ms", "seq")
    return filters.append_gap_events(rows.filter(F.col("seq") % 20 == 0), rows.filter(F.col("seq") % 20 != 0), 512, ("timestamp_ms", "seq"))


# ---- scalars ------------------------------------------------------------------------------------------------------------


@query("""
    SELECT event_id, strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS iso, timestamp_ms AS back, CASE WHEN k % 2 = 0 THEN 'sell' ELSE 'buy' END AS side,
    printf('%.12f', value) AS fixed, value * (k + 1) AS notional, value / 100 / (1 + value / 100) AS long_share, 1 / (1 + value / 100) AS short_share,
    strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%d') AS day, CAST(timestamp_ms % 86400000 // 3600000 AS INT) AS hour, abs(value - round(value)) <= greatest(1e-1, 1e-3 * abs(round(value))) AS near,
    (value + (value + 2)) / 2 AS mid, upper(symbol) AS up, lower(upper(symbol)) AS low FROM ev
""")
def h01_scalars(spark, d):
    v, ms = F.col("value"), F.col("timestamp_ms")
    long, short = fn.shares(v / 100)
    parts = fn.partition_parts(ms)
    return view(spark, d, "ev").select(
        "event_id", fn.iso_utc(ms).alias("iso"), fn.parse_iso(fn.iso_utc(ms)).alias("back"), fn.aggressor(F.col("k") % 2 == 0).alias("side"), fn.fmt12(v).alias("fixed"), fn.notional(v, F.col("k") + 1).alias("notional"),
        long.alias("long_share"), short.alias("short_share"), parts["date"].alias("day"), parts["hour"].alias("hour"), fn.close_to(v, F.round(v), 0.1, 0.001).alias("near"), fn.mid(v, v + 2, None).alias("mid"),
        F.upper("symbol").alias("up"), fn.norm_symbol(F.upper("symbol")).alias("low"),
    )


@query(f"SELECT symbol, {BASE} AS base FROM v_contracts")
def h08_base_asset(spark, d):
    return view(spark, d, "v_contracts").select("symbol", fn.base_asset(F.col("base_asset")).alias("base"))


# ---- aggregates ---------------------------------------------------------------------------------------------------------


@query("SELECT symbol, timestamp_ms, open, high, low, close, volume FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp_ms DESC) AS n FROM v_bars) WHERE n <= 180")
def e04_candles(spark, d):
    return agg.candles(view(spark, d, "v_bars").withColumn("seq", F.col("timestamp_ms")))


@query(f"WITH {TOPS} SELECT symbol, at_ms AS timestamp_ms, best_bid, best_ask, (best_bid + best_ask) / 2 AS mid, best_ask - best_bid AS spread FROM tops")
def e05_top_of_book(spark, d):
    return agg.top_of_book(view(spark, d, "v_snaps"))


@query("SELECT symbol, first_close, last_close, span_ms, (last_close - first_close) / nullif(first_close, 0) * 100 AS change_pct FROM (SELECT symbol, arg_min(close, timestamp_ms) AS first_close, arg_max(close, timestamp_ms) AS last_close, max(timestamp_ms) - min(timestamp_ms) AS span_ms FROM v_bars GROUP BY symbol)")
def e06_price_change(spark, d):
    return agg.price_change(view(spark, d, "v_bars"))


@query(f"WITH {ROWS} SELECT lane, symbol, day_ms FROM (SELECT *, row_number() OVER (PARTITION BY lane, symbol ORDER BY day_ms DESC) AS n FROM (SELECT DISTINCT lane, symbol, {DAY_MS} AS day_ms FROM rows_)) WHERE n <= 14")
def e07_days_present(spark, d):
    return agg.days_present(agg.lane_rows(lanes(spark, d)))


@query(f"WITH {ROWS} SELECT DISTINCT symbol, {DAY_MS} AS day_ms FROM rows_")
def m12_dates(spark, d):
    return agg.dates(agg.lane_rows(lanes(spark, d)))


@query(f"WITH {ROWS}, c AS (SELECT lane, {DAY_MS} AS day_ms, count(DISTINCT symbol) AS symbols FROM rows_ GROUP BY 1, 2), e AS (SELECT lane, unnest(range(greatest(min(day_ms), max(day_ms) - {13 * DAY}), max(day_ms) + 1, {DAY})) AS day_ms FROM c GROUP BY lane) SELECT e.lane, e.day_ms, coalesce(symbols, 0) AS symbols FROM e LEFT JOIN c USING (lane, day_ms)")
def e08_coverage_calendar(spark, d):
    return agg.coverage_calendar(agg.lane_rows(lanes(spark, d)).select("lane", "symbol", agg.day().alias("day_ms")).distinct())


@query(f"WITH {ROWS}, f AS (SELECT lane, symbol, {DAY_MS} AS file_name FROM rows_) SELECT lane, count(DISTINCT symbol) AS symbols, count(DISTINCT file_name) AS files, CAST(NULL AS BIGINT) AS gaps FROM f GROUP BY lane UNION ALL SELECT NULL, count(DISTINCT symbol), (SELECT count(*) FROM (SELECT DISTINCT lane, file_name FROM f)), (SELECT count(*) FROM v_liquidations) FROM f")
def e09_coverage_totals(spark, d):
    rows = agg.lane_rows({k: v.withColumn("file_name", agg.day()) for k, v in lanes(spark, d).items()}, "file_name")
    return agg.coverage_totals(rows, view(spark, d, "v_liquidations"))


@query(f"WITH {ROWS} SELECT symbol, array_to_string(list_sort(list_distinct(list(lane))), ',') AS lanes, {NOW} - max(timestamp_ms) < {DAY} AS active, {NOW} - max(CASE WHEN lane = 'trades' THEN timestamp_ms END) AS bar_age_ms FROM rows_ GROUP BY symbol")
def e10_symbol_directory(spark, d):
    return agg.symbol_directory(agg.lane_rows(lanes(spark, d)), NOW, DAY, "trades")


@query(f"WITH {ROWS}, {SEEN} SELECT lane, count(*) AS symbols, count(*) FILTER (WHERE {NOW} - last_ms < {WINDOW_CASE}) AS fresh, min({NOW} - last_ms) AS newest_age_ms, count(*) FILTER (WHERE {NOW} - last_ms < {WINDOW_CASE}) > 0 AS active FROM seen GROUP BY lane")
def e11_lane_freshness(spark, d):
    return agg.lane_freshness(agg.last_seen(agg.lane_rows(lanes(spark, d))), NOW, WINDOWS)


QUIET = f"quiet AS (SELECT lane, count(*) FILTER (WHERE symbol IN (SELECT symbol FROM seen WHERE lane = 'orderbooks' AND {NOW} - last_ms < {WINDOWS['orderbooks']})) AS quiet, count(*) FILTER (WHERE symbol NOT IN (SELECT symbol FROM seen WHERE lane = 'orderbooks' AND {NOW} - last_ms < {WINDOWS['orderbooks']})) AS stale FROM seen WHERE lane IN ('trades', 'liquidations') AND {NOW} - last_ms >= {WINDOW_CASE} GROUP BY lane)"


@query(f"WITH {ROWS}, {SEEN}, {QUIET} SELECT l.lane, coalesce(quiet, 0) AS quiet, coalesce(stale, 0) AS stale FROM (SELECT unnest(['trades', 'liquidations']) AS lane) l LEFT JOIN quiet USING (lane)")
def e12_quiet_stale(spark, d):
    return agg.quiet_stale(agg.last_seen(agg.lane_rows(lanes(spark, d))), NOW, WINDOWS, "orderbooks", ["trades", "liquidations"])


@query(f"SELECT CAST(user_id AS VARCHAR) AS symbol, {NOW} - max(timestamp_ms) AS age_ms FROM ev GROUP BY user_id HAVING age_ms BETWEEN {DAY} AND {10 * DAY - 1} ORDER BY age_ms DESC, symbol LIMIT 12")
def e13_stalest(spark, d):
    seen = view(spark, d, "ev").groupBy(F.col("user_id").cast("string").alias("symbol")).agg(F.max("timestamp_ms").alias("last_ms"))
    return agg.stalest(seen, NOW, DAY, 10 * DAY)


@query(f"WITH {ROWS}, {SEEN}, {QUIET}, fr AS (SELECT lane, count(*) AS symbols, count(*) FILTER (WHERE {NOW} - last_ms < {WINDOW_CASE}) AS fresh FROM seen GROUP BY lane) SELECT lane, symbols, fresh + coalesce(quiet, 0) AS healthy, (fresh + coalesce(quiet, 0)) * 100.0::DOUBLE / nullif(symbols, 0) AS healthy_pct, fresh > 0 AS connected FROM fr LEFT JOIN quiet USING (lane)")
def m10_streams(spark, d):
    seen = agg.last_seen(agg.lane_rows(lanes(spark, d)))
    return agg.lane_health(agg.lane_freshness(seen, NOW, WINDOWS), agg.quiet_stale(seen, NOW, WINDOWS, "orderbooks", ["trades", "liquidations"]))


@query("SELECT symbol AS event_type, count(*) AS messages FROM ev GROUP BY 1")
def e15_message_totals(spark, d):
    return agg.message_totals(view(spark, d, "ev").withColumnRenamed("symbol", "event_type"))


@query(f"SELECT symbol, {DAY_MS} AS day_ms, min(timestamp_ms) AS first_ms, max(timestamp_ms) AS last_ms, least(100.0::DOUBLE, (max(timestamp_ms) - min(timestamp_ms)) * 100.0::DOUBLE / {DAY}) AS pct, least(100.0::DOUBLE, (max(timestamp_ms) - min(timestamp_ms)) * 100.0::DOUBLE / {DAY}) > 95 AS \"full\" FROM v_diffs GROUP BY 1, 2")
def e17_tape_span(spark, d):
    return agg.tape_span(view(spark, d, "v_diffs"))


@query(f"SELECT {DAY_MS} AS day_ms, min(k) AS floor_mb, max(k) AS peak_mb, max(user_id) - min(user_id) AS reconnects FROM ev GROUP BY 1")
def e18_soak_daily(spark, d):
    samples = view(spark, d, "ev").select("timestamp_ms", F.col("k").alias("rss_mb"), F.col("user_id").alias("reconnects"))
    return agg.soak_daily(samples).drop("slope_mb_h")


@query("SELECT route, endpoint, count(*) AS requests, count(*) FILTER (WHERE success) AS succeeded, count(*) FILTER (WHERE success) * 100.0::DOUBLE / count(*) AS success_pct FROM v_requests GROUP BY 1, 2")
def e19_request_success(spark, d):
    return agg.request_success(view(spark, d, "v_requests"))


@query("SELECT symbol, '' AS missing, CAST(0 AS BIGINT) AS n_missing FROM v_long_short GROUP BY symbol HAVING count(DISTINCT ratio_type) = 3 UNION ALL SELECT symbol, array_to_string(list_sort(list_filter(['global', 'top_trader_account', 'top_trader_position'], lambda x: NOT list_contains(list(ratio_type), x))), ','), 3 - count(DISTINCT ratio_type) FROM v_long_short GROUP BY symbol HAVING count(DISTINCT ratio_type) < 3")
def e21_missing_categories(spark, d):
    return agg.missing_categories(view(spark, d, "v_long_short"), "ratio_type", RATIO_TYPES)


# ---- windows ------------------------------------------------------------------------------------------------------------


@query("SELECT symbol, u, lag(u) OVER (PARTITION BY symbol ORDER BY u) AS previous FROM v_diffs")
def f01_previous_update(spark, d):
    return windows.previous(view(spark, d, "v_diffs"), "u", ["symbol"], ["u"]).select("symbol", "u", "previous")


@query("SELECT symbol, timestamp_ms, lead(timestamp_ms) OVER (PARTITION BY symbol ORDER BY timestamp_ms) - timestamp_ms AS step_ms FROM (SELECT DISTINCT symbol, timestamp_ms FROM v_bars)")
def f02_bar_steps(spark, d):
    return windows.bar_steps(view(spark, d, "v_bars"))


@query("SELECT symbol, seq, trade_id, lag(trade_id) OVER (PARTITION BY symbol ORDER BY seq) AS previous FROM v_trades")
def f03_previous_trade(spark, d):
    return windows.previous(view(spark, d, "v_trades"), "trade_id", ["symbol"], ["seq"]).select("symbol", "seq", "trade_id", "previous")


@query("SELECT symbol, trade_id, seq FROM (SELECT *, row_number() OVER (PARTITION BY symbol, trade_id ORDER BY seq) AS n FROM v_trades) WHERE n > 1")
def f04_repeats(spark, d):
    return windows.repeats(view(spark, d, "v_trades"), ["symbol", "trade_id"], ["seq"]).select("symbol", "trade_id", "seq")


@query("SELECT symbol, timestamp_ms, price, n AS place FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp_ms DESC, seq DESC) AS n FROM v_trades) WHERE n <= 60")
def f06_tail(spark, d):
    return windows.tail(view(spark, d, "v_trades"), 60).select("symbol", "timestamp_ms", "price", "place")


@query("SELECT symbol, ratio_type, arg_max(long_short_ratio, seq) AS long_short_ratio, arg_max(timestamp_ms, seq) AS timestamp_ms FROM v_long_short GROUP BY 1, 2")
def f07_latest(spark, d):
    return windows.latest(view(spark, d, "v_long_short"), ["symbol", "ratio_type"], ["long_short_ratio", "timestamp_ms"])


@query(f"SELECT symbol, timestamp_ms, price, quantity, n AS place FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp_ms DESC, seq DESC) AS n FROM v_trades WHERE timestamp_ms <= {T} AND timestamp_ms > {T - DAY}) WHERE n <= 20")
def f08_tape_before(spark, d):
    return windows.tape_before(view(spark, d, "v_trades"), T, 20).select("symbol", "timestamp_ms", "price", "quantity", "place")


@query("SELECT symbol, event_id, CASE WHEN lag(event_id) OVER w > 0 THEN greatest(event_id - lag(event_id) OVER w, 0) * 1000.0::DOUBLE / nullif(timestamp_ms - lag(timestamp_ms) OVER w, 0) END AS rate FROM ev WINDOW w AS (PARTITION BY symbol ORDER BY timestamp_ms, event_id)")
def f09_counter_rate(spark, d):
    rows = view(spark, d, "ev")
    return windows.counter_rate(rows, "event_id", ["symbol"]).select("symbol", "event_id", "rate")


@query("SELECT symbol, user_id, round(list_reduce(list(value ORDER BY event_id), lambda a, x: a * 0.95::DOUBLE + x * 0.05::DOUBLE), 6) AS ema, count(*) AS samples FROM ev GROUP BY symbol, user_id")
def f10_ema(spark, d):
    return windows.ema(view(spark, d, "ev"), "value", ["symbol", "user_id"], order="event_id").withColumn("ema", F.round("ema", 6))


@query("SELECT event_id, CAST(sum(weight) OVER (ORDER BY timestamp_ms RANGE BETWEEN 300000 PRECEDING AND CURRENT ROW) AS BIGINT) AS spent, sum(weight) OVER (ORDER BY timestamp_ms RANGE BETWEEN 300000 PRECEDING AND CURRENT ROW) > 20 AS over_budget FROM v_requests")
def f11_rolling_budget(spark, d):
    return windows.rolling_budget(view(spark, d, "v_requests"), 300_000, 20).select("event_id", "spent", "over_budget")


@query("SELECT file_name, seq, line FROM (SELECT file_name, seq, line, coalesce(last_value(CASE level WHEN 'TRACE' THEN 0 WHEN 'DEBUG' THEN 0 WHEN 'INFO' THEN 1 WHEN 'WARN' THEN 2 WHEN 'ERROR' THEN 3 END IGNORE NULLS) OVER (PARTITION BY file_name ORDER BY seq ROWS UNBOUNDED PRECEDING), 1) AS r FROM v_log_lines) WHERE r >= 2")
def f12_filter_logs(spark, d):
    return windows.filter_logs(view(spark, d, "v_log_lines"), "WARN").select("file_name", "seq", "line")


@query("SELECT symbol, event_id FROM (SELECT *, row_number() OVER (PARTITION BY symbol, user_id ORDER BY timestamp_ms DESC, event_id DESC) AS n FROM ev) WHERE n <= 3")
def f13_keep_last(spark, d):
    return filters.keep_last(view(spark, d, "ev"), ["symbol", "user_id"], 3, ["timestamp_ms", "event_id"]).select("symbol", "event_id")


@query("SELECT symbol, event_id, b FROM (SELECT symbol, event_id, b, max(b) OVER (PARTITION BY symbol ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM (SELECT symbol, event_id, timestamp_ms - timestamp_ms % 3600000 - (k % 3) * 3600000 AS b FROM ev)) WHERE m IS NULL OR b > m")
def t03_new_buckets(spark, d):
    rows = view(spark, d, "ev").select("symbol", "event_id", (fn.bucket(F.col("timestamp_ms"), HOUR) - (F.col("k") % 3) * HOUR).alias("b"))
    return windows.new_buckets(rows, ["symbol"], "event_id", "b")


PRESENT = f"present AS (SELECT s.symbol, c.cycle, p.symbol IS NOT NULL AS present FROM (SELECT DISTINCT user_id AS symbol FROM ev) s CROSS JOIN (SELECT DISTINCT timestamp_ms // {DAY} AS cycle FROM ev) c LEFT JOIN (SELECT DISTINCT user_id AS symbol, timestamp_ms // {DAY} AS cycle FROM ev) p ON p.symbol = s.symbol AND p.cycle = c.cycle)"


@query(f"WITH {PRESENT}, w AS (SELECT symbol, cycle, present, lag(present, 1) OVER o AS b1, lag(present, 2) OVER o AS b2, coalesce(max(present::INT) OVER (PARTITION BY symbol ORDER BY cycle ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ever FROM present WINDOW o AS (PARTITION BY symbol ORDER BY cycle)) SELECT symbol, cycle, CASE WHEN NOT present THEN 'removed' ELSE 'added' END AS change FROM w WHERE (NOT present AND b1 = false AND coalesce(b2, false) AND ever = 1) OR (present AND (ever = 0 OR (b1 = false AND b2 = false)))")
def t08_lifecycle(spark, d):
    seen = view(spark, d, "ev").select(F.col("user_id").alias("symbol"), F.floor(F.col("timestamp_ms") / DAY).alias("cycle")).distinct()
    cycles = seen.agg(F.sort_array(F.collect_set("cycle")).alias("c"))
    every = seen.select("symbol").distinct().crossJoin(F.broadcast(cycles)).select("symbol", F.explode("c").alias("cycle"))
    return windows.lifecycle(every.join(seen.withColumn("present", F.lit(True)), ["symbol", "cycle"], "left").fillna(False, ["present"]))


# ---- quality ------------------------------------------------------------------------------------------------------------

KEYS = f"symbol, {DAY_MS} AS day_ms"
BAD = {
    "klines": ("v_bars", {"ohlc_bounds": "NOT (high >= low AND high >= open AND high >= close AND low <= open AND low <= close)", "volume": "NOT volume >= 0"}),
    "trades": ("v_trades", {"price_qty": "NOT (price > 0 AND quantity > 0)", "side": "side NOT IN ('buy', 'sell')"}),
    "liquidations": ("v_liquidations", {"price_qty": "NOT (price > 0 AND quantity > 0)", "value": "price > 0 AND quantity > 0 AND NOT abs(value - price * quantity) <= greatest(1e-6, 1e-4 * abs(price * quantity))"}),
    "open_interest": ("v_open_interest", {"oi": "NOT open_interest >= 0", "oi_value": "open_interest >= 0 AND NOT abs(oi_value - open_interest * mark_price) <= greatest(1e0, 1e-3 * abs(open_interest * mark_price))"}),
    "funding_rates": ("v_funding", {"rate": "NOT abs(funding_rate) <= 3e-2"}),
    "long_short_ratio": ("v_long_short", {"shares": "abs(long_ratio + short_ratio - 1) > 2e-2", "ratio": "short_ratio > 0 AND NOT abs(long_ratio / short_ratio - long_short_ratio) <= greatest(1e-3, 1e-2 * abs(long_short_ratio))"}),
    "taker_buy_sell_ratio": ("v_taker", {"volumes": "NOT (buy_volume >= 0 AND sell_volume >= 0)", "ratio": "sell_volume > 0 AND NOT abs(buy_volume / sell_volume - buy_sell_ratio) <= greatest(1e-3, 1e-2 * abs(buy_sell_ratio))"}),
}
ORDERED = {
    "klines": {
        "missing_minutes": f"SELECT symbol, day_ms, 'klines' AS lane, 'missing_minutes' AS \"check\", CAST(coalesce(sum(CASE WHEN s > {HOUR} THEN s // {HOUR} - 1 END), 0) AS BIGINT) AS failures FROM (SELECT symbol, day_ms, lead(timestamp_ms) OVER (PARTITION BY symbol, day_ms ORDER BY timestamp_ms) - timestamp_ms AS s FROM (SELECT DISTINCT {KEYS}, timestamp_ms FROM v_bars)) GROUP BY 1, 2",
        "unique_timestamps": f"SELECT {KEYS}, 'klines' AS lane, 'unique_timestamps' AS \"check\", count(*) - count(DISTINCT timestamp_ms) AS failures FROM v_bars GROUP BY 1, 2",
    },
    "trades": {
        "unique_ids": f"SELECT {KEYS}, 'trades' AS lane, 'unique_ids' AS \"check\", count(*) - count(DISTINCT trade_id) AS failures FROM v_trades GROUP BY 1, 2",
        "monotone_ids": f"SELECT symbol, day_ms, 'trades' AS lane, 'monotone_ids' AS \"check\", count(*) FILTER (WHERE trade_id < b) AS failures FROM (SELECT {KEYS}, trade_id, lag(trade_id) OVER (PARTITION BY symbol, {DAY_MS} ORDER BY seq) AS b FROM v_trades) GROUP BY 1, 2",
    },
    "long_short_ratio": {"ratio_types": f"SELECT {KEYS}, 'long_short_ratio' AS lane, 'ratio_types' AS \"check\", 3 - count(DISTINCT ratio_type) AS failures FROM v_long_short GROUP BY 1, 2"},
}


def _checks_sql(lane: str) -> str:
    v, bad = BAD[lane]
    rows = [f"SELECT {KEYS}, '{lane}' AS lane, '{name}' AS \"check\", count(*) FILTER (WHERE {rule}) AS failures FROM {v} GROUP BY 1, 2" for name, rule in bad.items()]
    return " UNION ALL ".join([*rows, *ORDERED.get(lane, {}).values()])


def checks_of(spark: SparkSession, d: str, lane: str) -> DataFrame:
    return quality.run_checks(view(spark, d, BAD[lane][0]), lane, HOUR)


def _check_query(name: str, lane: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return checks_of(spark, d, lane)

    run.__name__ = name
    query(_checks_sql(lane))(run)


for _name, _lane in (("q01_klines", "klines"), ("q05_trades", "trades"), ("q09_liquidations", "liquidations"), ("q11_open_interest", "open_interest"), ("q13_funding", "funding_rates"), ("q14_long_short", "long_short_ratio"), ("q17_taker", "taker_buy_sell_ratio")):
    _check_query(_name, _lane)

REPORT = "reports AS (" + " UNION ALL ".join(
    f"SELECT c.symbol, c.day_ms, '{lane}' AS lane, r.n AS rows_n, CAST(sum(failures) AS BIGINT) AS failures, bool_and(failures = 0) AS ok FROM ({_checks_sql(lane)}) c JOIN (SELECT {KEYS}, count(*) AS n FROM {BAD[lane][0]} GROUP BY 1, 2) r ON c.symbol = r.symbol AND c.day_ms = r.day_ms GROUP BY 1, 2, 3, 4"
    for lane in BAD
) + ")"


def reports_of(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for lane in BAD:
        part = quality.lane_reports(view(spark, d, BAD[lane][0]), checks_of(spark, d, lane))
        out = part if out is None else out.unionByName(part)
    return out


@query(f'WITH {REPORT} SELECT symbol, day_ms, lane, rows_n AS "rows", failures, ok FROM reports')
def q21_reports(spark, d):
    return reports_of(spark, d)


@query(f"WITH {REPORT} SELECT symbol, day_ms, count(*) AS lanes, CAST(sum(rows_n) AS BIGINT) AS \"rows\", CAST(sum(failures) AS BIGINT) AS failures, CASE WHEN bool_and(ok) THEN 'clean' ELSE 'issues' END AS verdict FROM reports GROUP BY 1, 2")
def q22_verdicts(spark, d):
    return quality.verdicts(reports_of(spark, d))


@query("SELECT event_id, timestamp_ms % 7 = 0 AS bad FROM ev")
def q19_datetime(spark, d):
    rows = view(spark, d, "ev")
    off = F.when(F.col("timestamp_ms") % 7 == 0, F.lit("1999-01-01T00:00:00Z")).otherwise(fn.iso_utc(F.col("timestamp_ms")))
    return rows.withColumn("datetime_utc", off).select("event_id", quality.datetime_check("trades").failed.alias("bad"))


@query(f"SELECT symbol, count(*) FILTER (WHERE s <> {HOUR}) AS gaps, count(*) AS bars FROM (SELECT symbol, lead(timestamp_ms) OVER (PARTITION BY symbol ORDER BY timestamp_ms) - timestamp_ms AS s FROM (SELECT DISTINCT symbol, timestamp_ms FROM v_bars)) GROUP BY symbol")
def q24_gap_events(spark, d):
    return quality.gap_events(view(spark, d, "v_bars"), HOUR)


@query(f"SELECT {KEYS}, count(*) - count(DISTINCT timestamp_ms) AS failures FROM v_taker GROUP BY 1, 2")
def q25_repeated_timestamps(spark, d):
    return quality.repeated_timestamps(view(spark, d, "v_taker"))


# ---- order books --------------------------------------------------------------------------------------------------------


@query("SELECT symbol, count(*) AS \"rows\", count(*) FILTER (WHERE pu <> b) AS breaks, arg_min(b, u) FILTER (WHERE pu <> b) AS expected, arg_min(pu, u) FILTER (WHERE pu <> b) AS got, abs(arg_min(pu, u) FILTER (WHERE pu <> b) - arg_min(b, u) FILTER (WHERE pu <> b)) AS break_size FROM (SELECT *, lag(u) OVER (PARTITION BY symbol ORDER BY u) AS b FROM v_diffs) GROUP BY symbol")
def o02_continuity(spark, d):
    return book.continuity(diffs_of(spark, d))


SEED = "seed AS (SELECT s.* FROM v_snaps s JOIN (SELECT symbol, max(last_update_id) AS m FROM v_snaps GROUP BY symbol) x ON s.symbol = x.symbol AND s.last_update_id = x.m)"


@query(f"WITH {SEED} SELECT symbol, last_update_id, side, price, qty FROM seed")
def o03_seed(spark, d):
    return book.seed(view(spark, d, "v_snaps")).select("symbol", "last_update_id", "side", "price", "qty")


@query(f"WITH {SEED} SELECT symbol, best_bid, best_ask, coalesce(best_bid > best_ask, false) AS seed_crossed FROM (SELECT symbol, max(CASE WHEN side = 'bid' THEN price END) AS best_bid, min(CASE WHEN side = 'ask' THEN price END) AS best_ask FROM seed GROUP BY symbol)")
def o04_seed_crossed(spark, d):
    return book.seed_crossed(book.seed(view(spark, d, "v_snaps")))


def _book_sql(t: int | None) -> str:
    snaps = f"v_snaps WHERE timestamp_ms BETWEEN {t - t % DAY - DAY} AND {t}" if t else "v_snaps"
    until = f"AND e.timestamp_ms <= {t}" if t else ""
    return f"""anchors AS (SELECT symbol, max(timestamp_ms) AS anchor_ms, max(struct_pack(t := timestamp_ms, i := last_update_id)).i AS anchor_id FROM (SELECT * FROM {snaps}) GROUP BY symbol),
    writes AS (SELECT s.symbol, side, price, qty, last_update_id AS u FROM v_snaps s JOIN anchors a ON s.symbol = a.symbol AND s.timestamp_ms = a.anchor_ms AND s.last_update_id = a.anchor_id
      UNION ALL SELECT e.symbol, side, price, qty, u FROM v_diffs e JOIN anchors a ON e.symbol = a.symbol AND e.u > a.anchor_id {until}),
    book AS (SELECT * FROM (SELECT symbol, side, price, arg_max(qty, u) AS qty, max(u) AS u FROM writes GROUP BY 1, 2, 3) WHERE qty <> 0)"""


@query(f"WITH {_book_sql(T)} SELECT symbol, side, price, qty, u FROM book")
def o06_book_at(spark, d):
    return book.book_at(view(spark, d, "v_snaps"), events_of(spark, d), T)


@query(f"WITH {_book_sql(T)} SELECT symbol, count(*) AS applied, bool_or(coalesce(pu <> b, false)) AS gap FROM (SELECT e.symbol, pu, lag(u) OVER (PARTITION BY e.symbol ORDER BY u) AS b FROM v_diffs e JOIN anchors a ON e.symbol = a.symbol AND e.u > a.anchor_id AND e.timestamp_ms <= {T}) GROUP BY symbol")
def o07_book_at_gap(spark, d):
    return book.book_at_gap(view(spark, d, "v_snaps"), diffs_of(spark, d), T)


@query("SELECT symbol, u, timestamp_ms, seq FROM (SELECT *, row_number() OVER (PARTITION BY symbol, u ORDER BY timestamp_ms DESC, first_u, seq) AS n FROM (SELECT symbol, event_id // 2 AS u, timestamp_ms, event_id AS first_u, event_id AS seq FROM ev)) WHERE n = 1")
def o08_normalize(spark, d):
    rows = view(spark, d, "ev").select("symbol", F.floor(F.col("event_id") / 2).alias("u"), "timestamp_ms", F.col("event_id").alias("first_u"), F.col("event_id").alias("seq"))
    return book.normalize(rows).select("symbol", "u", "timestamp_ms", "seq")


BRIDGE = "bridge AS (SELECT i.symbol, i.last_update_id, min(u) AS u FROM (SELECT DISTINCT symbol, last_update_id FROM v_snaps) i JOIN v_diffs e ON e.symbol = i.symbol AND e.u > i.last_update_id AND (e.u <= i.last_update_id + 1 OR (e.pu <= i.last_update_id AND i.last_update_id < e.u)) GROUP BY 1, 2)"


@query(f"WITH {BRIDGE} SELECT b.symbol, b.last_update_id, b.u, e.u AS first_u, e.pu, CASE WHEN e.u <= b.last_update_id + 1 THEN 'perfect' ELSE 'pu_attach' END AS rule FROM bridge b JOIN v_diffs e ON e.symbol = b.symbol AND e.u = b.u")
def o09_find_bridge(spark, d):
    return book.find_bridge(view(spark, d, "v_snaps"), diffs_of(spark, d))


REPORT_ATTACH = f"""{BRIDGE}, chain AS (SELECT symbol, u, pu, row_number() OVER w AS n, count(*) OVER (PARTITION BY symbol) AS size, pu <> lag(u) OVER w AS broken, first_value(pu) OVER w AS first_pu FROM v_diffs WINDOW w AS (PARTITION BY symbol ORDER BY u)),
ends AS (SELECT symbol, max(size) AS size, max(CASE WHEN broken THEN u END) AS last_break_u, arg_min(pu, u) AS first_pu0 FROM chain GROUP BY symbol), first_row AS (SELECT symbol, pu AS first_pu FROM chain WHERE n = 1),
report AS (SELECT i.symbol, i.last_update_id, CASE WHEN e.size IS NULL THEN 'no_buffer' WHEN i.last_update_id < f.first_pu THEN 'snapshot_older_than_buffer' WHEN b.u IS NULL THEN 'no_bridge' WHEN e.last_break_u > b.u THEN 'gap_during_attach' ELSE 'attached' END AS outcome,
CASE WHEN x.u <= b.last_update_id + 1 THEN 'perfect' WHEN x.u IS NOT NULL THEN 'pu_attach' END AS rule, e.size - x.n + 1 AS applied0 FROM (SELECT DISTINCT symbol, last_update_id FROM v_snaps) i LEFT JOIN ends e ON e.symbol = i.symbol LEFT JOIN first_row f ON f.symbol = i.symbol
LEFT JOIN bridge b ON b.symbol = i.symbol AND b.last_update_id = i.last_update_id LEFT JOIN chain x ON x.symbol = b.symbol AND x.u = b.u)"""


@query(f"WITH {REPORT_ATTACH} SELECT symbol, last_update_id, outcome, rule, CASE WHEN outcome = 'attached' THEN applied0 END AS applied FROM report")
def o10_attach_report(spark, d):
    return book.attach_report(view(spark, d, "v_snaps"), diffs_of(spark, d))


@query(f"WITH {REPORT_ATTACH} SELECT symbol, last_update_id, 're_anchor' AS type, outcome AS reason FROM report WHERE outcome <> 'attached'")
def o19_reanchor_events(spark, d):
    return book.reanchor_events(book.attach_report(view(spark, d, "v_snaps"), diffs_of(spark, d)))


DAYS = f"days AS (SELECT {KEYS}, arg_min(pu, u) FILTER (WHERE pu IS NOT NULL) AS x, max(u) AS last_u, min(u) AS first_u FROM v_diffs GROUP BY 1, 2), firsts AS (SELECT days.symbol, days.day_ms, e.pu AS first_pu, days.last_u FROM days JOIN v_diffs e ON e.symbol = days.symbol AND e.u = days.first_u)"


@query(f"WITH {DAYS} SELECT a.symbol, a.day_ms, b.last_u AS ended_u, a.first_pu, CASE WHEN b.last_u IS NULL OR a.first_pu IS NULL THEN NULL WHEN a.first_pu = b.last_u THEN 'ok' ELSE 'break' END AS handoff FROM firsts a LEFT JOIN firsts b ON a.symbol = b.symbol AND a.day_ms = b.day_ms + {DAY}")
def o11_midnight_handoff(spark, d):
    return book.midnight_handoff(diffs_of(spark, d))


@query(f"WITH days AS (SELECT {KEYS}, min(timestamp_ms) AS a, max(timestamp_ms) AS b FROM v_trades GROUP BY 1, 2) SELECT x.symbol, x.day_ms, x.a - y.b AS gap_ms FROM days x JOIN days y ON x.symbol = y.symbol AND x.day_ms = y.day_ms + {DAY}")
def o12_midnight_trade_gap(spark, d):
    return book.midnight_trade_gap(view(spark, d, "v_trades"))


#: A sequential fold: a step for each diff of a symbol and day, which trims both sides to the best ten.
LIVE = f"""WITH RECURSIVE e AS (SELECT symbol, timestamp_ms // {DAY} AS day, u, side, price, qty, row_number() OVER (PARTITION BY symbol, timestamp_ms // {DAY} ORDER BY u) AS n FROM v_diffs),
r(symbol, day, n, u, bids, asks) AS (SELECT DISTINCT symbol, day, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST([] AS STRUCT(price DOUBLE, qty DOUBLE)[]), CAST([] AS STRUCT(price DOUBLE, qty DOUBLE)[]) FROM e
UNION ALL SELECT r.symbol, r.day, e.n, e.u,
CASE WHEN side = 'bid' THEN list_reverse_sort(list_concat(list_filter(bids, lambda x: x.price <> e.price), CASE WHEN qty <> 0 THEN [struct_pack(price := price, qty := qty)] ELSE [] END))[1:10] ELSE bids END,
CASE WHEN side = 'ask' THEN list_sort(list_concat(list_filter(asks, lambda x: x.price <> e.price), CASE WHEN qty <> 0 THEN [struct_pack(price := price, qty := qty)] ELSE [] END))[1:10] ELSE asks END
FROM r JOIN e ON e.symbol = r.symbol AND e.day = r.day AND e.n = r.n + 1),
f AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY symbol, day ORDER BY n DESC) = 1),
x AS (SELECT symbol, day, u, 'bid' AS side, unnest(bids) AS l FROM f UNION ALL SELECT symbol, day, u, 'ask', unnest(asks) FROM f) SELECT symbol, day, side, l.price AS price, l.qty AS qty, u FROM x"""


@query(LIVE)
def o14_live_book(spark, d):
    return book.live_book(events_of(spark, d), 10)


@query(
    f"WITH w AS (SELECT symbol, side, price, qty, last_update_id AS u, CAST(NULL AS BIGINT) AS at_ms FROM v_snaps JOIN (SELECT symbol, min(last_update_id) AS last_update_id FROM v_snaps GROUP BY symbol) USING (symbol, last_update_id) UNION ALL SELECT symbol, side, price, qty, u, timestamp_ms - timestamp_ms % {DAY} + {DAY} FROM v_diffs), "
    "i AS (SELECT DISTINCT symbol, at_ms FROM w WHERE at_ms IS NOT NULL), f AS (SELECT symbol, min(at_ms) AS at_ms FROM i GROUP BY symbol), x AS (SELECT w.symbol, side, price, qty, u, coalesce(w.at_ms, f.at_ms) AS at_ms FROM w JOIN f ON w.symbol = f.symbol), "
    "last AS (SELECT symbol, at_ms, side, price, arg_max(qty, u) AS qty FROM x GROUP BY 1, 2, 3, 4), l AS (SELECT DISTINCT symbol, side, price FROM last), g AS (SELECT i.symbol, i.at_ms, l.side, l.price FROM i JOIN l ON i.symbol = l.symbol) "
    "SELECT g.symbol, g.at_ms, g.side, g.price, last.qty FROM g ASOF JOIN last ON g.symbol = last.symbol AND g.side = last.side AND g.price = last.price AND g.at_ms >= last.at_ms WHERE last.qty <> 0"
)
def o15_emit_snapshots(spark, d):
    return book.emit_snapshots(view(spark, d, "v_snaps"), events_of(spark, d), DAY)


@query(f"WITH {_book_sql(None)} SELECT symbol, side, price, qty, u FROM book")
def o16_book_now(spark, d):
    return book.book_at(view(spark, d, "v_snaps"), events_of(spark, d))


LADDER = "ladder AS (SELECT symbol, side, price, qty, n AS level, sum(qty) OVER (PARTITION BY symbol, side ORDER BY n ROWS UNBOUNDED PRECEDING) AS cumulative FROM (SELECT *, row_number() OVER (PARTITION BY symbol, side ORDER BY CASE WHEN side = 'bid' THEN -price ELSE price END) AS n FROM book) WHERE n <= 20)"


@query(f"WITH {_book_sql(T)}, {LADDER} SELECT symbol, side, price, qty, level, cumulative FROM ladder")
def f05_ladder(spark, d):
    return windows.ladder(o06_book_at(spark, d)).select("symbol", "side", "price", "qty", "level", "cumulative")


@query(f"WITH {_book_sql(T)} SELECT symbol, side, price, qty FROM (SELECT *, row_number() OVER (PARTITION BY symbol, side ORDER BY CASE WHEN side = 'bid' THEN -price ELSE price END) AS n FROM book) WHERE n <= 3")
def g01_trim(spark, d):
    return book.trim(o06_book_at(spark, d), 3).select("symbol", "side", "price", "qty")


@query(f"WITH {_book_sql(None)} SELECT symbol, count(*) FILTER (WHERE side = 'bid') AS bids, count(*) FILTER (WHERE side = 'ask') AS asks, max(u) AS last_update_id, count(*) FILTER (WHERE side = 'bid') > 0 AND count(*) FILTER (WHERE side = 'ask') > 0 AS live FROM book GROUP BY symbol")
def e16_book_census(spark, d):
    return agg.book_census(o16_book_now(spark, d))


@query(f"WITH {_book_sql(None)} SELECT symbol, max(CASE WHEN side = 'bid' THEN price END) AS best_bid, min(CASE WHEN side = 'ask' THEN price END) AS best_ask FROM book GROUP BY symbol")
def o17_top(spark, d):
    return book.top(o16_book_now(spark, d))


#: Crossed states by level lifetimes: after each diff, the best prices alive.
LIVES = """lives AS (SELECT symbol, side, price, qty, u AS a, lead(u) OVER (PARTITION BY symbol, side, price ORDER BY u) AS b FROM v_diffs),
states AS (SELECT e.symbol, e.u, max(CASE WHEN l.side = 'bid' THEN l.price END) AS bid, min(CASE WHEN l.side = 'ask' THEN l.price END) AS ask FROM v_diffs e LEFT JOIN lives l ON l.symbol = e.symbol AND l.qty <> 0 AND l.a <= e.u AND (l.b IS NULL OR l.b > e.u) GROUP BY 1, 2)"""


@query(f"WITH {LIVES} SELECT symbol, count(*) AS applied, count(*) FILTER (WHERE bid > ask) AS crossed, arg_max(bid, u) AS best_bid, arg_max(ask, u) AS best_ask FROM states GROUP BY symbol")
def o05_rebuild(spark, d):
    nothing = view(spark, d, "v_snaps").filter("false")
    return book.rebuild_day(nothing, events_of(spark, d), 6 * HOUR)


# ---- wire messages, files and composites --------------------------------------------------------------------------------


def raw_messages(spark: SparkSession, d: str, event_type: str, data: Column) -> DataFrame:
    """Events as text envelopes of one type, parsed again."""
    value = F.to_json(F.struct(F.lit("tape").alias("stream"), data.alias("data")))
    return messages.typed(messages.parse_messages(view(spark, d, "ev").select(value.alias("value"))), event_type)


@query("SELECT symbol, timestamp_ms, strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS datetime_utc, event_id AS trade_id, CASE WHEN k % 2 = 0 THEN 'sell' ELSE 'buy' END AS side, value AS price, CAST(k + 1 AS DOUBLE) AS quantity, CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END AS is_buyer_maker FROM ev")
def a07_to_trades(spark, d):
    c = F.col
    data = F.struct(F.lit("aggTrade").alias("e"), c("timestamp_ms").alias("E"), F.upper("symbol").alias("s"), c("event_id").alias("a"), c("value").cast("string").alias("p"), (c("k") + 1).cast("string").alias("q"), c("event_id").alias("f"), c("event_id").alias("l"), c("timestamp_ms").alias("T"), (c("k") % 2 == 0).alias("m"))
    return messages.to_trades(raw_messages(spark, d, "aggTrade", data)).select("symbol", "timestamp_ms", "datetime_utc", "trade_id", "side", "price", "quantity", "is_buyer_maker")


@query("SELECT symbol, timestamp_ms, CASE WHEN k % 2 = 0 THEN 'sell' ELSE 'buy' END AS side, value AS price, value * (k + 1) AS value FROM ev WHERE symbol < 's'")
def a09_to_liquidations(spark, d):
    c = F.col
    order = F.struct(F.upper("symbol").alias("s"), F.when(c("k") % 2 == 0, "SELL").otherwise("BUY").alias("S"), c("value").cast("string").alias("p"), (c("k") + 1).cast("string").alias("q"), c("timestamp_ms").alias("T"))
    rows = raw_messages(spark, d, "forceOrder", F.struct(F.lit("forceOrder").alias("e"), c("timestamp_ms").alias("E"), order.alias("o")))
    universe = view(spark, d, "ev").filter("symbol < 's'").select("symbol").distinct()
    return messages.to_liquidations(rows, universe).select("symbol", "timestamp_ms", "side", "price", "value")


@query("SELECT symbol, timestamp_ms, value AS mark_price, CAST(k AS DOUBLE) AS open_interest, k * value AS oi_value FROM ev WHERE event_id % 2 = 0")
def a11_to_open_interest(spark, d):
    ev = view(spark, d, "ev").withColumn("poll", F.col("event_id"))
    oi = ev.select("symbol", F.col("k").cast("string").alias("openInterest"), F.col("timestamp_ms").alias("time"), "poll")
    premium = ev.filter("event_id % 2 = 0").select("symbol", F.col("value").cast("string").alias("markPrice"), "poll")
    return messages.to_open_interest(oi, premium).select("symbol", "timestamp_ms", "mark_price", "open_interest", "oi_value")


@query("SELECT symbol, timestamp_ms, CASE event_id % 3 WHEN 0 THEN 'global' WHEN 1 THEN 'top_trader_account' ELSE 'top_trader_position' END AS ratio_type, value / 1e2 / (1 + value / 1e2) AS long_ratio, 1 / (1 + value / 1e2) AS short_ratio FROM ev")
def a12_to_long_short(spark, d):
    ev = view(spark, d, "ev")
    none = F.lit(None).cast("string")
    part = lambda n: ev.filter(F.col("event_id") % 3 == n).select("symbol", none.alias("longAccount"), none.alias("shortAccount"), (F.col("value") / 1e2).cast("string").alias("longShortRatio"), F.col("timestamp_ms").alias("timestamp"))
    return messages.to_long_short(part(0), part(1), part(2)).select("symbol", "timestamp_ms", "ratio_type", "long_ratio", "short_ratio")


@query("SELECT symbol, u, side, price, qty FROM v_diffs")
def o01_level_events(spark, d):
    rows = view(spark, d, "v_diffs")
    level = F.concat(F.lit('[["'), F.col("price").cast("string"), F.lit('","'), F.col("qty").cast("string"), F.lit('"]]'))
    text = lambda side: F.when(F.col("side") == side, level).otherwise("[]").alias(f"{side}s_json")
    diffs = rows.select("symbol", "timestamp_ms", F.col("u").alias("last_update_id"), F.col("u").alias("seq"), text("bid"), text("ask"))
    return book.level_events(diffs).select("symbol", "u", "side", "price", "qty")


@query(f"WITH {ROWS} SELECT lane, count(DISTINCT {DAY_MS}) AS files, count(*) AS \"rows\" FROM rows_ GROUP BY lane")
def e20_file_census(spark, d):
    return agg.file_census(agg.lane_rows({k: v.withColumn("file_name", agg.day()) for k, v in lanes(spark, d).items()}, "file_name"))


@query(f"SELECT event_id, {NOW / 1000} - timestamp_ms / 1e3 AS age_s, {NOW / 1000} - timestamp_ms / 1e3 < 86400 AS live FROM ev")
def t07_is_live(spark, d):
    beats = view(spark, d, "ev").select("event_id", (F.col("timestamp_ms") / 1e3).alias("timestamp"))
    return is_live(beats, NOW / 1000, 86400).select("event_id", "age_s", "live")


def symbol_batches(rows: DataFrame) -> list[list[str]]:
    """All symbols in order, in batches as large as one selection may be."""
    symbols = sorted(r.symbol for r in rows.select("symbol").filter("symbol is not null").distinct().collect())
    return [symbols[i : i + MAX_SYMBOLS] for i in range(0, len(symbols), MAX_SYMBOLS)]


@query(f"SELECT 'trades' AS lane, symbol, timestamp_ms FROM v_trades WHERE timestamp_ms BETWEEN {FROM} AND {TO} UNION ALL SELECT 'liquidations', symbol, timestamp_ms FROM v_liquidations WHERE timestamp_ms BETWEEN {FROM} AND {TO}")
def b06_bundle(spark, d):
    found = {k: view(spark, d, LANE_VIEWS[k]) for k in ("trades", "liquidations")}
    parts = []
    for symbols in symbol_batches(view(spark, d, "ev").select(F.lower("symbol").alias("symbol"))):  # a bundle's symbols are of any case
        try:
            bundle = export_bundle(found, symbols, ["trades", "liquidations"], FROM, TO)
        except ValueError:  # a batch without data adds no rows
            continue
        parts.append(agg.lane_rows(bundle))
    if not parts:
        raise ValueError("no data in the selection")
    return functools.reduce(DataFrame.unionByName, parts)


@query(
    f"WITH {GRID}, b AS (SELECT symbol, timestamp_ms - timestamp_ms % {HOUR} AS timestamp_ms, count(*) AS trade_count, {VWAP} AS trade_vwap FROM v_trades WHERE timestamp_ms BETWEEN {FROM - FROM % HOUR} AND {TO} GROUP BY 1, 2), r AS (SELECT symbol, timestamp_ms AS at_ms, arg_max(funding_rate, seq) AS funding_rate FROM v_funding GROUP BY 1, 2), "
    f"m AS (SELECT grid.symbol, grid.timestamp_ms, CASE WHEN grid.timestamp_ms - at_ms <= {8 * HOUR} THEN funding_rate END AS funding_rate FROM grid ASOF LEFT JOIN r ON grid.symbol = r.symbol AND grid.timestamp_ms >= r.at_ms) "
    "SELECT m.symbol, m.timestamp_ms, strftime(make_timestamp(m.timestamp_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS datetime_utc, open, high, low, close, volume, trade_count, trade_vwap, funding_rate FROM m LEFT JOIN v_bars USING (symbol, timestamp_ms) LEFT JOIN b USING (symbol, timestamp_ms)"
)
def m01_matrix(spark, d):
    found = {"klines": view(spark, d, "v_bars").withColumn("seq", F.col("timestamp_ms")), "trades": view(spark, d, "v_trades"), "funding_rates": view(spark, d, "v_funding")}
    batches = symbol_batches(view(spark, d, "ev"))
    parts = [merged_matrix(spark, found, symbols, FROM, TO, HOUR, wide=False, required=len(batches) == 1) for symbols in batches]
    return functools.reduce(DataFrame.unionByName, parts)


@query(
    f"WITH {LIVES}, {SEED}, {DAYS}, c AS (SELECT symbol, count(*) FILTER (WHERE pu <> b) AS breaks FROM (SELECT *, lag(u) OVER (PARTITION BY symbol ORDER BY u) AS b FROM v_diffs) GROUP BY symbol), "
    "r AS (SELECT symbol, count(*) AS applied, count(*) FILTER (WHERE bid > ask) AS crossed FROM states GROUP BY symbol), s AS (SELECT symbol, coalesce(max(CASE WHEN side = 'bid' THEN price END) > min(CASE WHEN side = 'ask' THEN price END), false) AS seed_crossed FROM seed GROUP BY symbol), "
    f"h AS (SELECT a.symbol, bool_or(coalesce(a.first_pu <> b.last_u, false)) AS broken FROM firsts a LEFT JOIN firsts b ON a.symbol = b.symbol AND a.day_ms = b.day_ms + {DAY} GROUP BY 1) "
    "SELECT symbol, breaks, applied, crossed, breaks = 0 AND applied > 0 AND crossed = 0 AND NOT coalesce(seed_crossed, false) AND NOT coalesce(broken, false) AS ok FROM c JOIN r USING (symbol) LEFT JOIN s USING (symbol) LEFT JOIN h USING (symbol)"
)
def q20_book_verdict(spark, d):
    diffs = diffs_of(spark, d)
    return quality.book_verdict(book.continuity(diffs), o05_rebuild(spark, d), o04_seed_crossed(spark, d), book.midnight_handoff(diffs))


#: The type of the message that an event is sent as; `trade` is a type that no lane takes.
KIND = "CASE event_id % 5 WHEN 0 THEN 'aggTrade' WHEN 1 THEN 'depthUpdate' WHEN 2 THEN 'forceOrder' WHEN 3 THEN 'kline' ELSE 'trade' END"


def envelopes(spark: SparkSession, d: str) -> DataFrame:
    """Events as envelopes of all types: liquidations as arrays of two, and now and then text that is no envelope."""
    rows = view(spark, d, "ev").withColumn("kind", F.expr(KIND))
    one = F.to_json(F.struct(F.col("kind").alias("e"), F.col("timestamp_ms").alias("E")))
    data = F.when(F.col("kind") == "forceOrder", F.concat(F.lit("["), one, F.lit(","), one, F.lit("]"))).otherwise(one)
    whole = F.concat(F.lit('{"stream":"tape","data":'), data, F.lit("}"))
    return rows.select(F.when(F.col("event_id") % 11 == 0, "no envelope").otherwise(whole).alias("value"))


SENT = f"sent AS (SELECT CASE WHEN event_id % 11 = 0 THEN NULL ELSE {KIND} END AS event_type, CASE WHEN event_id % 11 = 0 THEN NULL ELSE timestamp_ms END AS timestamp_ms FROM ev UNION ALL SELECT 'forceOrder', timestamp_ms FROM ev WHERE event_id % 5 = 2 AND event_id % 11 <> 0)"


@query(f"WITH {SENT} SELECT event_type, timestamp_ms FROM sent")
def a04_parse_messages(spark, d):
    return messages.parse_messages(envelopes(spark, d)).select("event_type", F.get_json_object("payload", "$.E").cast("bigint").alias("timestamp_ms"))


@query(f"WITH {SENT} SELECT CASE WHEN event_type IS NULL OR event_type = 'trade' THEN 'dropped' ELSE event_type END AS kind, timestamp_ms FROM sent")
def a05_route(spark, d):
    parts = []
    for kind, rows in messages.route(messages.parse_messages(envelopes(spark, d))).items():
        at = F.get_json_object("payload", "$.E").cast("bigint") if kind == "dropped" else F.col("E")
        parts.append(rows.select(F.lit(kind).alias("kind"), at.alias("timestamp_ms")))
    return functools.reduce(DataFrame.unionByName, parts)


LEVEL = "concat('[[\"', CAST(price AS VARCHAR), '\",\"', CAST(qty AS VARCHAR), '\"]]')"


@query(f"SELECT symbol, timestamp_ms, u AS first_update_id, u AS last_update_id, pu AS prev_update_id, CASE WHEN side = 'bid' THEN {LEVEL} ELSE '[]' END AS bids_json, CASE WHEN side = 'ask' THEN {LEVEL} ELSE '[]' END AS asks_json FROM v_diffs")
def a06_to_diffs(spark, d):
    c = F.col
    level = F.array(F.array(c("price").cast("string"), c("qty").cast("string")))
    side = lambda name: F.when(c("side") == name, level).otherwise(F.array().cast("array<array<string>>"))
    data = F.struct(F.lit("depthUpdate").alias("e"), c("timestamp_ms").alias("E"), c("timestamp_ms").alias("T"), F.upper("symbol").alias("s"), c("u").alias("U"), c("u"), c("pu"), side("bid").alias("b"), side("ask").alias("a"))
    value = F.to_json(F.struct(F.lit("tape").alias("stream"), data.alias("data")))
    rows = messages.typed(messages.parse_messages(view(spark, d, "v_diffs").select(value.alias("value"))), "depthUpdate")
    return messages.to_diffs(rows).select("symbol", "timestamp_ms", "first_update_id", "last_update_id", "prev_update_id", "bids_json", "asks_json")


@query(f"SELECT symbol, timestamp_ms, open, high, low, close, volume, CAST(7 AS BIGINT) AS trade_count, volume / 2 AS taker_buy_base FROM v_bars WHERE timestamp_ms // {HOUR} % 3 <> 0")
def a08_to_klines(spark, d):
    c, text = F.col, lambda name: F.col(name).cast("string")
    closed = F.floor(c("timestamp_ms") / HOUR) % 3 != 0
    bar = F.struct(
        c("timestamp_ms").alias("t"), (c("timestamp_ms") + HOUR - 1).alias("T"), F.upper("symbol").alias("s"), F.lit("1h").alias("i"), text("open").alias("o"), text("high").alias("h"), text("low").alias("l"), text("close").alias("c"),
        text("volume").alias("v"), text("volume").alias("q"), F.lit(7).alias("n"), closed.alias("x"), (c("volume") / 2).cast("string").alias("V"), text("volume").alias("Q"),
    )
    data = F.struct(F.lit("kline").alias("e"), c("timestamp_ms").alias("E"), F.upper("symbol").alias("s"), bar.alias("k"))
    value = F.to_json(F.struct(F.lit("tape").alias("stream"), data.alias("data")))
    rows = messages.typed(messages.parse_messages(view(spark, d, "v_bars").select(value.alias("value"))), "kline")
    return messages.to_klines(rows).select("symbol", "timestamp_ms", "open", "high", "low", "close", "volume", "trade_count", "taker_buy_base")


@query("SELECT symbol, timestamp_ms + i AS timestamp_ms, value / 1e5 AS funding_rate, timestamp_ms + 28800000 AS next_funding_time FROM ev CROSS JOIN (SELECT 0 AS i UNION ALL SELECT 1) t WHERE (i = 0 OR event_id % 2 = 1) AND symbol < 's' AND symbol >= 'd'")
def a10_to_funding(spark, d):
    c, ev = F.col, view(spark, d, "ev")
    one = lambda i: F.to_json(F.struct(F.upper("symbol").alias("symbol"), c("value").cast("string").alias("markPrice"), (c("value") / 1e5).cast("string").alias("lastFundingRate"), (c("timestamp_ms") + 28_800_000).alias("nextFundingTime"), (c("timestamp_ms") + i).alias("time")))
    body = F.when(c("event_id") % 2 == 0, one(0)).otherwise(F.concat(F.lit("["), one(0), F.lit(","), one(1), F.lit("]")))
    symbols = ev.select("symbol").distinct()
    found = messages.to_funding(ev.select(body.alias("body")), symbols.filter("symbol < 's'"), symbols.filter("symbol < 'd'"))
    return found.select("symbol", "timestamp_ms", "funding_rate", "next_funding_time")


@query("SELECT symbol, timestamp_ms, '5m' AS period, CAST(k + 1 AS DOUBLE) AS buy_volume, CASE WHEN event_id % 9 <> 0 THEN value END AS sell_volume, CASE WHEN value <> 0 THEN (k + 1) / value END AS buy_sell_ratio FROM ev")
def a13_to_taker(spark, d):
    c = F.col
    sold = F.when(c("event_id") % 9 == 0, "none").otherwise(c("value").cast("string"))
    rows = view(spark, d, "ev").select(F.upper("symbol").alias("symbol"), c("timestamp_ms").alias("timestamp"), (c("k") + 1).cast("string").alias("buyVol"), sold.alias("sellVol"), F.when(c("value") != 0, (c("k") + 1) / c("value")).cast("string").alias("buySellRatio"))
    return messages.to_taker(rows).select("symbol", "timestamp_ms", "period", "buy_volume", "sell_volume", "buy_sell_ratio")


@query("SELECT 'mark_price_klines' AS datatype, symbol, timestamp_ms, open, high, low, close FROM v_bars")
def a14_to_price_klines(spark, d):
    fields = F.array(*[F.col(x).cast("string") for x in ("timestamp_ms", "open", "high", "low", "close")])
    short = F.array(F.col("timestamp_ms").cast("string"), F.col("open").cast("string"))
    rows = view(spark, d, "v_bars").select(F.upper("symbol").alias("symbol"), F.to_json(F.array(short, fields)).alias("body"))
    return messages.to_price_klines(rows, "mark_price_klines").select("datatype", "symbol", "timestamp_ms", "open", "high", "low", "close")


@query(f"SELECT symbol, timestamp_ms, close FROM v_bars WHERE timestamp_ms // {HOUR} % 3 <> 0")
def c07_closed_only(spark, d):
    bars = view(spark, d, "v_bars").withColumn("is_closed", F.floor(F.col("timestamp_ms") / HOUR) % 3 != 0)
    return filters.closed_only(bars).select("symbol", "timestamp_ms", "close")


@query("SELECT event_id, value AS price, CAST(k AS DOUBLE) AS quantity FROM ev WHERE event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0")
def c16_parsed(spark, d):
    c = F.col
    price = F.when(c("event_id") % 7 == 0, "1,5").when(c("event_id") % 11 == 0, "NaN").otherwise(c("value").cast("string"))
    quantity = F.when(c("event_id") % 13 == 0, "").otherwise(c("k").cast("string"))
    return filters.parsed(view(spark, d, "ev").select("event_id", price.alias("price"), quantity.alias("quantity")), ["price", "quantity"])


@query(
    "SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'orderbooks' WHEN 1 THEN 'premium_index_klines' WHEN 2 THEN 'funding_rates' WHEN 3 THEN 'exchange_info' ELSE 'unknown' END AS endpoint, CASE WHEN event_id % 5 = 3 THEN 'ALL' ELSE upper(symbol) END AS symbol, "
    "CAST(CASE WHEN event_id % 5 <> 0 THEN 1 WHEN k * 7 <= 50 THEN 2 WHEN k * 7 <= 100 THEN 5 WHEN k * 7 <= 500 THEN 10 ELSE 20 END AS INT) AS weight FROM ev"
)
def c18_classify_request(spark, d):
    paths = ("/fapi/v1/depth?symbol={s}&limit={n}", "/fapi/v1/premiumIndexKlines?symbol={s}", "/fapi/v1/premiumIndex?symbol={s}", "/fapi/v1/exchangeInfo", "/fapi/v1/time?symbol={s}")
    path = F.element_at(F.array(*[F.lit(p) for p in paths]), (F.col("event_id") % 5 + 1).cast("int"))
    url = F.replace(F.replace(path, F.lit("{s}"), F.upper("symbol")), F.lit("{n}"), (F.col("k") * 7).cast("string"))
    return view(spark, d, "ev").select("event_id", fn.classify_request(url).alias("r")).select("event_id", "r.*")


@query("SELECT event_id, value AS price, CAST(k AS DOUBLE) AS qty FROM ev UNION ALL SELECT event_id, NULL, 1.0 FROM ev WHERE event_id % 3 = 0")
def h09_levels(spark, d):
    c = F.col
    pair = F.array(c("value").cast("string"), c("k").cast("string"))
    text = F.when(c("event_id") % 3 == 0, fn.levels_json(F.array(pair, F.array(F.lit("x"), F.lit("1"))))).otherwise(fn.levels_json(F.array(pair)))
    return view(spark, d, "ev").select("event_id", F.inline(fn.levels(text)))


@query(f"WITH {ROWS}, {SEEN} SELECT lane, symbol, last_ms FROM seen")
def t06_freshness(spark, d):
    return state.freshness(agg.lane_rows(lanes(spark, d))).select("lane", "symbol", "last_ms")


@query(
    f"WITH c AS (SELECT concat(symbol, CAST(user_id % 50 AS VARCHAR)) AS symbol, arg_max(event_id % 3, event_id) AS last FROM ev WHERE user_id % 2 = 0 GROUP BY 1), t AS (SELECT DISTINCT concat(symbol, CAST(user_id % 50 AS VARCHAR)) AS symbol FROM ev WHERE user_id % 3 = 0), "
    f"k AS (SELECT symbol FROM t WHERE symbol NOT IN (SELECT symbol FROM c WHERE last = 0)) SELECT symbol, CAST(5 AS BIGINT) AS since_ms FROM k UNION ALL SELECT symbol, {NOW} FROM c WHERE last <> 0 AND symbol NOT IN (SELECT symbol FROM k)"
)
def t10_pending_listings(spark, d):
    rows = view(spark, d, "ev").withColumn("symbol", F.concat("symbol", (F.col("user_id") % 50).cast("string")))
    change = F.when(F.col("event_id") % 3 == 0, "removed").otherwise("added")
    changes = rows.filter("user_id % 2 = 0").select("symbol", F.col("event_id").alias("cycle"), change.alias("change"))
    known = rows.filter("user_id % 3 = 0").select("symbol").distinct().withColumn("since_ms", F.lit(5).cast("bigint"))
    return ingest.pending_listings(changes, known, NOW)


@query(f"WITH {SENT} SELECT event_type, count(*) AS messages FROM sent GROUP BY event_type")
def t11_stream_metrics(spark, d):
    return ingest.stream_metrics(messages.parse_messages(envelopes(spark, d)))


# ---- composite entry points, exports and paths --------------------------------------------------------------------------


@query(f"WITH {_book_sql(T)} SELECT symbol, side, price, qty FROM book")
def b09_export_book(spark, d):
    return export_book(o06_book_at(spark, d)).select("symbol", "side", "price", "qty")


@query("SELECT 'discovered' AS origin, symbol FROM (SELECT DISTINCT lower(symbol) AS symbol FROM v_contracts WHERE status = 'TRADING') UNION ALL SELECT 'whitelist', unnest(['p1usdt', 'p2usdt'])")
def c15_select_universe(spark, d):
    found = view(spark, d, "v_contracts").filter("status = 'TRADING'")
    named = lambda origin, df: df.select(F.lit(origin).alias("origin"), "symbol")
    return named("discovered", filters.select_universe(None, found)).unionByName(named("whitelist", filters.select_universe(["P1USDT", "p2usdt", "P2usdt"], found)))


DATE = "strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%d')"
HOUR_OF = f"CAST(timestamp_ms % {DAY} // {HOUR} AS INT)"


@query(f"SELECT event_id, {DATE} AS date, {HOUR_OF} AS hour, ({HOUR_OF} + 1) % 24 AS next_hour, concat('trades/', symbol, '/', {DATE}, '/', symbol, '_trades_', {DATE}, '.csv') AS path FROM ev")
def h13_partition_parts(spark, d):
    ms = F.col("timestamp_ms")
    parts = fn.partition_parts(ms)
    return view(spark, d, "ev").select("event_id", *[parts[k].alias(k) for k in ("date", "hour", "next_hour")], fn.partition_path(F.lit("trades"), F.col("symbol"), ms).alias("path"))


@query(f"SELECT event_id, timestamp_ms - timestamp_ms % {HOUR} AS start_ms, CAST(NULL AS BIGINT) AS daily FROM ev")
def h14_file_hour(spark, d):
    parts = fn.partition_parts(F.col("timestamp_ms"))
    two = lambda k: F.lpad(parts[k].cast("string"), 2, "0")
    hourly = F.concat("symbol", F.lit("_depth_updates_"), parts["date"], F.lit("_"), two("hour"), F.lit("00-to-"), two("next_hour"), F.lit("00.csv"))
    daily = F.concat("symbol", F.lit("_depth_snapshot_"), parts["date"], F.lit(".csv"))
    return view(spark, d, "ev").select("event_id", fn.file_hour(hourly).alias("start_ms"), fn.file_hour(daily).alias("daily"))


DAY_T = T - T % DAY
INSIDE = f"timestamp_ms BETWEEN {DAY_T} AND {DAY_T + DAY - 1}"


@query(
    f"WITH n AS (SELECT symbol, count(*) AS liquidations FROM v_liquidations WHERE {INSIDE} GROUP BY symbol), s AS (SELECT DISTINCT symbol FROM v_snaps WHERE {INSIDE}), b AS (SELECT symbol, min(timestamp_ms) AS from_ms, max(timestamp_ms) + 60000 AS to_ms, count(*) AS bars, arg_max(close, timestamp_ms) AS last_close FROM v_bars WHERE {INSIDE} GROUP BY symbol) "
    "SELECT symbol, from_ms, to_ms, bars, s.symbol IS NOT NULL AS has_book, last_close, liquidations FROM b LEFT JOIN s USING (symbol) LEFT JOIN n USING (symbol)"
)
def m05_replay_day(spark, d):
    found = replay_day(view(spark, d, "v_bars").withColumn("seq", F.col("timestamp_ms")), view(spark, d, "v_liquidations"), view(spark, d, "v_snaps"), DAY_T)
    last = found["prices"].groupBy("symbol").agg(F.max_by("close", "timestamp_ms").alias("last_close"))
    return found["days"].join(last, "symbol").join(found["liquidations"].groupBy("symbol").agg(F.count("*").alias("liquidations")), "symbol", "left")


@query(
    f"WITH {_book_sql(T)}, t AS (SELECT symbol, max(CASE WHEN side = 'bid' THEN price END) AS best_bid, min(CASE WHEN side = 'ask' THEN price END) AS best_ask, count(*) AS levels FROM book GROUP BY symbol), "
    f"g AS (SELECT symbol, bool_or(coalesce(pu <> b, false)) AS gap FROM (SELECT e.symbol, pu, lag(u) OVER (PARTITION BY e.symbol ORDER BY u) AS b FROM v_diffs e JOIN anchors a ON e.symbol = a.symbol AND e.u > a.anchor_id AND e.timestamp_ms <= {T}) GROUP BY symbol), "
    f"c AS (SELECT symbol, arg_max(close, timestamp_ms) AS close FROM v_bars WHERE timestamp_ms BETWEEN {DAY_T - DAY} AND {T} GROUP BY symbol), p AS (SELECT symbol, least(count(*), 40) AS tape FROM v_trades WHERE timestamp_ms <= {T} AND timestamp_ms > {T - DAY} GROUP BY symbol) "
    "SELECT t.symbol, best_bid, best_ask, gap, close, tape FROM t LEFT JOIN g USING (symbol) LEFT JOIN c USING (symbol) LEFT JOIN p USING (symbol)"
)
def m06_replay_at(spark, d):
    found = {
        "klines": view(spark, d, "v_bars").withColumn("seq", F.col("timestamp_ms")), "funding_rates": view(spark, d, "v_funding"), "open_interest": view(spark, d, "v_open_interest"),
        "long_short_ratio": view(spark, d, "v_long_short"), "trades": view(spark, d, "v_trades"), "liquidations": view(spark, d, "v_liquidations"),
    }
    state = replay_at(found, view(spark, d, "v_snaps"), events_of(spark, d), diffs_of(spark, d), T)
    tape = state["tape"].groupBy("symbol").agg(F.count("*").alias("tape"))
    out = state["top"].join(state["gap"].select("symbol", "gap"), "symbol", "left").join(state["close"].select("symbol", "close"), "symbol", "left")
    return out.join(tape, "symbol", "left").select("symbol", "best_bid", "best_ask", "gap", "close", "tape")


@query(
    "WITH c AS (SELECT symbol, least(count(*), 180) AS candles FROM v_bars GROUP BY symbol), t AS (SELECT symbol, least(count(*), 60) AS trades FROM v_trades GROUP BY symbol), f AS (SELECT symbol, arg_max(funding_rate, seq) AS funding_rate FROM v_funding GROUP BY symbol), "
    "o AS (SELECT symbol, arg_max(oi_value, seq) AS oi_value FROM v_open_interest GROUP BY symbol), r AS (SELECT symbol, count(DISTINCT ratio_type) AS ratios FROM v_long_short GROUP BY symbol) SELECT symbol, candles, trades, funding_rate, oi_value, ratios FROM c JOIN t USING (symbol) JOIN f USING (symbol) JOIN o USING (symbol) JOIN r USING (symbol)"
)
def m07_symbol_detail(spark, d):
    found = symbol_detail({
        "klines": view(spark, d, "v_bars").withColumn("seq", F.col("timestamp_ms")), "trades": view(spark, d, "v_trades"), "funding_rates": view(spark, d, "v_funding"),
        "open_interest": view(spark, d, "v_open_interest"), "long_short_ratio": view(spark, d, "v_long_short"),
    })
    count = lambda k, name: found[k].groupBy("symbol").agg(F.count("*").alias(name))
    out = count("candles", "candles").join(count("trades", "trades"), "symbol").join(found["funding"].select("symbol", "funding_rate"), "symbol")
    return out.join(found["open_interest"].select("symbol", "oi_value"), "symbol").join(count("ratios", "ratios"), "symbol")


@query(_text["e09_coverage_totals"])
def m11_coverage(spark, d):
    rows = agg.lane_rows({k: v.withColumn("file_name", agg.day()) for k, v in lanes(spark, d).items()}, "file_name")
    return coverage(rows, view(spark, d, "v_liquidations"), NOW)["totals"]


@query(f"WITH x AS ({_text['o11_midnight_handoff']}), y AS ({_text['o12_midnight_trade_gap']}) SELECT x.symbol, x.day_ms, x.handoff, y.gap_ms FROM x LEFT JOIN y ON x.symbol = y.symbol AND x.day_ms = y.day_ms")
def m16_soak_report(spark, d):
    samples = view(spark, d, "ev").select("timestamp_ms", F.col("k").alias("rss_mb"), F.col("user_id").alias("reconnects"))
    found = soak_report(samples, diffs_of(spark, d), view(spark, d, "v_trades"))
    return found["handoffs"].join(found["trade_gaps"], ["symbol", "day_ms"], "left").select("symbol", "day_ms", "handoff", "gap_ms")


@query(f"WITH s AS ({_text['e19_request_success']}), b AS (SELECT route, endpoint, sum(weight) OVER (ORDER BY timestamp_ms RANGE BETWEEN 300000 PRECEDING AND CURRENT ROW) > 20 AS over_budget FROM v_requests), n AS (SELECT route, endpoint, count(*) FILTER (WHERE over_budget) AS over_budget FROM b GROUP BY 1, 2) SELECT s.route, s.endpoint, s.requests, s.succeeded, n.over_budget FROM s JOIN n ON s.route = n.route AND s.endpoint = n.endpoint")
def m17_request_audit(spark, d):
    found = request_audit(view(spark, d, "v_requests"), 300_000, 20)
    over = found["budget"].groupBy("route", "endpoint").agg(F.count_if("over_budget").alias("over_budget"))
    return found["success"].join(over, ["route", "endpoint"]).select("route", "endpoint", "requests", "succeeded", "over_budget")


@query(
    f"WITH b AS (SELECT {NOW / 1000} - max(timestamp_ms) / 1e3 AS age_s, arg_max(event_id, timestamp_ms) AS messages_total FROM ev WHERE timestamp_ms <= {NOW}), {ROWS}, {SEEN}, l AS (SELECT lane, count(*) AS seen, count(*) FILTER (WHERE {NOW} - last_ms < 3600000) AS healthy FROM seen GROUP BY lane) "
    "SELECT age_s, age_s < 900 AS live, messages_total, (SELECT count(*) FROM l) AS lanes, (SELECT count(*) FROM l WHERE healthy >= seen) AS healthy_lanes FROM b"
)
def m14_health(spark, d):
    beats = view(spark, d, "ev").filter(F.col("timestamp_ms") <= NOW).select((F.col("timestamp_ms") / 1e3).alias("timestamp"), F.col("event_id").alias("messages_total"), *[F.lit(0).alias(c) for c in ("errors", "active_symbols", "orderbooks_live")])
    seen = agg.last_seen(agg.lane_rows(lanes(spark, d)))
    per = seen.groupBy("lane").agg(F.count("*").alias("seen"), F.count_if(NOW - F.col("last_ms") < HOUR).alias("healthy"))
    return health(beats, per, NOW / 1000, 900).select("age_s", "live", "messages_total", "lanes", "healthy_lanes")
