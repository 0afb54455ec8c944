"""Registered queries that go through files, and the composite entry points with all their rows.

The views are written as a tree, a lake or logs in the folder that the session shares, and read back by the library's readers.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import plans
from . import queries as tape
from .adapters import view
from .functions import iso_utc
from .operators import aggregates as agg
from .operators import book, quality, windows
from .queries import DAY_T, INSIDE, LADDER, NOW, T, _book_sql, _text, diffs_of, events_of, lanes, query
from .schemas import DAY, HOUR
from .scratch import new_folder
from .sources import lanes as readers
from .sources import sinks
from .sources.tape import read_tape, write_tape

# ---- files ---------------------------------------------------------------------------------------------------------------


def updates_of(spark: SparkSession, d: str) -> DataFrame:
    """v_diffs as rows of the diff lane."""
    level = F.concat(F.lit('[["'), F.col("price").cast("string"), F.lit('","'), F.col("qty").cast("string"), F.lit('"]]'))
    text = lambda side: F.when(F.col("side") == side, level).otherwise("[]").alias(f"{side}s_json")
    return view(spark, d, "v_diffs").select("symbol", "timestamp_ms", F.col("u").alias("first_update_id"), F.col("u").alias("last_update_id"), F.col("pu").alias("prev_update_id"), text("bid"), text("ask"))


def snapshots_of(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_snaps").select("symbol", "timestamp_ms", "last_update_id", "side", "price", F.col("qty").alias("quantity"))


def lake_of(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Diffs and snapshots as a lake, by day and hour."""
    lake = new_folder(spark, "lake")
    sinks.write_diffs(updates_of(spark, d), lake)
    sinks.write_snaps(snapshots_of(spark, d), lake)
    return plans.lake_books(spark, lake)


@query(_text["o06_book_at"])
def c03_lake_book_at(spark, d):
    found = lake_of(spark, d)
    return book.book_at(found["snaps"], found["events"], T)


@query(_text["o07_book_at_gap"])
def c03_lake_book_gap(spark, d):
    found = lake_of(spark, d)
    return book.book_at_gap(found["snaps"], found["diffs"], T)


@query(f"WITH {_book_sql(None)}, {LADDER} SELECT symbol, side, price, qty, level, cumulative FROM ladder")
def m04_lake_book_now(spark, d):
    found = lake_of(spark, d)
    return plans.book_now(found["snaps"], found["events"])[0].select("symbol", "side", "price", "qty", "level", "cumulative")


@query(_text["f01_previous_update"])
def a02_tape_of_diffs(spark, d):
    """The update before, in the order of the files and their rows."""
    root = new_folder(spark, "tree")
    write_tape(updates_of(spark, d), root, "depth_updates")
    rows = read_tape(spark, root, "depth_updates").select("symbol", F.col("last_update_id").alias("u"), "seq")
    return windows.previous(rows, "u", ["symbol"], ["seq"]).select("symbol", "u", "previous")


@query("SELECT symbol, timestamp_ms, trade_id, side, price, quantity FROM v_trades")
def a01_tape_of_trades(spark, d):
    root = new_folder(spark, "tree")
    write_tape(view(spark, d, "v_trades").select("symbol", "timestamp_ms", "trade_id", "side", "price", "quantity", "seq"), root, "trades")
    return read_tape(spark, root, "trades").select("symbol", "timestamp_ms", "trade_id", "side", "price", "quantity")


@query("SELECT symbol, timestamp_ms, last_update_id, side, price, qty FROM v_snaps")
def a03_tape_of_snapshots(spark, d):
    root = new_folder(spark, "tree")
    write_tape(snapshots_of(spark, d), root, "depth_snapshot")
    return read_tape(spark, root, "depth_snapshot").select("symbol", "timestamp_ms", "last_update_id", "side", "price", F.col("quantity").alias("qty"))


DATE = "CAST(make_timestamp(timestamp_ms * 1000) AS DATE)"


@query(f"SELECT symbol, timestamp_ms, seq, CAST({DATE} AS VARCHAR) AS date FROM v_trades")
def b01_daily_lane(spark, d):
    lake = new_folder(spark, "lake")
    sinks.write_lane(view(spark, d, "v_trades"), lake, "trades")
    return spark.read.parquet(f"{lake}/trades").select("symbol", "timestamp_ms", "seq", F.col("date").cast("string").alias("date"))


@query(f"SELECT symbol, u, CAST({DATE} AS VARCHAR) AS date, CAST(timestamp_ms % {DAY} // {HOUR} AS INT) AS hour, lag(u) OVER (PARTITION BY symbol, timestamp_ms // {HOUR} ORDER BY u) AS before FROM v_diffs")
def b02_hourly_diffs(spark, d):
    """Diffs of hourly directories, and the update before in the order in which a file holds its rows."""
    lake = new_folder(spark, "lake")
    sinks.write_diffs(updates_of(spark, d), lake)
    found = spark.read.parquet(f"{lake}/depth_updates")
    rows = found.select("symbol", F.col("last_update_id").alias("u"), F.col("date").cast("string").alias("date"), "hour", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return windows.previous(rows, "u", ["symbol", "_file"], ["_row"], "before").drop("_file", "_row")


@query("SELECT symbol, last_update_id, side, price, row_number() OVER (PARTITION BY symbol, last_update_id ORDER BY side DESC, CASE WHEN side = 'bid' THEN -price ELSE price END) AS place FROM v_snaps")
def b04_snapshot_rows(spark, d):
    """The levels of each snapshot in the order in which its file holds them."""
    lake = new_folder(spark, "lake")
    sinks.write_snaps(snapshots_of(spark, d), lake)
    rows = spark.read.parquet(f"{lake}/depth_snapshot").select("symbol", "last_update_id", "side", "price", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    place = F.row_number().over(windows.Window.partitionBy("symbol", "last_update_id").orderBy("_file", "_row"))
    return rows.withColumn("place", place.cast("bigint")).drop("_file", "_row")


@query(_text["m01_matrix"])
def b08_matrix_file(spark, d):
    path = new_folder(spark, "matrix")
    sinks.write_matrix(tape.m01_matrix(spark, d), path)
    return spark.read.schema(tape.m01_matrix(spark, d).schema).option("header", True).csv(path).withColumn("datetime_utc", F.col("datetime_utc").cast("string"))


@query("SELECT symbol AS file_name, event_id AS seq, CASE WHEN event_id % 3 = 0 THEN 'WARN' WHEN event_id % 3 = 1 THEN 'INFO' END AS level, CASE WHEN event_id % 3 = 0 THEN concat('WARN at ', event_id) WHEN event_id % 3 = 1 THEN concat('INFO at ', event_id) ELSE concat('more of ', event_id) END AS line FROM ev")
def a18_log_files(spark, d):
    """A log for each symbol; lines are told by what they hold, in the order of the file."""
    path = new_folder(spark, "logs")
    k = F.col("event_id") % 3
    line = F.concat(F.when(k == 0, "WARN at ").when(k == 1, "INFO at ").otherwise("more of "), F.col("event_id").cast("string"))
    view(spark, d, "ev").select("symbol", line.alias("value"), "event_id").repartition("symbol").sortWithinPartitions("symbol", "event_id").select("symbol", "value").write.partitionBy("symbol").text(path)
    found = readers.read_logs(spark, f"{path}/*/")
    told = F.regexp_extract("line", "([0-9]+)$", 1).cast("bigint").alias("told")
    named = found.select(told, "seq", "level", "line").join(view(spark, d, "ev").select(F.col("event_id").alias("told"), F.col("symbol").alias("file_name")), "told")
    place = lambda c: F.row_number().over(windows.Window.partitionBy("file_name").orderBy(c))
    return named.withColumns({"n": place("seq"), "m": place("told")}).filter("n = m").select("file_name", F.col("told").alias("seq"), "level", "line")


@query("SELECT timestamp_ms // 1000 * 1000 AS timestamp_ms, CAST(k AS DOUBLE) AS rss_mb, user_id AS reconnects FROM ev")
def a19_soak_file(spark, d):
    path = new_folder(spark, "soak")
    names = [c.split()[0] for c in readers.SOAK.split(", ")]
    made = {"ts_utc": iso_utc(F.col("timestamp_ms")), "epoch": F.floor(F.col("timestamp_ms") / 1000), "rss_mb": F.col("k").cast("double"), "reconnects": F.col("user_id")}
    view(spark, d, "ev").select(*[made.get(n, F.lit(1)).alias(n) for n in names]).write.option("header", True).csv(path)
    return readers.read_soak(spark, path).select("timestamp_ms", "rss_mb", "reconnects")


@query("SELECT timestamp_ms, concat('r', route) AS route, endpoint, endpoint AS symbol, success FROM v_requests")
def a20_request_file(spark, d):
    path = new_folder(spark, "requests")
    rows = view(spark, d, "v_requests")
    rows.select((F.col("timestamp_ms") / 1000).alias("timestamp"), F.upper("endpoint").alias("symbol"), F.col("endpoint").alias("endpoint_type"), F.concat(F.lit("r"), F.col("route").cast("string")).alias("proxy_name"), "success").write.json(path)
    return readers.read_requests(spark, path).select("timestamp_ms", "route", "endpoint", "symbol", "success")


@query("SELECT symbol, event_id // 1 AS n, 'gap' AS reason FROM (SELECT symbol, event_id, row_number() OVER (PARTITION BY symbol ORDER BY timestamp_ms DESC, event_id DESC) AS place FROM ev) WHERE place <= 200")
def m13_gap_files(spark, d):
    """A file of gap events for each symbol, the last 200 of each."""
    path = new_folder(spark, "gaps")
    stamp = (F.col("timestamp_ms") + F.col("event_id") / 1e7).alias("timestamp")
    view(spark, d, "ev").select("symbol", F.lit("gap").alias("type"), F.col("event_id").cast("string").alias("datetime_utc"), F.lit("gap").alias("reason"), stamp).write.partitionBy("symbol").json(path)
    read = readers.read_gap_events(spark, f"{path}/*/*.json", one_a_line=True, symbol_of=2)
    return plans.gap_log(read).select("symbol", F.col("datetime_utc").cast("bigint").alias("n"), "reason")


RAW = "raw AS (SELECT symbol, event_id, CASE WHEN event_id % 50 = 0 THEN 2 WHEN event_id % 77 = 0 THEN 1 ELSE 0 END AS fault FROM ev)"


@query(f"WITH {RAW} SELECT symbol, 'row_width' AS issue, count(*) AS n FROM raw WHERE fault = 2 GROUP BY symbol UNION ALL SELECT symbol, 'repeated_header', count(*) FROM raw WHERE fault = 1 GROUP BY symbol")
def q23_file_issues(spark, d):
    """Files of raw lines with rows of another width and headers among the rows."""
    path = raw_tree(spark, d)
    found = readers.read_lines(spark, path, "rows", pattern="*.txt")
    return quality.file_issues(found, RAW_HEAD).select(F.regexp_extract("file_name", "symbol=([^/]+)", 1).alias("symbol"), "issue", "n")


@query(_text["q23_file_issues"])
def q26_changed_files(spark, d):
    """The same by two runs over one state: the first reads a tree with half of the symbols, the second what has come since."""
    path, state = new_folder(spark, "raw"), new_folder(spark, "verified")
    symbols = sorted(r.symbol for r in view(spark, d, "ev").select("symbol").distinct().collect())  # some event types
    for some in (symbols[::2], symbols[1::2]):
        raw_tree(spark, d, path, some)
        found = plans.verify_changed(spark, path, {"rows": RAW_HEAD}, state, "*.txt")
    return found["issues"].select(F.regexp_extract("file_name", "symbol=([^/]+)", 1).alias("symbol"), "issue", "n")


RAW_HEAD = ["symbol", "event_id", "value"]


def raw_tree(spark: SparkSession, d: str, path: str | None = None, symbols: list[str] | None = None) -> str:
    path, head = path or new_folder(spark, "raw"), RAW_HEAD
    row = F.concat_ws(",", "symbol", F.col("event_id").cast("string"), F.lit('"1,5"'))
    line = F.when(F.col("event_id") % 50 == 0, F.concat(row, F.lit(",7"))).when(F.col("event_id") % 77 == 0, ",".join(head)).otherwise(row)
    events = view(spark, d, "ev")
    events = events if symbols is None else events.filter(F.col("symbol").isin(symbols))
    lines = events.select("symbol", F.lit(1).alias("n"), line.alias("value"))
    heads = lines.select("symbol").distinct().select("symbol", F.lit(0).alias("n"), F.lit(",".join(head)).alias("value"))
    lines.unionByName(heads).repartition("symbol").sortWithinPartitions("symbol", "n").select("symbol", "value").write.mode("append").partitionBy("symbol").text(f"{path}/rows")
    return path


# ---- composite entry points, all rows ------------------------------------------------------------------------------------

FIELDS = ("symbol", "k", "name", "x", "y", "z")
KINDS = {"symbol": ("string", "VARCHAR"), "k": ("bigint", "BIGINT"), "name": ("string", "VARCHAR"), "x": ("double", "DOUBLE"), "y": ("double", "DOUBLE"), "z": ("double", "DOUBLE")}


def all_rows(**parts: tuple[str, dict[str, str]]):
    """Registers a function that gives a table for each part; a part has its SQL, and which of its columns are symbol, k (a number),
    name, x, y and z."""
    one = lambda part, sql, names: f"SELECT '{part}' AS part, " + ", ".join(f"CAST({names.get(f, 'NULL')} AS {KINDS[f][1]}) AS {f}" for f in FIELDS) + f" FROM ({sql})"
    whole = " UNION ALL ".join(one(part, sql, names) for part, (sql, names) in parts.items())

    def put(f):
        @functools.wraps(f)
        def run(spark: SparkSession, d: str) -> DataFrame:
            found = f(spark, d)
            pick = lambda names, c: F.col(names[c]) if c in names else F.lit(None)
            made = [found[part].select(F.lit(part).alias("part"), *[pick(names, c).cast(KINDS[c][0]).alias(c) for c in FIELDS]) for part, (_, names) in parts.items()]
            return functools.reduce(DataFrame.unionByName, made)

        return query(whole)(run)

    return put


def bars_of(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_bars").withColumn("seq", F.col("timestamp_ms"))


DAY_BARS = f"SELECT symbol, timestamp_ms, close, volume FROM v_bars WHERE {INSIDE}"


@all_rows(
    prices=(DAY_BARS, {"symbol": "symbol", "k": "timestamp_ms", "x": "close", "y": "volume"}),
    liquidations=(f"SELECT symbol, timestamp_ms, side, price, quantity, value FROM v_liquidations WHERE {INSIDE}", {"symbol": "symbol", "k": "timestamp_ms", "name": "side", "x": "price", "y": "quantity", "z": "value"}),
    days=(
        f"SELECT b.symbol, bars, s.symbol IS NOT NULL AS has_book, from_ms, to_ms FROM (SELECT symbol, count(*) AS bars, min(timestamp_ms) AS from_ms, max(timestamp_ms) + 60000 AS to_ms FROM v_bars WHERE {INSIDE} GROUP BY symbol) b LEFT JOIN (SELECT DISTINCT symbol FROM v_snaps WHERE {INSIDE}) s ON s.symbol = b.symbol",
        {"symbol": "symbol", "k": "bars", "name": "has_book", "x": "from_ms", "y": "to_ms"},
    ),
)
def m05_replay_day_rows(spark, d):
    return plans.replay_day(bars_of(spark, d), view(spark, d, "v_liquidations"), view(spark, d, "v_snaps"), DAY_T)


RECENT = f"timestamp_ms BETWEEN {DAY_T - DAY} AND {T}"
FIRST_OF_LAST = "timestamp_ms * 1000000 - seq % 1000000"


@all_rows(
    ladder=(_text["f05_ladder"], {"symbol": "symbol", "k": "level", "name": "side", "x": "price", "y": "qty", "z": "cumulative"}),
    top=(f"WITH {_book_sql(T)} SELECT symbol, max(CASE WHEN side = 'bid' THEN price END) AS best_bid, min(CASE WHEN side = 'ask' THEN price END) AS best_ask FROM book GROUP BY symbol", {"symbol": "symbol", "x": "best_bid", "y": "best_ask"}),
    gap=(_text["o07_book_at_gap"], {"symbol": "symbol", "k": "applied", "name": "gap"}),
    tape=(f"SELECT symbol, timestamp_ms, side, price, quantity, n AS place FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp_ms DESC, seq DESC) AS n FROM v_trades WHERE timestamp_ms <= {T} AND timestamp_ms > {T - DAY}) WHERE n <= 40", {"symbol": "symbol", "k": "timestamp_ms", "name": "side", "x": "price", "y": "quantity", "z": "place"}),
    close=(f"SELECT symbol, max(timestamp_ms) AS timestamp_ms, arg_max(close, timestamp_ms) AS close FROM v_bars WHERE {RECENT} GROUP BY symbol", {"symbol": "symbol", "k": "timestamp_ms", "x": "close"}),
    funding=(f"SELECT symbol, max(timestamp_ms) AS timestamp_ms, arg_max(funding_rate, {FIRST_OF_LAST}) AS funding_rate, arg_max(next_funding_time, {FIRST_OF_LAST}) AS next_funding_time FROM v_funding WHERE {RECENT} GROUP BY symbol", {"symbol": "symbol", "k": "timestamp_ms", "x": "funding_rate", "y": "next_funding_time"}),
    open_interest=(f"SELECT symbol, max(timestamp_ms) AS timestamp_ms, arg_max(open_interest, {FIRST_OF_LAST}) AS open_interest, arg_max(oi_value, {FIRST_OF_LAST}) AS oi_value FROM v_open_interest WHERE {RECENT} GROUP BY symbol", {"symbol": "symbol", "k": "timestamp_ms", "x": "open_interest", "y": "oi_value"}),
    ratio=(_text["d07_asof_ratio"], {"symbol": "symbol", "k": "timestamp_ms", "x": "long_short_ratio"}),
    liquidations=(f"SELECT symbol, timestamp_ms, side, price, quantity, value FROM v_liquidations WHERE timestamp_ms > {T - 3000} AND timestamp_ms <= {T}", {"symbol": "symbol", "k": "timestamp_ms", "name": "side", "x": "price", "y": "quantity", "z": "value"}),
)
def m06_replay_at_rows(spark, d):
    found = {"klines": bars_of(spark, d)} | {k: view(spark, d, v) for k, v in (("funding_rates", "v_funding"), ("open_interest", "v_open_interest"), ("long_short_ratio", "v_long_short"), ("trades", "v_trades"), ("liquidations", "v_liquidations"))}
    return plans.replay_at(found, view(spark, d, "v_snaps"), events_of(spark, d), diffs_of(spark, d), T)


CANDLES = _text["e04_candles"]


@all_rows(
    candles=(CANDLES, {"symbol": "symbol", "k": "timestamp_ms", "x": "open", "y": "close", "z": "volume"}),
    change=(_text["e06_price_change"].replace("FROM v_bars", f"FROM ({CANDLES})"), {"symbol": "symbol", "k": "span_ms", "x": "first_close", "y": "last_close", "z": "change_pct"}),
    trades=("SELECT symbol, timestamp_ms, side, price, quantity, n AS place FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp_ms DESC, seq DESC) AS n FROM v_trades) WHERE n <= 60", {"symbol": "symbol", "k": "timestamp_ms", "name": "side", "x": "price", "y": "quantity", "z": "place"}),
    funding=("SELECT symbol, arg_max(timestamp_ms, seq) AS timestamp_ms, arg_max(funding_rate, seq) AS funding_rate, arg_max(next_funding_time, seq) AS next_funding_time FROM v_funding GROUP BY symbol", {"symbol": "symbol", "k": "timestamp_ms", "x": "funding_rate", "y": "next_funding_time"}),
    open_interest=("SELECT symbol, arg_max(timestamp_ms, seq) AS timestamp_ms, arg_max(open_interest, seq) AS open_interest, arg_max(oi_value, seq) AS oi_value FROM v_open_interest GROUP BY symbol", {"symbol": "symbol", "k": "timestamp_ms", "x": "open_interest", "y": "oi_value"}),
    ratios=("SELECT symbol, ratio_type, arg_max(timestamp_ms, seq) AS timestamp_ms, arg_max(long_ratio, seq) AS long_ratio, arg_max(short_ratio, seq) AS short_ratio, arg_max(long_short_ratio, seq) AS long_short_ratio FROM v_long_short GROUP BY 1, 2", {"symbol": "symbol", "k": "timestamp_ms", "name": "ratio_type", "x": "long_ratio", "y": "short_ratio", "z": "long_short_ratio"}),
)
def m07_symbol_detail_rows(spark, d):
    found = {"klines": bars_of(spark, d)} | {k: view(spark, d, v) for k, v in (("trades", "v_trades"), ("funding_rates", "v_funding"), ("open_interest", "v_open_interest"), ("long_short_ratio", "v_long_short"))}
    return plans.symbol_detail(found)


@all_rows(
    totals=(_text["e09_coverage_totals"], {"name": "lane", "k": "symbols", "x": "files", "y": "gaps"}),
    days=(_text["e07_days_present"], {"symbol": "symbol", "name": "lane", "k": "day_ms"}),
    calendar=(_text["e08_coverage_calendar"], {"name": "lane", "k": "day_ms", "x": "symbols"}),
    stalest=(f"WITH {tape.ROWS}, {tape.SEEN} SELECT symbol, {NOW} - max(last_ms) AS age_ms FROM seen GROUP BY symbol HAVING age_ms BETWEEN 90000 AND 21599999 ORDER BY age_ms DESC, symbol LIMIT 12", {"symbol": "symbol", "k": "age_ms"}),
)
def m11_coverage_rows(spark, d):
    rows = agg.lane_rows({k: v.withColumn("file_name", agg.day()) for k, v in lanes(spark, d).items()}, "file_name")
    return plans.coverage(rows, view(spark, d, "v_liquidations"), NOW)


SLOPE = f"SELECT timestamp_ms - timestamp_ms % {DAY} AS day_ms, min(k) AS floor_mb, max(k) AS peak_mb, max(user_id) - min(user_id) AS reconnects, round(regr_slope(CASE WHEN h >= 6 AND h < 23 THEN k END, CASE WHEN h >= 6 AND h < 23 THEN h END), 6) AS slope FROM (SELECT *, timestamp_ms % {DAY} / 3600000 AS h FROM ev) GROUP BY 1"


@all_rows(
    days=(SLOPE, {"k": "day_ms", "name": "reconnects", "x": "floor_mb", "y": "peak_mb", "z": "slope"}),
    handoffs=(_text["o11_midnight_handoff"], {"symbol": "symbol", "k": "day_ms", "name": "handoff", "x": "ended_u", "y": "first_pu"}),
    trade_gaps=(_text["o12_midnight_trade_gap"], {"symbol": "symbol", "k": "day_ms", "x": "gap_ms"}),
)
def m16_soak_rows(spark, d):
    samples = view(spark, d, "ev").select("timestamp_ms", F.col("k").alias("rss_mb"), F.col("user_id").alias("reconnects"))
    found = plans.soak_report(samples, diffs_of(spark, d), view(spark, d, "v_trades"))
    return found | {"days": found["days"].withColumn("slope", F.round("slope_mb_h", 6))}


@all_rows(
    success=(_text["e19_request_success"], {"symbol": "endpoint", "k": "requests", "name": "route", "x": "succeeded", "y": "success_pct"}),
    budget=(_text["f11_rolling_budget"], {"k": "event_id", "name": "over_budget", "x": "spent"}),
)
def m17_request_audit_rows(spark, d):
    return plans.request_audit(view(spark, d, "v_requests"), 300_000, 20)

