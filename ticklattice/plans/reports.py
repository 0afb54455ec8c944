"""Composite queries over lanes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import iso_utc, mid, spread
from ..operators import aggregates as agg
from ..operators import book as books
from ..operators import filters, joins, quality, windows
from ..schemas import DAY, HOUR, MINUTE
from ..streaming.ingest import read_lake


@dataclass(frozen=True)
class MatrixSpec:
    """How a lane fills the grid: columns (source -> name) and fill `bar`, `asof`, `trades`, `liquidations` or `book`."""

    lane: str
    columns: dict[str, str]
    fill: str
    tolerance: int | None = None
    only: tuple[str, str] | None = None


#: The registered lanes of the matrix.
MATRIX = (
    MatrixSpec("klines", {"open": "open", "high": "high", "low": "low", "close": "close", "volume": "volume"}, "bar"),
    MatrixSpec("mark_price_klines", {"close": "mark_close"}, "bar"),
    MatrixSpec("index_price_klines", {"close": "index_close"}, "bar"),
    MatrixSpec("premium_index_klines", {"close": "premium_close"}, "bar"),
    MatrixSpec("trades", {}, "trades"),
    MatrixSpec("liquidations", {}, "liquidations"),
    MatrixSpec("funding_rates", {"funding_rate": "funding_rate"}, "asof", 8 * HOUR),
    MatrixSpec("open_interest", {"open_interest": "open_interest", "oi_value": "oi_value"}, "asof", HOUR),
    MatrixSpec("long_short_ratio", {"long_short_ratio": "long_short_ratio"}, "asof", HOUR, ("ratio_type", "global")),
    MatrixSpec("taker_buy_sell_ratio", {"buy_sell_ratio": "taker_ratio"}, "asof", HOUR),
    MatrixSpec("orderbooks", {"mid": "book_mid", "spread": "book_spread"}, "book", HOUR),
)


def merged_matrix(spark: SparkSession, lanes: dict[str, DataFrame], symbols: list[str], from_ms: int, to_ms: int, step: int = MINUTE, wide: bool = True, specs: tuple[MatrixSpec, ...] = MATRIX, required: bool = True) -> DataFrame:
    """One row per step (and symbol, unless wide) with each lane's columns; wide: columns named `<symbol>_<column>` if there are
    several symbols. Raises ValueError if no cell is filled, where this is required."""
    filters.check_selection(from_ms, to_ms, symbols, list(lanes))
    grid = joins.grid_for(spark, spark.createDataFrame([(s,) for s in symbols], "symbol string"), from_ms, to_ms, step)
    start, names = from_ms - from_ms % step, []
    for spec in specs:
        if spec.lane not in lanes:
            continue
        look_back = spec.tolerance or 0
        rows = lanes[spec.lane].filter(F.col("symbol").isin(symbols))
        rows = filters.time_slice(rows, start - look_back, to_ms)
        if spec.only:
            rows = rows.filter(F.col(spec.only[0]) == spec.only[1])
        if spec.fill == "bar":
            grid = joins.join_bars(grid, rows, spec.columns, step)
        elif spec.fill == "trades":
            grid = grid.join(agg.trade_buckets(rows, step), ["symbol", "timestamp_ms"], "left")
            names += ["trade_count", "trade_vwap"]
        elif spec.fill == "liquidations":
            grid = grid.join(agg.liq_buckets(rows, step), ["symbol", "timestamp_ms"], "left")
            names += ["liq_count", "liq_value"]
        elif spec.fill == "asof":
            grid = joins.asof_join(grid, rows, spec.columns, spec.tolerance).drop("matched_ms")
        else:
            b, a = F.col("best_bid"), F.col("best_ask")
            grid = joins.asof_book(grid, agg.top_of_book(rows), spec.tolerance).withColumns({"book_mid": mid(b, a), "book_spread": spread(b, a)}).drop("best_bid", "best_ask", "matched_ms")
        names += spec.columns.values()
    if required:
        quality.require_rows(grid.filter(F.coalesce(*[F.col(n).cast("string") for n in names]).isNotNull()) if names else grid.limit(0), "no data in the selection")
    if wide:
        if len(symbols) > 1:
            cells = grid.groupBy("timestamp_ms").pivot("symbol", symbols).agg(*[F.first(n).alias(n) for n in names])
        else:
            cells = grid.drop("symbol")
        order = [c for c in cells.columns if c != "timestamp_ms"]
        return cells.select("timestamp_ms", iso_utc(F.col("timestamp_ms")).alias("datetime_utc"), *order)
    return grid.select("symbol", "timestamp_ms", iso_utc(F.col("timestamp_ms")).alias("datetime_utc"), *names)


def lake_books(spark: SparkSession, lake: str, symbols: list[str] | None = None) -> dict[str, DataFrame]:
    """What a lake holds of books: `snaps`, `diffs` and their level `events`, with their directories, so that book_at, book_at_gap,
    replay_at and book_now read only the hours that their snapshots lead to."""
    snaps, updates = read_lake(spark, lake, "depth_snapshot"), read_lake(spark, lake, "depth_updates")
    if symbols:
        snaps, updates = (df.filter(F.col("symbol").isin([s.lower() for s in symbols])) for df in (snaps, updates))
    if "seq" not in updates.columns:
        updates = updates.withColumn("seq", F.col("last_update_id"))
    parts = [c for c in ("date", "hour") if c in updates.columns]
    return {
        "snaps": snaps.select("symbol", "timestamp_ms", "last_update_id", "side", "price", F.col("quantity").alias("qty"), *[c for c in parts if c in snaps.columns]),
        "diffs": updates.select("symbol", "timestamp_ms", F.col("last_update_id").alias("u"), F.col("prev_update_id").alias("pu"), F.col("first_update_id").alias("first_u"), "seq", *parts),
        "events": books.level_events(updates),
    }


def book_now(snaps: DataFrame, events: DataFrame, n: int = 20) -> tuple[DataFrame, DataFrame]:
    """The ladders of the current books, and their tops with middle and spread."""
    book = books.book_at(snaps, events)
    b, a = F.col("best_bid"), F.col("best_ask")
    return windows.ladder(book, n), books.top(book).withColumns({"mid": mid(b, a), "spread": spread(b, a)})


def replay_day(bars: DataFrame, liquidations: DataFrame, snaps: DataFrame, day_ms: int) -> dict[str, DataFrame]:
    """Closes and volumes, liquidations, whether a book can be rebuilt, and the range of each symbol's day."""
    inside = lambda df: filters.time_slice(df, day_ms, day_ms + DAY - 1)
    prices = agg.candles(inside(bars), DAY // MINUTE, cols=("close", "volume"))
    span = prices.groupBy("symbol").agg(F.min("timestamp_ms").alias("from_ms"), (F.max("timestamp_ms") + MINUTE).alias("to_ms"), F.count("*").alias("bars"))
    has = inside(snaps).select("symbol").distinct().withColumn("has_book", F.lit(True))
    return {"prices": prices, "liquidations": inside(liquidations), "days": span.join(has, "symbol", "left").fillna(False, ["has_book"])}


def replay_at(lanes: dict[str, DataFrame], snaps: DataFrame, events: DataFrame, diffs: DataFrame, t: int, n: int = 20, tape: int = 40) -> dict[str, DataFrame]:
    """The state at t of every symbol: ladder, book gap, tape, last close, funding, open interest and ratio, and recent liquidations.
    Raises ValueError if no snapshot is old enough."""
    quality.require_rows(books.anchor(snaps, t), "no snapshot at or before that instant")
    book = books.book_at(snaps, events, t)
    point = {
        "close": joins.asof_point(lanes["klines"], t, ["close"]),
        "funding": joins.asof_point(lanes["funding_rates"], t, ["funding_rate", "next_funding_time"]),
        "open_interest": joins.asof_point(lanes["open_interest"], t, ["open_interest", "oi_value"]),
        "ratio": joins.asof_ratio(lanes["long_short_ratio"], t, ["long_short_ratio"]),
    }
    return {
        "ladder": windows.ladder(book, n), "top": books.top(book), "gap": books.book_at_gap(snaps, diffs, t), "tape": windows.tape_before(lanes["trades"], t, tape),
        "liquidations": filters.events_near(lanes["liquidations"], t), **point,
    }


def symbol_detail(lanes: dict[str, DataFrame], n_candles: int = 180, n_trades: int = 60) -> dict[str, DataFrame]:
    """Candles with their change, the last trades, and the latest funding, open interest and ratios of every symbol."""
    bars = agg.candles(lanes["klines"], n_candles)
    return {
        "candles": bars, "change": agg.price_change(bars), "trades": windows.tail(filters.parsed(lanes["trades"], ["price", "quantity"]), n_trades),
        "funding": windows.latest(lanes["funding_rates"], ["symbol"], ["funding_rate", "next_funding_time", "timestamp_ms"]),
        "open_interest": windows.latest(lanes["open_interest"], ["symbol"], ["open_interest", "oi_value", "timestamp_ms"]),
        "ratios": windows.latest(lanes["long_short_ratio"], ["symbol", "ratio_type"], ["long_ratio", "short_ratio", "long_short_ratio", "timestamp_ms"]),
    }


def validate(lanes: dict[str, DataFrame], snaps: DataFrame | None = None, events: DataFrame | None = None, diffs: DataFrame | None = None, step: int = MINUTE) -> dict[str, DataFrame]:
    """Checks, lane reports, book verdicts and verdicts of all symbols and days."""
    checks, reports = None, None
    for lane, df in lanes.items():
        found = quality.run_checks(df, lane, step)
        part = quality.lane_reports(df, found)
        checks = found if checks is None else checks.unionByName(found)
        reports = part if reports is None else reports.unionByName(part)
    out = {"checks": checks, "reports": reports}
    if snaps is not None:
        seeded = books.seed(snaps)
        out["books"] = quality.book_verdict(books.continuity(diffs), books.rebuild_day(seeded, events), books.seed_crossed(seeded), books.midnight_handoff(diffs))
    return out | {"verdicts": quality.verdicts(reports, out.get("books"))}


def verify_tree(lines: dict[str, DataFrame], headers: dict[str, list[str]], bars: dict[str, DataFrame], step: int = MINUTE) -> dict[str, DataFrame]:
    """Issues of raw files by datatype (the first 100), and gap events of minute series."""
    issues = None
    for lane, df in lines.items():
        part = quality.file_issues(df, headers[lane]).withColumn("lane", F.lit(lane))
        issues = part if issues is None else issues.unionByName(part)
    gaps = {f"gaps_{lane}": quality.gap_events(df, step) for lane, df in bars.items()}
    return {"issues": quality.issue_list(issues), "count": issues.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")), **gaps}


def coverage(rows: DataFrame, gaps: DataFrame, now: int) -> dict[str, DataFrame]:
    """Totals, days present, the calendar and the symbols that are most behind."""
    days = rows.select("lane", "symbol", agg.day().alias("day_ms")).distinct()
    return {"totals": agg.coverage_totals(rows, gaps), "days": agg.days_present(rows), "calendar": agg.coverage_calendar(days), "stalest": agg.stalest(agg.last_seen(rows), now)}


def gap_log(events: DataFrame, n: int = 200) -> DataFrame:
    return filters.keep_last(events, ["symbol"], n, ["timestamp"])


def log_view(lines: DataFrame, n: int = 5000, level: str = "INFO") -> DataFrame:
    """The last n lines of each file, then those of at least a level."""
    return windows.filter_logs(filters.keep_last(lines, ["file_name"], min(n, 5000), ["seq"]), level, ("file_name",))


def soak_report(samples: DataFrame, diffs: DataFrame, trades: DataFrame) -> dict[str, DataFrame]:
    return {"days": agg.soak_daily(samples), "handoffs": books.midnight_handoff(diffs), "trade_gaps": books.midnight_trade_gap(trades)}


def request_audit(requests: DataFrame, window_ms: int = MINUTE, budget: int = 2400) -> dict[str, DataFrame]:
    return {"success": agg.request_success(requests), "budget": windows.rolling_budget(requests, window_ms, budget)}
