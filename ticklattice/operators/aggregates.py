"""Grouped summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bucket, num
from ..schemas import DAY, MINUTE
from .joins import quiet_symbols


def exact_sum(x: Column) -> Column:
    """A sum that doesn't depend on the order of rows: over decimals of eight places."""
    return F.sum(x.cast("decimal(28,8)")).cast("double")


def trade_buckets(trades: DataFrame, step: int = MINUTE) -> DataFrame:
    """Count and volume-weighted price; NULL price where the volume is 0."""
    return trades.groupBy("symbol", bucket(F.col("timestamp_ms"), step).alias("timestamp_ms")).agg(
        F.count("*").alias("trade_count"), (exact_sum(F.col("price") * F.col("quantity")) / F.nullif(exact_sum(F.col("quantity")), F.lit(0.0))).alias("trade_vwap")
    )


def liq_buckets(liquidations: DataFrame, step: int = MINUTE) -> DataFrame:
    """Count and value; a value that doesn't parse counts as 0."""
    return liquidations.groupBy("symbol", bucket(F.col("timestamp_ms"), step).alias("timestamp_ms")).agg(
        F.count("*").alias("liq_count"), exact_sum(F.coalesce(num(F.col("value")), F.lit(0.0))).alias("liq_value")
    )


BAR = ("open", "high", "low", "close", "volume")


def candles(bars: DataFrame, n: int = 180, order: str = "seq", cols: tuple[str, ...] = BAR) -> DataFrame:
    """The last row of each bar, of the latest n bars of each symbol."""
    last = bars.groupBy("symbol", "timestamp_ms").agg(*[F.max_by(c, order).alias(c) for c in cols])
    place = Window.partitionBy("symbol").orderBy(F.desc("timestamp_ms"))
    return last.withColumn("_n", F.row_number().over(place)).filter(F.col("_n") <= n).drop("_n")


def top_of_book(snaps: DataFrame) -> DataFrame:
    """Best bid and ask of each snapshot instant, with middle and spread."""
    best = snaps.groupBy("symbol", "timestamp_ms").agg(
        F.max(F.when(F.col("side") == "bid", F.col("price"))).alias("best_bid"), F.min(F.when(F.col("side") == "ask", F.col("price"))).alias("best_ask")
    )
    return best.withColumns({"mid": (F.col("best_bid") + F.col("best_ask")) / 2, "spread": F.col("best_ask") - F.col("best_bid")})


def price_change(bars: DataFrame) -> DataFrame:
    """Change from the first to the last close in percent, and the span in ms."""
    ends = bars.groupBy("symbol").agg(
        F.min_by("close", "timestamp_ms").alias("first_close"), F.max_by("close", "timestamp_ms").alias("last_close"), (F.max("timestamp_ms") - F.min("timestamp_ms")).alias("span_ms")
    )
    return ends.withColumn("change_pct", (F.col("last_close") - F.col("first_close")) / F.nullif(F.col("first_close"), F.lit(0.0)) * 100)


def lane_rows(lanes: dict[str, DataFrame], *extra: str) -> DataFrame:
    """(lane, symbol, timestamp_ms, extra) of all lanes."""
    out = None
    for name, df in lanes.items():
        part = df.select(F.lit(name).alias("lane"), "symbol", "timestamp_ms", *extra)
        out = part if out is None else out.unionByName(part)
    return out


def day(ts: str = "timestamp_ms") -> Column:
    return F.col(ts) - F.pmod(F.col(ts), F.lit(DAY))


def days_present(rows: DataFrame, n: int = 14) -> DataFrame:
    """(lane, symbol, day_ms) of the latest n days of each lane and symbol."""
    days = rows.select("lane", "symbol", day().alias("day_ms")).distinct()
    place = Window.partitionBy("lane", "symbol").orderBy(F.desc("day_ms"))
    return days.withColumn("_n", F.row_number().over(place)).filter(F.col("_n") <= n).drop("_n")


def dates(rows: DataFrame) -> DataFrame:
    """(symbol, day_ms): days on which any lane has rows."""
    return rows.select("symbol", day().alias("day_ms")).distinct()


def coverage_calendar(days: DataFrame, n: int = 14) -> DataFrame:
    """Of each lane, every day from the latest back to the earliest, at most n, with the number of symbols (0 on empty days)."""
    counts = days.groupBy("lane", "day_ms").agg(F.countDistinct("symbol").alias("symbols"))
    ends = counts.groupBy("lane").agg(F.min("day_ms").alias("a"), F.max("day_ms").alias("b"))
    every = ends.select("lane", F.explode(F.sequence(F.greatest("a", F.col("b") - (n - 1) * DAY), "b", F.lit(DAY).cast("bigint"))).alias("day_ms"))
    return every.join(counts, ["lane", "day_ms"], "left").fillna(0, ["symbols"])


def coverage_totals(rows: DataFrame, gaps: DataFrame, file: str = "file_name") -> DataFrame:
    """Per lane and over all (lane NULL): symbols and files; gap events over all."""
    per = rows.groupBy("lane").agg(F.countDistinct("symbol").alias("symbols"), F.countDistinct(file).alias("files"))
    total = rows.agg(F.countDistinct("symbol").alias("symbols"), F.countDistinct("lane", file).alias("files"))
    count = gaps.agg(F.count("*").alias("gaps"))
    return per.select("lane", "symbols", "files", F.lit(None).cast("bigint").alias("gaps")).unionByName(total.crossJoin(F.broadcast(count)).select(F.lit(None).cast("string").alias("lane"), "symbols", "files", "gaps"))


def symbol_directory(rows: DataFrame, now: int, live_ms: int = 120_000, bar_lane: str = "klines") -> DataFrame:
    """Lanes that a symbol has, whether it is live, and the age of its last bar."""
    per = rows.groupBy("symbol").agg(
        F.array_join(F.sort_array(F.collect_set("lane")), ",").alias("lanes"), F.max("timestamp_ms").alias("last_ms"), F.max(F.when(F.col("lane") == bar_lane, F.col("timestamp_ms"))).alias("bar_ms")
    )
    return per.select("symbol", "lanes", (now - F.col("last_ms") < live_ms).alias("active"), (now - F.col("bar_ms")).alias("bar_age_ms"))


def last_seen(rows: DataFrame) -> DataFrame:
    """(lane, symbol, last_ms)."""
    return rows.groupBy("lane", "symbol").agg(F.max("timestamp_ms").alias("last_ms"))


def lane_freshness(seen: DataFrame, now: int, windows: dict[str, int]) -> DataFrame:
    """Per lane: symbols, fresh ones (younger than the lane's window), newest age and whether the lane is active."""
    window = F.element_at(F.create_map(*[F.lit(x) for lane, w in windows.items() for x in (lane, w)]), F.col("lane"))
    age = now - F.col("last_ms")
    return seen.groupBy("lane").agg(
        F.count("*").alias("symbols"), F.count_if(age < window).alias("fresh"), F.min(age).alias("newest_age_ms"), (F.count_if(age < window) > 0).alias("active")
    )


def quiet_stale(seen: DataFrame, now: int, windows: dict[str, int], book_lane: str, event_lanes: list[str]) -> DataFrame:
    """Per event-driven lane: symbols that are behind, split by whether their book is fresh (quiet) or not (stale)."""
    fresh_book = seen.filter((F.col("lane") == book_lane) & (now - F.col("last_ms") < windows[book_lane]))
    out = None
    for lane in event_lanes:
        own = seen.filter(F.col("lane") == lane)
        fresh = own.filter(now - F.col("last_ms") < windows[lane])
        behind = own.join(fresh.select("symbol"), "symbol", "left_anti").agg(F.count("*").alias("behind"))
        quiet = quiet_symbols(own, fresh, fresh_book).agg(F.count("*").alias("quiet"))
        part = behind.crossJoin(F.broadcast(quiet)).select(F.lit(lane).alias("lane"), "quiet", (F.col("behind") - F.col("quiet")).alias("stale"))
        out = part if out is None else out.unionByName(part)
    return out


def stalest(seen: DataFrame, now: int, low_ms: int = 90_000, high_ms: int = 21_600_000, n: int = 12) -> DataFrame:
    """Symbols whose newest row is of an age in [low, high), oldest first, n at most."""
    ages = seen.groupBy("symbol").agg((now - F.max("last_ms")).alias("age_ms")).filter(F.col("age_ms").between(low_ms, high_ms - 1))
    return ages.orderBy(F.desc("age_ms"), "symbol").limit(n)


def lane_health(fresh: DataFrame, quiet: DataFrame) -> DataFrame:
    """Healthy (live or quiet) symbols of each lane, in percent, and whether the lane is connected."""
    met = fresh.join(quiet.select("lane", "quiet"), "lane", "left").withColumn("healthy", F.col("fresh") + F.coalesce("quiet", F.lit(0)))
    return met.select("lane", "symbols", "healthy", (F.col("healthy") * 100.0 / F.nullif(F.col("symbols"), F.lit(0))).alias("healthy_pct"), (F.col("fresh") > 0).alias("connected"))


def message_totals(messages: DataFrame) -> DataFrame:
    return messages.groupBy("event_type").agg(F.count("*").alias("messages"))


def book_census(book: DataFrame) -> DataFrame:
    """Levels by side and last update id of each symbol's book; live: both sides are there."""
    per = book.groupBy("symbol").agg(F.count_if(F.col("side") == "bid").alias("bids"), F.count_if(F.col("side") == "ask").alias("asks"), F.max("u").alias("last_update_id"))
    return per.withColumn("live", (F.col("bids") > 0) & (F.col("asks") > 0))


def tape_span(diffs: DataFrame) -> DataFrame:
    """Captured span of each symbol's day, its share of the day in percent (100 at most), and whether that is over 95."""
    per = diffs.groupBy("symbol", day().alias("day_ms")).agg(F.min("timestamp_ms").alias("first_ms"), F.max("timestamp_ms").alias("last_ms"))
    pct = F.least(F.lit(100.0), (F.col("last_ms") - F.col("first_ms")) * 100.0 / DAY)
    return per.withColumn("pct", pct).withColumn("full", F.col("pct") > 95)


def soak_daily(samples: DataFrame) -> DataFrame:
    """Per UTC day: least and most memory, slope in MB an hour from 06 to 23 h, and reconnects."""
    hour = F.pmod(F.col("timestamp_ms"), F.lit(DAY)) / 3_600_000
    inside = (hour >= 6) & (hour < 23)
    return samples.groupBy(day().alias("day_ms")).agg(
        F.min("rss_mb").alias("floor_mb"), F.max("rss_mb").alias("peak_mb"),
        F.regr_slope(F.when(inside, F.col("rss_mb")), F.when(inside, hour)).alias("slope_mb_h"), (F.max("reconnects") - F.min("reconnects")).alias("reconnects"),
    )


def request_success(requests: DataFrame) -> DataFrame:
    return requests.groupBy("route", "endpoint").agg(F.count("*").alias("requests"), F.count_if("success").alias("succeeded"), (F.count_if("success") * 100.0 / F.count("*")).alias("success_pct"))


def file_census(rows: DataFrame, file: str = "file_name") -> DataFrame:
    return rows.groupBy("lane").agg(F.countDistinct(file).alias("files"), F.count("*").alias("rows"))


def missing_categories(rows: DataFrame, col: str, expected: tuple[str, ...]) -> DataFrame:
    """Per symbol, expected values that never occur."""
    found = rows.groupBy("symbol").agg(F.collect_set(F.when(F.col(col).isin(*expected), F.col(col))).alias("found"))
    gone = F.array_except(F.array(*[F.lit(x) for x in expected]), "found")
    return found.select("symbol", F.array_join(F.sort_array(gone), ",").alias("missing"), F.size(gone).cast("bigint").alias("n_missing"))
