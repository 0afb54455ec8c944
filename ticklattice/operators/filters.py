"""Filters, semi and anti joins (lookup sides stay plain joins: Spark broadcasts them where its size estimate allows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import base_asset, day_of, num
from ..schemas import DAY, HOUR, LANES

MAX_RANGE_MS, MAX_SYMBOLS = 31 * DAY, 50


def time_slice(df: DataFrame, from_ms: int, to_ms: int, ts: str = "timestamp_ms") -> DataFrame:
    """Rows in [from_ms, to_ms]; with `date` or `hour` partition columns, these are pruned too."""
    out = df.filter(F.col(ts).between(from_ms, to_ms))
    if "date" in df.columns:
        low, high = (day_of(F.lit(x).cast("bigint")) for x in (from_ms, to_ms))
        out = out.filter(F.col("date").cast("date").between(low, high))
        if "hour" in df.columns and from_ms // DAY == to_ms // DAY:
            out = out.filter(F.col("hour").between(from_ms % DAY // HOUR, to_ms % DAY // HOUR))
    return out


def check_selection(from_ms: int, to_ms: int, symbols: list[str], lanes: list[str]) -> None:
    """Raises ValueError for a selection that no export takes."""
    if from_ms > to_ms:
        raise ValueError("the range ends before it starts")
    if to_ms - from_ms > MAX_RANGE_MS:
        raise ValueError("the range is longer than 31 days")
    if not symbols or len(symbols) > MAX_SYMBOLS:
        raise ValueError(f"name 1 to {MAX_SYMBOLS} symbols")
    if not lanes or set(lanes) - {*LANES, "orderbooks"}:
        raise ValueError("name known lanes")


def closed_only(bars: DataFrame) -> DataFrame:
    return bars.filter("is_closed")


def drop_open_bucket(df: DataFrame, poll: list[str], ts: str = "timestamp_ms") -> DataFrame:
    """Without the last bucket of each poll, which is still open."""
    last = df.groupBy(*poll).agg(F.max(ts).alias("_last"))
    return df.join(last, poll).filter(F.col(ts) < F.col("_last")).drop("_last")


def in_universe(df: DataFrame, universe: DataFrame) -> DataFrame:
    return df.join(universe.select("symbol"), "symbol", "left_semi")


def drop_delisted(df: DataFrame, delisted: DataFrame) -> DataFrame:
    return df.join(delisted.select("symbol"), "symbol", "left_anti")


def in_universe_not_delisted(df: DataFrame, universe: DataFrame, delisted: DataFrame) -> DataFrame:
    return drop_delisted(in_universe(df, universe), delisted)


def drop_unpersisted(df: DataFrame, names: DataFrame) -> DataFrame:
    """Without symbols whose raw rows are not kept."""
    return df.join(names.select(F.lower("symbol").alias("symbol")), "symbol", "left_anti")


def tradable(contracts: DataFrame) -> DataFrame:
    live = (F.col("status") == "TRADING") & (F.col("contract_type") == "PERPETUAL") & (F.col("quote_asset") == "USDT")
    return contracts.filter(live & ~F.col("underlying_type").eqNullSafe("PREMARKET"))


def apply_exclusions(universe: DataFrame, stable: DataFrame, large: DataFrame, exceptions: DataFrame, symbols: DataFrame) -> DataFrame:
    """Without base assets in stable or (large but not exceptions), and without excluded symbols. Lists: (name)."""
    upper = lambda df: df.select(F.upper("name").alias("name"))
    bases = upper(stable).unionByName(upper(large).join(upper(exceptions), "name", "left_anti")).distinct()
    kept = universe.withColumn("_base", F.upper(base_asset(F.col("base_asset")))).join(bases, F.col("_base") == F.col("name"), "left_anti").drop("_base")
    return kept.withColumn("_symbol", F.upper("symbol")).join(upper(symbols), F.col("_symbol") == F.col("name"), "left_anti").drop("_symbol")


def with_anchors(universe: DataFrame, contracts: DataFrame, anchors: DataFrame) -> DataFrame:
    """Adds anchor symbols that still trade."""
    found = contracts.filter(F.col("status") == "TRADING").join(anchors.select(F.upper("name").alias("symbol")), "symbol", "left_semi")
    return universe.select("symbol").unionByName(found.select("symbol")).distinct()


def select_universe(whitelist: list[str] | None, discovered: DataFrame) -> DataFrame:
    """The whitelist, if there is one, else what was discovered; lower-cased."""
    if whitelist:
        return discovered.sparkSession.createDataFrame([(s.lower(),) for s in whitelist], "symbol string").distinct()
    return discovered.select(F.lower("symbol").alias("symbol")).distinct()


def universe_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(symbol, change): `added` or `removed`."""
    both = old.select("symbol", F.lit(1).alias("o"), F.lit(0).alias("n")).unionByName(new.select("symbol", F.lit(0).alias("o"), F.lit(1).alias("n")))
    met = both.groupBy("symbol").agg(F.max("o").alias("o"), F.max("n").alias("n")).filter("o <> n")
    return met.select("symbol", F.when(F.col("n") == 1, "added").otherwise("removed").alias("change"))


def parsed(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows whose named columns are numbers, which they become."""
    return df.withColumns({c: num(F.col(c)) for c in cols}).dropna(subset=cols)


def events_near(df: DataFrame, t: int, span_ms: int = 3000, ts: str = "timestamp_ms") -> DataFrame:
    """Rows in (t - span, t]."""
    return df.filter((F.col(ts) > t - span_ms) & (F.col(ts) <= t))


def ratio(df: DataFrame, kind: str = "global") -> DataFrame:
    return df.filter(F.col("ratio_type") == kind)


def sort_for_write(diffs: DataFrame) -> DataFrame:
    """Diffs of an hour in update-id order inside each file; a symbol's hours spread over tasks."""
    return diffs.repartition("symbol", "date", "hour").sortWithinPartitions("symbol", "date", "hour", "last_update_id")


def keep_last(df: DataFrame, by: list[str], n: int, order: list[str]) -> DataFrame:
    """The last n rows of each key; Spark drops the rest before the shuffle."""
    place = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_n", F.row_number().over(place)).filter(F.col("_n") <= n).drop("_n")


def append_gap_events(old: DataFrame, new: DataFrame, keep: int = 512, order: tuple[str, ...] = ("timestamp", "seq")) -> DataFrame:
    """The gap log with new events, the last `keep` of each symbol."""
    return keep_last(old.unionByName(new, allowMissingColumns=True), ["symbol"], keep, list(order))


def union_lanes(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames under the first one's columns."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out.select(frames[0].columns)
