"""Grids and as-of joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import bucket
from ..schemas import DAY, HOUR, MINUTE
from .scans import carried


def minute_grid(spark: SparkSession, from_ms: int, to_ms: int, step: int = MINUTE) -> DataFrame:
    """(timestamp_ms) of every step from the one that holds from_ms to to_ms."""
    start = from_ms - from_ms % step
    return spark.range(start, to_ms + 1, step).select(F.col("id").alias("timestamp_ms"))


def grid_for(spark: SparkSession, symbols: DataFrame, from_ms: int, to_ms: int, step: int = MINUTE) -> DataFrame:
    """The grid for each of the symbols (a sequence per symbol, so that no join is needed)."""
    start = from_ms - from_ms % step
    every = F.sequence(F.lit(start).cast("bigint"), F.lit(to_ms).cast("bigint"), F.lit(step).cast("bigint"))
    return symbols.select("symbol").distinct().select("symbol", F.explode(every).alias("timestamp_ms"))


def join_bars(grid: DataFrame, bars: DataFrame, cols: dict[str, str], step: int = MINUTE, order: str = "seq") -> DataFrame:
    """Adds bar columns (source -> name); the last row of a bar wins."""
    last = bars.groupBy("symbol", bucket(F.col("timestamp_ms"), step).alias("timestamp_ms")).agg(*[F.max_by(c, order).alias(n) for c, n in cols.items()])
    return grid.join(last, ["symbol", "timestamp_ms"], "left")


def asof_join(left: DataFrame, right: DataFrame, cols: dict[str, str], tolerance: int | None = None, ties: str = "last", by: tuple[str, ...] = ("symbol",), ts: str = "timestamp_ms", order: str = "seq", width: int = DAY) -> DataFrame:
    """Adds to each left row the columns of the last right row at or before it, at most `tolerance` ms older.

    Both sides are shuffled once by key and stretch of time, and sorted; the last value is carried forward. A stretch is as
    long as the tolerance, and a right row is also given to the next stretch, so the work of a hot key is spread over time.
    Without a tolerance stretches are of `width` ms, and the last right row of those before is carried on. Of right rows with one time, the first or last in `order` counts.
    """
    names = list(cols.values())
    value = F.struct(F.col(ts).alias("_at"), *[F.col(c).alias(n) for c, n in cols.items()])
    rights = right.select(*by, F.col(ts), F.lit(0).alias("_side"), (F.col(order) if ties == "last" else -F.col(order)).cast("bigint").alias("_order"), value.alias("_value"))
    lefts = left.withColumn("_row", F.struct(*left.columns)).select(*by, F.col(ts), F.lit(1).alias("_side"), F.lit(0).cast("bigint").alias("_order"), "_row")
    keys = list(by)
    if tolerance:
        own = F.floor(F.col(ts) / tolerance)
        rights = rights.withColumn("_part", F.explode(F.array(own, own + 1)))
        lefts = lefts.withColumn("_part", own)
        keys.append("_part")
    both = lefts.unionByName(rights, allowMissingColumns=True)
    if tolerance:
        so_far = Window.partitionBy(*keys).orderBy(ts, "_side", "_order").rowsBetween(Window.unboundedPreceding, 0)
        met = both.withColumn("_value", F.last("_value", ignorenulls=True).over(so_far)).filter("_side = 1")
    else:
        met = carried(both, keys, ts, [ts, "_side", "_order"], width, _last=(F.col("_value"), "last")).filter("_side = 1").drop("_value").withColumnRenamed("_last", "_value")
    fresh = F.lit(True) if tolerance is None else F.col(ts) - F.col("_value._at") <= tolerance
    return met.select("_row.*", *[F.when(fresh, F.col(f"_value.{n}")).alias(n) for n in names], F.when(fresh, F.col("_value._at")).alias("matched_ms"))


def asof_book(grid: DataFrame, tops: DataFrame, tolerance: int = HOUR) -> DataFrame:
    """Top of book carried onto the grid; a one-sided snapshot blanks the cell."""
    got = asof_join(grid, tops, {"best_bid": "best_bid", "best_ask": "best_ask"}, tolerance, order="timestamp_ms")
    whole = F.col("best_bid").isNotNull() & F.col("best_ask").isNotNull()
    return got.withColumns({c: F.when(whole, F.col(c)) for c in ("best_bid", "best_ask")})


def _recent(df: DataFrame, t: int | Column, ts: str) -> Column:
    at = F.lit(t).cast("bigint") if isinstance(t, int) else t
    return (F.col(ts) <= at) & (F.col(ts) >= at - F.pmod(at, F.lit(DAY)) - DAY)


def asof_point(df: DataFrame, t: int, cols: list[str], order: str = "seq") -> DataFrame:
    """Per symbol, the last row at or before t, of t's day or the day before; of equal times the first in order."""
    return df.filter(_recent(df, t, "timestamp_ms")).groupBy("symbol").agg(
        *[F.max_by(c, F.struct("timestamp_ms", -F.col(order))).alias(c) for c in cols], F.max("timestamp_ms").alias("timestamp_ms")
    )


def asof_ratio(df: DataFrame, t: int, cols: list[str], kind: str = "global", order: str = "seq") -> DataFrame:
    """As asof_point, of one ratio type, by place in the files instead of time: the later day, then the last row."""
    near = df.filter((F.col("ratio_type") == kind) & _recent(df, t, "timestamp_ms"))
    place = F.struct(F.floor(F.col("timestamp_ms") / DAY), F.col(order))
    return near.groupBy("symbol").agg(*[F.max_by(c, place).alias(c) for c in (*cols, "timestamp_ms")])


def quiet_symbols(seen: DataFrame, fresh: DataFrame, book: DataFrame) -> DataFrame:
    """Symbols that are not fresh in a lane although their book is."""
    return seen.select("symbol").distinct().join(fresh.select("symbol"), "symbol", "left_anti").join(book.select("symbol"), "symbol", "left_semi")
