"""Window operators in tape order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import num
from ..schemas import DAY
from .scans import carried


def previous(df: DataFrame, col: str, by: list[str], order: list[str], name: str = "previous") -> DataFrame:
    """The value of the row before, in tape order."""
    return df.withColumn(name, F.lag(col).over(Window.partitionBy(*by).orderBy(*order)))


#: Values of an order column that make a stretch: windows over a whole tape run by stretches, of which only the ends are joined.
STRETCH = 1 << 20


def previous_in_tape(df: DataFrame, col: str, by: list[str], order: str, name: str = "previous", width: int = STRETCH) -> DataFrame:
    """The value of the row before in its key's order, a whole number; rows of one key and long tapes are spread over tasks."""
    stretch = F.floor(F.col(order) / width)
    near = Window.partitionBy(*by, "_stretch").orderBy(order)
    rows = df.withColumn("_stretch", stretch).withColumns({"_n": F.row_number().over(near), "_near": F.lag(col).over(near)})
    ends = df.groupBy(*by, stretch.alias("_stretch")).agg(F.max_by(F.struct(F.col(col)), order).alias("_end"))
    far = ends.select(*by, "_stretch", F.lag("_end").over(Window.partitionBy(*by).orderBy("_stretch"))[col].alias("_far"))
    return rows.join(far, [*by, "_stretch"], "left").withColumn(name, F.when(F.col("_n") > 1, F.col("_near")).otherwise(F.col("_far"))).drop("_stretch", "_n", "_near", "_far")


def bar_steps(bars: DataFrame, width: int = DAY) -> DataFrame:
    """(symbol, timestamp_ms, step_ms) of distinct bars: the step to the next one."""
    once = bars.select("symbol", "timestamp_ms").distinct().withColumn("_back", -F.col("timestamp_ms"))
    found = carried(once, ["symbol"], "_back", ["_back"], width, _next=(F.col("timestamp_ms"), "last"))
    return found.select("symbol", "timestamp_ms", (F.col("_next") - F.col("timestamp_ms")).alias("step_ms"))


def repeats(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Rows that repeat an earlier one's key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("_n > 1").drop("_n")


def signed_price(side: str = "side", price: str = "price") -> Column:
    """Sorts bids from high to low and asks from low to high."""
    return F.when(F.col(side) == "bid", -F.col(price)).otherwise(F.col(price))


def ladder(book: DataFrame, n: int = 20) -> DataFrame:
    """The best n (1..200) levels of each side with their place and running size."""
    if not 1 <= n <= 200:
        raise ValueError("1 to 200 levels")
    best = Window.partitionBy("symbol", "side").orderBy(signed_price())
    placed = book.withColumn("level", F.row_number().over(best).cast("bigint")).filter(F.col("level") <= n)
    return placed.withColumn("cumulative", F.sum("qty").over(Window.partitionBy("symbol", "side").orderBy("level").rowsBetween(Window.unboundedPreceding, 0)))


def tail(df: DataFrame, n: int, order: tuple[str, ...] = ("timestamp_ms", "seq")) -> DataFrame:
    """The last n rows of each symbol, with their place from the newest."""
    place = Window.partitionBy("symbol").orderBy(*[F.desc(c) for c in order])
    return df.withColumn("place", F.row_number().over(place).cast("bigint")).filter(F.col("place") <= n)


def latest(df: DataFrame, by: list[str], cols: list[str], order: str = "seq") -> DataFrame:
    """The last row of each key, by place in the tape."""
    return df.groupBy(*by).agg(*[F.max_by(c, order).alias(c) for c in cols])


def tape_before(trades: DataFrame, t: int, n: int) -> DataFrame:
    """The last n trades of each symbol at or before t, of the last day, newest first."""
    return tail(trades.filter((F.col("timestamp_ms") <= t) & (F.col("timestamp_ms") > t - DAY)), n)


def counter_rate(df: DataFrame, counter: str, by: list[str], ts: str = "timestamp_ms", width: int = DAY) -> DataFrame:
    """Rate per second since the sample before; NULL until a count that isn't 0 came before. A reset counter counts as 0. Of samples
    of one time the lower count comes first."""
    found = carried(df, by, ts, [ts, counter], width, _before=(F.struct(F.col(counter).alias("n"), F.col(ts).alias("at")), "last"))
    before, then = F.col("_before.n"), F.col("_before.at")
    rate = F.greatest(F.col(counter) - before, F.lit(0)) * 1000.0 / F.nullif(F.col(ts) - then, F.lit(0))
    return found.withColumn("rate", F.when(before > 0, rate)).drop("_before")


def ema(df: DataFrame, col: str, by: list[str], alpha: float = 0.05, order: str = "seq", width: int = 1 << 14) -> DataFrame:
    """Exponential moving average of each key; the first sample seeds it.

    Stretches of `width` values of the order are folded by themselves: each is a number of samples and their decayed sum (the first
    one the average itself), and only these meet, in order.
    """
    keep = 1 - alpha
    stretch = F.floor(F.col(order) / width)
    parts = df.filter(F.col(col).isNotNull()).groupBy(*by, stretch.alias("_s")).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(col).cast("double").alias("x")))).alias("v"))
    fold = lambda v, start: F.aggregate(v, start, lambda a, p: a * keep + p["x"] * alpha)
    x0 = F.col("v")[0]["x"]
    ends = parts.select(*by, "_s", F.size("v").alias("n"), fold(F.col("v"), F.lit(0.0)).alias("d"), fold(F.slice("v", F.lit(2), F.size("v")), x0).alias("e"))
    pieces = ends.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_s", "n", "d", "e"))).alias("p"), F.sum("n").cast("bigint").alias("samples"))
    later = F.slice("p", F.lit(2), F.size("p"))
    return pieces.select(*by, F.aggregate(later, F.col("p")[0]["e"], lambda a, p: a * F.pow(F.lit(keep), p["n"]) + p["d"]).alias("ema"), "samples")


def rolling_budget(requests: DataFrame, window_ms: int, budget: int, by: tuple[str, ...] = (), ts: str = "timestamp_ms") -> DataFrame:
    """Weight spent in the last window_ms, this request's included, and whether it is over the budget.

    Rows are dealt by stretches of window_ms (a row counts in its own and the next one's), so one account's requests are no
    single task's.
    """
    own = F.floor(F.col(ts) / window_ms)
    rows = requests.withColumn("_row", F.struct(*requests.columns)).select(*by, ts, "weight", "_row", own.alias("_own"), F.explode(F.array(own, own + 1)).alias("_part"))
    spent = F.sum("weight").over(Window.partitionBy(*by, "_part").orderBy(ts).rangeBetween(-window_ms, 0))
    return rows.withColumn("spent", spent).filter("_part = _own").select("_row.*", "spent", (F.col("spent") > budget).alias("over_budget"))


#: Log levels by rank.
LEVELS = {"TRACE": 0, "DEBUG": 0, "INFO": 1, "WARN": 2, "ERROR": 3}


def filter_logs(lines: DataFrame, level: str = "INFO", by: tuple[str, ...] = ("file_name",), width: int = STRETCH) -> DataFrame:
    """Lines of at least a level; a line without one has that of the line before. Levels are carried inside stretches of the order,
    and from the last stretch before that names one."""
    rank = F.lit(None).cast("int")
    for name, r in LEVELS.items():
        rank = F.when(F.col("level") == name, r).otherwise(rank)
    rows = lines.withColumns({"_rank": rank, "_stretch": F.floor(F.col("seq") / width)})
    inside = F.last("_rank", ignorenulls=True).over(Window.partitionBy(*by, "_stretch").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0))
    ends = rows.groupBy(*by, "_stretch").agg(F.max_by("_rank", F.when(F.col("_rank").isNotNull(), F.col("seq"))).alias("_end"))
    before = F.last("_end", ignorenulls=True).over(Window.partitionBy(*by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1))
    carried = rows.withColumn("_inside", inside).join(ends.select(*by, "_stretch", before.alias("_before")), [*by, "_stretch"], "left")
    found = carried.withColumn("rank", F.coalesce("_inside", "_before", F.lit(1))).filter(F.col("rank") >= LEVELS[level])
    return found.select(*lines.columns, "rank")


def new_buckets(df: DataFrame, key: list[str], order: str = "seq", ts: str = "timestamp_ms", width: int = STRETCH) -> DataFrame:
    """Rows whose bucket is later than any bucket of their key that came before them."""
    found = carried(df, key, order, [order], width, _mark=(F.col(ts), "max"))
    return found.filter(F.col("_mark").isNull() | (F.col(ts) > F.col("_mark"))).drop("_mark")


def lifecycle(presence: DataFrame, strikes: int = 2, width: int = 1 << 14) -> DataFrame:
    """(symbol, cycle, change) from (symbol, cycle, present): `added` as soon as present, `removed` at the second absence in a
    row; one absence is forgiven. Rows before a symbol's first presence are ignored."""
    gone = presence.withColumn("_gone", F.when(F.col("present"), 0).otherwise(1))
    one = carried(gone, ["symbol"], "cycle", ["cycle"], width, _b1=(F.col("_gone"), "last"), _seen=(1 - F.col("_gone"), "max"))
    rows = carried(one, ["symbol"], "cycle", ["cycle"], width, _held=(F.struct(F.col("_b1").alias("b")), "last"))
    b1, b2, ever = F.col("_b1"), F.col("_held.b"), F.coalesce("_seen", F.lit(0))
    removed = (F.col("_gone") == 1) & (b1 == 1) & (F.coalesce(b2, F.lit(1)) == 0) & (ever == 1)
    added = (F.col("_gone") == 0) & ((ever == 0) | ((b1 == 1) & (b2 == 1)))
    return rows.withColumn("change", F.when(removed, "removed").when(added, "added")).filter("change is not null").select("symbol", "cycle", "change")


def accepted_cycles(cycles: DataFrame, most_lost: float = 0.1) -> DataFrame:
    """(cycle, found, accepted) of discoveries; one that finds under 1 - most_lost of what is tracked is skipped. What is tracked
    is the last accepted count, a fold over the (few) cycles."""
    every = cycles.groupBy().agg(F.sort_array(F.collect_list(F.struct("cycle", "found"))).alias("c"))
    start = F.struct(F.lit(0).cast("bigint").alias("tracked"), F.array().cast("array<struct<cycle:bigint,found:bigint,accepted:boolean>>").alias("out"))

    def step(state: Column, c: Column) -> Column:
        ok = (state["tracked"] == 0) | (c["found"] >= state["tracked"] * (1 - most_lost))
        row = F.struct(c["cycle"].cast("bigint").alias("cycle"), c["found"].cast("bigint").alias("found"), ok.alias("accepted"))
        return F.struct(F.when(ok, c["found"].cast("bigint")).otherwise(state["tracked"]).alias("tracked"), F.concat(state["out"], F.array(row)).alias("out"))

    return every.select(F.explode(F.aggregate("c", start, step)["out"]).alias("r")).select("r.*")


def numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: num(F.col(c)) for c in cols})
