"""Life spans of book levels, and how long two sides' spans cross.

Diffs are numbered 1, 2, 3... per symbol; a level lives in spans [a, b) of these numbers. A span is cut into the aligned runs of
2**k numbers that make it up, two of each length at most, and a run keeps the best price of the spans that it is part of. The best
price at a number is the best over the runs that hold it, so no book is played: what is shuffled goes up with the spans and their
logarithm, and a run is a key of its own, so a busy symbol is spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import written

#: Runs of up to 2**(BLOCK - 1) numbers are compared number by number, longer ones block by block.
BLOCK = 5


def numbered(rows: DataFrame, order: str, segment: Column, name: str = "t") -> DataFrame:
    """Adds the place of each row's `order` value among the symbol's, from 1, equal values alike. Places are found by segments that
    follow each other in that order; only the segments' sizes meet."""
    rows = rows.withColumn("_segment", segment)
    inside = rows.withColumn("_n", F.dense_rank().over(Window.partitionBy("symbol", "_segment").orderBy(order)).cast("bigint"))
    sizes = rows.groupBy("symbol", "_segment").agg(F.countDistinct(order).alias("_size"))
    ahead = F.coalesce(F.sum("_size").over(Window.partitionBy("symbol").orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return inside.join(sizes.select("symbol", "_segment", ahead.alias("_ahead")), ["symbol", "_segment"]).withColumn(name, F.col("_ahead") + F.col("_n")).drop("_segment", "_n", "_ahead")


def level_spans(states: DataFrame) -> DataFrame:
    """(symbol, side, price, a, b) from the levels' last writes (symbol, side, price, t, qty) at each number; b is null while it lives."""
    level = Window.partitionBy("symbol", "side", "price").orderBy("t")
    alive = states.withColumn("alive", F.col("qty") != 0).withColumn("was", F.coalesce(F.lag("alive").over(level), F.lit(False)))
    turns = alive.filter("alive <> was").withColumn("b", F.lead("t").over(level))
    return turns.filter("alive").select("symbol", "side", "price", F.col("t").alias("a"), "b")


def aligned_runs(spans: DataFrame) -> DataFrame:
    """The runs (k, run) of 2**k numbers from run * 2**k on that make up each span [a, b)."""
    levels = spans.filter("a < b").withColumn("k", F.explode(F.expr("sequence(0, CAST(floor(log2(b - a)) AS INT))")))
    ends = levels.withColumns({"_l": F.expr("shiftright(a + shiftleft(1L, k) - 1, k)"), "_r": F.expr("shiftright(b, k)")}).filter("_l < _r")
    odd = lambda c: F.col(c).bitwiseAND(F.lit(1)) == 1
    return ends.withColumn("run", F.explode(F.array_compact(F.array(F.when(odd("_l"), F.col("_l")), F.when(odd("_r"), F.col("_r") - 1))))).drop("_l", "_r")


def crossed_numbers(spans: DataFrame, totals: DataFrame) -> DataFrame:
    """(symbol, crossed): at how many of the symbol's numbers 1 to total (totals: symbol, total) the best bid is above the best ask."""
    price = lambda side: F.when(F.col("side") == side, F.col("price"))
    reach = spans.groupBy("symbol").agg(F.max(price("bid")).alias("high"), F.min(price("ask")).alias("low"))
    near = spans.join(totals, "symbol").join(reach, "symbol").filter(F.when(F.col("side") == "bid", F.col("price") > F.col("low")).otherwise(F.col("price") < F.col("high")))
    whole = near.select("symbol", "side", "price", F.greatest("a", F.lit(1)).alias("a"), F.least(F.coalesce("b", F.col("total") + 1), F.col("total") + 1).alias("b"))
    best = [F.max(price("bid")).alias("bid"), F.min(price("ask")).alias("ask")]
    runs = written(aligned_runs(whole).groupBy("symbol", "k", "run").agg(*best), "level-runs")
    again = [F.max("bid").alias("bid"), F.min("ask").alias("ask")]
    # blocks that any run touches, with the best of the runs that hold them whole
    long = runs.filter(F.col("k") >= BLOCK)
    blocks = totals.join(reach, "symbol").select("symbol", "total", F.explode(F.expr(f"sequence(0L, shiftright(total, {BLOCK}))")).alias("block"))
    up = blocks.withColumn("k", F.explode(F.expr(f"sequence({BLOCK}, greatest({BLOCK}, CAST(floor(log2(total + 1)) AS INT)))"))).withColumn("run", F.expr(f"shiftright(block, k - {BLOCK})"))
    held = up.join(long, ["symbol", "k", "run"]).groupBy("symbol", "block", "total").agg(*again)
    first, last = F.greatest(F.col("block") * (1 << BLOCK), F.lit(1)), F.least(F.col("block") * (1 << BLOCK) + (1 << BLOCK) - 1, F.col("total"))
    through = held.filter("bid > ask").select("symbol", (last - first + 1).alias("n"))
    # in the other blocks, numbers that short runs hold
    each = runs.filter(F.col("k") < BLOCK).withColumn("t", F.explode(F.expr("sequence(shiftleft(run, k), shiftleft(run + 1, k) - 1)"))).groupBy("symbol", "t").agg(*again)
    met = each.withColumn("block", F.expr(f"shiftright(t, {BLOCK})")).join(held.select("symbol", "block", F.col("bid").alias("bid0"), F.col("ask").alias("ask0")), ["symbol", "block"], "left")
    alone = met.filter("NOT coalesce(bid0 > ask0, false)").filter(F.greatest("bid", "bid0") > F.least("ask", "ask0")).select("symbol", F.lit(1).cast("bigint").alias("n"))
    return through.unionByName(alone).groupBy("symbol").agg(F.sum("n").alias("crossed"))
