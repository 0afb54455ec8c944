"""Sharding by sampled splitters, with DataFrame functions only.

Law `bytes`: rows are ordered by (text hash, doc_id, row id), so equal texts lie next to each other, and shards are
consecutive stretches of that order whose byte counts differ by about one document. The order is never built in one
task: size-weighted samples of the key give quantile boundaries, rows are dealt to the ranges between them, ranges that
turn out overfull are subdivided by samples of their own, and only the ranges' sums meet on the driver. There are as many ranges
as hold range_rows rows each, at least ranges_per_shard a shard; subdividing ends when no range of several keys is overfull.

A group of equal texts lies in one stretch of the order. Where it lies on a shard's border and has no more bytes than the largest row,
the border moves to the group's edge, by the side on which its middle is: no further than a row of that size would move it, so bytes
stay as near equal as they can be told to be, and the group is whole. A group with more bytes than the largest row goes on in the
next shard where it must, as the law asks for bytes first.

Defined results: null text has size 1 and CRC 0; a null doc_id sorts first; repeated rows each get a slot; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, text_or_empty, write_table

KEY = ("k1", "k2", "k3")


def _unit(seed: int) -> Column:
    """A number in [0, 1) that depends on the key alone."""
    return F.shiftrightunsigned(F.xxhash64(*KEY, F.lit(seed)), 11) / F.lit(float(2**53))


def _quantiles(sample: list, step: float, pieces: int) -> list[tuple]:
    """Inner boundaries that cut a weighted key sample into pieces of equal weight."""
    rows = sorted((tuple(r[k] for k in KEY), max(float(r["size"]), step)) for r in sample)
    total, seen, out = sum(w for _, w in rows), 0.0, []
    for key, w in rows:
        if total and seen + w > total * (len(out) + 1) / pieces and len(out) < pieces - 1:
            out.append(key)
        while total and len(out) < pieces - 1 and seen + w > total * (len(out) + 1) / pieces:
            out.append(key)
        seen += w
    return sorted(set(out))


def _sample(rows: DataFrame, share: Column, seed: int) -> list:
    return rows.filter(_unit(seed) < F.col("size") * share).select(*KEY, "size").collect()


def _dealt(rows: DataFrame, splitters: list[tuple]) -> DataFrame:
    """Adds r, the range that holds the key: how many splitters are at or below it, found in three narrowing steps."""
    if not splitters:
        return rows.withColumn("r", F.lit(0))
    key = F.struct(*[F.col(k).cast("long").alias(k) for k in KEY])
    wide = max(1, round(len(splitters) ** (1 / 3)))
    table = lambda some: F.arrays_zip(*[F.array(*[F.lit(s[i]).cast("long") for s in some]).alias(k) for i, k in enumerate(KEY)])
    below = lambda cut: F.size(F.filter(cut, lambda s: s <= key))
    found = rows.withColumns({"_c1": table(splitters[wide * wide - 1 :: wide * wide]), "_c2": table(splitters[wide - 1 :: wide]), "_c3": table(splitters)})
    found = found.withColumn("_at", below(F.col("_c1")) * wide)
    found = found.withColumn("_at", (F.col("_at") + below(F.slice("_c2", F.col("_at") + 1, F.lit(wide)))) * wide)
    return found.withColumn("r", (F.col("_at") + below(F.slice("_c3", F.col("_at") + 1, F.lit(wide)))).cast("int")).drop("_c1", "_c2", "_c3", "_at")


def assign_shards(docs: DataFrame, n_shards: int = 16, ranges_per_shard: int = 8, range_rows: int = 1_000_000) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard (null under the law `bytes`).

    The key sample that comes to the driver is of about 64 keys a range, and a sum for each range: both grow with the rows by
    a range_rows-th.
    """
    text = text_or_empty()
    rows = write_table(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("k1"),
            F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("k2"),
            F.monotonically_increasing_id().alias("k3"),
        ),
        "shard-keys",
    )
    of_all = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    total, ranges = of_all["b"], max(n_shards * ranges_per_shard, -(-of_all["n"] // range_rows))
    target = max(1.0, total / ranges)
    step = max(1.0, total / (64 * ranges))
    splitters = _quantiles(_sample(rows, F.lit(1.0 / step), 1), step, ranges)
    for attempt in itertools.count():
        dealt = _dealt(rows, splitters)
        sums = dealt.groupBy("r").agg(F.sum("size"), F.count("*"), F.max("size"))
        stats = sorted(map(tuple, sums.collect()))
        over = {r: b for r, b, n, most in stats if b > 2 * target + most and n > 1}
        if not over:
            break
        more: list[tuple] = []
        inside = dealt.filter(F.col("r").isin(list(over)))
        rate = F.element_at(F.create_map(*[F.lit(x) for r, b in over.items() for x in (r, 64.0 * math.ceil(b / target) / b)]), F.col("r"))
        got = inside.filter(_unit(attempt + 2) < F.col("size") * rate).select("r", *KEY, "size").collect()
        for r, b in over.items():
            pieces = math.ceil(b / target)
            more += _quantiles([x for x in got if x["r"] == r], b / (64.0 * pieces), pieces)
        splitters = sorted({*splitters, *more})

    at_bytes, at_rows, starts = 0, 0, {}
    for r, b, n, _ in stats:
        starts[r] = (at_bytes, at_rows)
        at_bytes, at_rows = at_bytes + b, at_rows + n
    before = lambda i: F.element_at(F.array(*[F.lit(starts.get(r, (0, 0))[i]).cast("long") for r in range(len(splitters) + 1)]), F.col("r") + 1)
    up_to = Window.partitionBy("r").orderBy(*KEY).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumns({"ends": before(0) + F.sum("size").over(up_to), "rank": before(1) + F.row_number().over(up_to) - 1})
    middle = F.col("ends").cast("decimal(38,0)") * 2 - F.col("size")
    at = lambda twice: F.least(F.lit(n_shards - 1), F.floor(twice * n_shards / F.lit(2 * max(1, total)))).cast("int")
    placed = write_table(placed.select("doc_id", "size", "text_crc32", "k1", "ends", at(middle).alias("shard"), "rank"), "shard-places")
    # groups on a border that may move it: a shard has two borders, so they are fewer than the shards
    largest = max((most for *_, most in stats), default=0)
    groups = placed.groupBy("k1").agg(F.min("shard").alias("a"), F.max("shard").alias("b"), F.sum("size").alias("all"), F.max("ends").alias("ends"))
    moved = groups.filter((F.col("a") < F.col("b")) & (F.col("all") <= largest)).select("k1", at(F.col("ends").cast("decimal(38,0)") * 2 - F.col("all")).alias("to")).collect()
    if moved:
        placed = placed.withColumn("shard", F.coalesce(F.element_at(F.create_map(*[F.lit(x) for m in moved for x in (m["k1"], m["to"])]), F.col("k1")), F.col("shard")))
    firsts = dict(placed.groupBy("shard").agg(F.min("rank")).collect())
    first = F.element_at(F.array(*[F.lit(firsts.get(s, 0)).cast("long") for s in range(n_shards)]), F.col("shard") + 1)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("rank") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
