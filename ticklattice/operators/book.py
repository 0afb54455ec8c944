"""Order books from snapshots and diffs.

A diff carries absolute quantities, so the book at an instant is, per level, the last write: an aggregate over levels, with
no replay. How often a book is crossed comes from the life spans of its levels. Only books that are trimmed after every diff are
played, and then by segments of time that run side by side.

Columns: snaps (symbol, timestamp_ms, last_update_id, side, price, qty); events (symbol, timestamp_ms, u, seq, side, pos,
price, qty); diffs (symbol, timestamp_ms, u, pu, first_u, seq).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import levels
from ..schemas import DAY, HOUR
from ..scratch import written
from .pruning import in_days_to, since_anchors
from .spans import crossed_numbers, level_spans, numbered
from .windows import STRETCH, previous_in_tape, signed_price


def level_events(diffs: DataFrame) -> DataFrame:
    """One row per level of each diff, bids before asks, with the directories of a lake where the diffs have them."""
    sides, parts = None, [c for c in ("date", "hour") if c in diffs.columns]
    for n, (side, col) in enumerate((("bid", "bids_json"), ("ask", "asks_json"))):
        part = diffs.select("symbol", "timestamp_ms", F.col("last_update_id").alias("u"), "seq", F.lit(side).alias("side"), F.posexplode(levels(F.col(col))).alias("pos", "l"), *parts)
        part = part.select("symbol", "timestamp_ms", "u", "seq", "side", (F.col("pos") * 2 + n).alias("pos"), "l.price", "l.qty", *parts)
        sides = part if sides is None else sides.unionByName(part)
    return sides.dropna(subset=["price", "qty"])


def continuity(diffs: DataFrame, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Per key: rows, breaks (pu is not the u before) and the first break's expected and found id and size."""
    rows = previous_in_tape(diffs, "u", list(by), "seq", "expected").withColumn("broken", F.col("expected").isNotNull() & (F.col("pu") != F.col("expected")))
    first = F.min_by(F.struct("expected", "pu"), F.when(F.col("broken"), F.col("seq")))
    out = rows.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if("broken").alias("breaks"), first.alias("f"))
    return out.select(*by, "rows", "breaks", F.when(F.col("breaks") > 0, F.col("f.expected")).alias("expected"), F.when(F.col("breaks") > 0, F.col("f.pu")).alias("got"), F.when(F.col("breaks") > 0, F.abs(F.col("f.pu") - F.col("f.expected"))).alias("break_size"))


def seed(snaps: DataFrame, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Levels of the snapshot with the largest update id."""
    last = snaps.groupBy(*by).agg(F.max("last_update_id").alias("last_update_id"))
    return snaps.join(last, [*by, "last_update_id"], "left_semi")


def crossed(bid, ask):
    """A locked book (equal prices) is not crossed."""
    return F.coalesce(bid > ask, F.lit(False))


def top(book: DataFrame, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    return book.groupBy(*by).agg(F.max(F.when(F.col("side") == "bid", F.col("price"))).alias("best_bid"), F.min(F.when(F.col("side") == "ask", F.col("price"))).alias("best_ask"))


def seed_crossed(seeded: DataFrame, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    return top(seeded, by).withColumn("seed_crossed", crossed(F.col("best_bid"), F.col("best_ask")))


def anchor(snaps: DataFrame, t: int | None = None) -> DataFrame:
    """(symbol, anchor_ms, anchor_id): the newest snapshot by (time, id) at or before t, of t's day or the day before."""
    if t is not None:
        snaps = in_days_to(snaps, t).filter(F.col("timestamp_ms").between(t - t % DAY - DAY, t))
    return snaps.groupBy("symbol").agg(F.max(F.struct("timestamp_ms", "last_update_id")).alias("a")).select("symbol", F.col("a.timestamp_ms").alias("anchor_ms"), F.col("a.last_update_id").alias("anchor_id"))


def _since(rows: DataFrame, anchors: DataFrame, t: int | None) -> DataFrame:
    """Rows after the anchor and up to t. Before any join, directories of other hours than those from an anchor on are left out, and
    rows of other days than t's and the day before; then rows before the anchor's hour."""
    rows = since_anchors(rows, anchors, t)
    if t is not None:
        rows = rows.filter(F.col("timestamp_ms").between(t - t % DAY - DAY, t))
    return rows.join(anchors, "symbol").filter("u > anchor_id").filter(F.col("timestamp_ms") >= F.col("anchor_ms") - F.pmod("anchor_ms", F.lit(HOUR)))


def book_at(snaps: DataFrame, events: DataFrame, t: int | None = None) -> DataFrame:
    """(symbol, side, price, qty, u): the books at t (None: now), by the last write of each level since the anchor."""
    anchors = anchor(snaps, t)
    near = since_anchors(snaps, anchors, t) if t is None else in_days_to(snaps, t).filter(F.col("timestamp_ms").between(t - t % DAY - DAY, t))
    start = near.join(anchors, "symbol").filter("timestamp_ms = anchor_ms and last_update_id = anchor_id")
    start = start.select("symbol", "side", "price", "qty", F.col("last_update_id").alias("u"), F.lit(-1).cast("bigint").alias("seq"), F.lit(0).alias("pos"))
    after = _since(events, anchors, t).select("symbol", "side", "price", "qty", "u", F.col("seq").cast("bigint").alias("seq"), F.col("pos").cast("int").alias("pos"))
    last = start.unionByName(after).groupBy("symbol", "side", "price").agg(F.max_by(F.struct("qty", "u"), F.struct("u", "seq", "pos")).alias("w"))
    return last.filter("w.qty <> 0").select("symbol", "side", "price", "w.qty", "w.u")


def book_at_gap(snaps: DataFrame, diffs: DataFrame, t: int | None = None) -> DataFrame:
    """(symbol, applied, gap): whether the diffs applied since the anchor miss an update; the first one is not judged."""
    used = _since(diffs, anchor(snaps, t), t)
    rows = used.withColumn("b", F.lag("u").over(Window.partitionBy("symbol").orderBy("u", "seq"))) if t is not None else previous_in_tape(used, "u", ["symbol"], "u", "b")
    return rows.groupBy("symbol").agg(F.count("*").alias("applied"), F.bool_or(F.col("b").isNotNull() & (F.col("pu") != F.col("b"))).alias("gap"))


def normalize(diffs: DataFrame) -> DataFrame:
    """One row per update id, that with the largest event time."""
    place = Window.partitionBy("symbol", "u").orderBy(F.desc("timestamp_ms"), "first_u", "seq")
    return diffs.withColumn("_n", F.row_number().over(place)).filter("_n = 1").drop("_n")


def find_bridge(snaps: DataFrame, diffs: DataFrame, width: int = 1024) -> DataFrame:
    """Per snapshot: the first diff that continues it, and by which rule (`perfect`, else `pu_attach`).

    A diff continues the ids from the lesser of first_u - 1 and pu up to u - 1. Snapshots meet the diffs of their own stretch of
    `width` ids; the few diffs that span over 64 stretches are joined by themselves.
    """
    ids = snaps.select("symbol", "last_update_id").distinct()
    s, stretch = F.col("last_update_id"), lambda c: F.floor(c / width)
    rule = F.when(F.col("first_u") <= s + 1, "perfect").when((F.col("pu") <= s) & (s < F.col("first_u")), "pu_attach")
    rows = diffs.select("symbol", "u", "first_u", "pu").withColumns({"_a": stretch(F.least(F.col("first_u") - 1, "pu")), "_b": stretch(F.col("u") - 1)}).filter("_a <= _b")
    short, long = rows.filter("_b - _a <= 64"), rows.filter("_b - _a > 64")
    near = ids.withColumn("_at", stretch(s)).join(short.withColumn("_at", F.explode(F.sequence("_a", "_b"))), ["symbol", "_at"]).drop("_at")
    met = near.unionByName(ids.join(long, "symbol")).filter(F.col("u") > s).withColumn("rule", rule).filter("rule is not null")
    return met.groupBy("symbol", "last_update_id").agg(F.min(F.struct("u", "first_u", "pu", "rule")).alias("b")).select("symbol", "last_update_id", "b.u", "b.first_u", "b.pu", "b.rule")


def attach_report(snaps: DataFrame, diffs: DataFrame) -> DataFrame:
    """Outcome of attaching each snapshot to the symbol's (normalised) diffs: no_buffer, snapshot_older_than_buffer, no_bridge,
    gap_during_attach or attached, with the number of diffs from the bridge on. (`stale_snapshot_unbridgeable` can't occur: a
    snapshot that old has been found older than the buffer.)"""
    ids = snaps.select("symbol", "last_update_id").distinct()
    ends = diffs.groupBy("symbol").agg(F.min_by("pu", F.struct("u", "seq")).alias("first_pu"), F.max("u").alias("last_u"))
    bridge = find_bridge(snaps, diffs).select("symbol", "last_update_id", F.col("u").alias("bridge_u"), "rule")
    chain = previous_in_tape(diffs.select("symbol", "u", "pu"), "u", ["symbol"], "u", "before").select("symbol", "u", (F.col("pu") != F.col("before")).alias("broken"))
    last_break = chain.filter("broken").groupBy("symbol").agg(F.max("u").alias("last_break_u"))
    # places in the chain: by stretch of ids, after the sizes of the stretches before
    stretch = F.floor(F.col("u") / STRETCH)
    inside = chain.withColumn("_s", stretch).withColumn("k", F.row_number().over(Window.partitionBy("symbol", "_s").orderBy("u")))
    sizes = chain.groupBy("symbol", stretch.alias("_s")).agg(F.count("*").alias("k0"))
    ahead = F.coalesce(F.sum("k0").over(Window.partitionBy("symbol").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = inside.join(sizes.select("symbol", "_s", ahead.alias("ahead")), ["symbol", "_s"]).groupBy("symbol", "u").agg(F.min(F.col("ahead") + F.col("k")).alias("n"))
    size = chain.groupBy("symbol").agg(F.count("*").alias("size"))
    met = ids.join(ends, "symbol", "left").join(bridge, ["symbol", "last_update_id"], "left").join(last_break, "symbol", "left").join(size, "symbol", "left")
    met = met.join(totals.select("symbol", F.col("u").alias("bridge_u"), "n"), ["symbol", "bridge_u"], "left")
    outcome = (
        F.when(F.col("size").isNull(), "no_buffer")
        .when(F.col("last_update_id") < F.col("first_pu"), "snapshot_older_than_buffer")
        .when(F.col("bridge_u").isNull(), "no_bridge")
        .when(F.col("last_break_u") > F.col("bridge_u"), "gap_during_attach")
        .otherwise("attached")
    )
    return met.withColumn("outcome", outcome).select("symbol", "last_update_id", "outcome", "rule", F.when(F.col("outcome") == "attached", F.col("size") - F.col("n") + 1).alias("applied"))


def reanchor_events(report: DataFrame) -> DataFrame:
    """Log rows of attachments that did not succeed."""
    return report.filter("outcome <> 'attached'").select("symbol", "last_update_id", F.lit("re_anchor").alias("type"), F.col("outcome").alias("reason"))


def midnight_handoff(diffs: DataFrame) -> DataFrame:
    """(symbol, day_ms, handoff): whether a day's first pu is the u that the day before ended with; NULL without a day before."""
    days = diffs.groupBy("symbol", (F.col("timestamp_ms") - F.pmod("timestamp_ms", F.lit(DAY))).alias("day_ms")).agg(F.min_by("pu", "seq").alias("first_pu"), F.max_by("u", "seq").alias("last_u"))
    ended = days.select("symbol", (F.col("day_ms") + DAY).alias("day_ms"), F.col("last_u").alias("ended_u"))
    met = days.join(ended, ["symbol", "day_ms"], "left")
    verdict = F.when(F.col("ended_u").isNull() | F.col("first_pu").isNull(), None).when(F.col("first_pu") == F.col("ended_u"), "ok").otherwise("break")
    return met.select("symbol", "day_ms", "ended_u", "first_pu", verdict.alias("handoff"))


def midnight_trade_gap(trades: DataFrame) -> DataFrame:
    """(symbol, day_ms, gap_ms) from the last trade of the day before to the first of the day."""
    days = trades.groupBy("symbol", (F.col("timestamp_ms") - F.pmod("timestamp_ms", F.lit(DAY))).alias("day_ms")).agg(F.min("timestamp_ms").alias("a"), F.max("timestamp_ms").alias("b"))
    ended = days.select("symbol", (F.col("day_ms") + DAY).alias("day_ms"), F.col("b").alias("ended"))
    return days.join(ended, ["symbol", "day_ms"]).select("symbol", "day_ms", (F.col("a") - F.col("ended")).alias("gap_ms"))


def trim(book: DataFrame, n: int) -> DataFrame:
    """The best n levels of each side."""
    best = Window.partitionBy("symbol", "side").orderBy(F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price")))
    return book.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= n).drop("_n")


class Sides:
    """Two price maps with their best prices; a level of quantity 0 goes."""

    def __init__(self):
        self.levels = {"bid": {}, "ask": {}}
        self.best = {"bid": None, "ask": None}

    def put(self, side: str, price: float, qty: float) -> None:
        book, pick = self.levels[side], max if side == "bid" else min
        if qty:
            book[price] = qty
            if self.best[side] is None or pick(price, self.best[side]) == price:
                self.best[side] = price
        elif book.pop(price, None) is not None and price == self.best[side]:
            self.best[side] = pick(book) if book else None

    def crossed(self) -> bool:
        b, a = self.best["bid"], self.best["ask"]
        return b is not None and a is not None and b > a

    def trim(self, depth: int) -> None:
        for side, keep_high in (("bid", True), ("ask", False)):
            book = self.levels[side]
            if len(book) > depth:
                for price in sorted(book, reverse=keep_high)[depth:]:
                    del book[price]


def rebuild_day(seeded: DataFrame, events: DataFrame, segment_ms: int = HOUR) -> DataFrame:
    """Per symbol: diffs applied (update ids after the seed's), how often the book is crossed after a diff, the best prices at the end.

    Diffs are numbered by segments of time. Levels become life spans over these numbers, and the best prices come from the spans
    (see spans); no book is played.
    """
    ids = seeded.groupBy("symbol").agg(F.max("last_update_id").alias("seed_id"))
    used = events.join(ids, "symbol", "left").filter("seed_id is null or u > seed_id")
    placed = written(numbered(used.select("symbol", "timestamp_ms", "u", "seq", "pos", "side", "price", "qty"), "u", F.floor(F.col("timestamp_ms") / segment_ms)), "numbered-diffs")
    totals = placed.groupBy("symbol").agg(F.max("t").alias("total"))
    writes = placed.groupBy("symbol", "side", "price", "t").agg(F.max_by("qty", F.struct("seq", "pos")).alias("qty"))
    start = seeded.join(totals.select("symbol"), "symbol", "left_semi").groupBy("symbol", "side", "price").agg(F.max("qty").alias("qty"))
    spans = written(level_spans(writes.unionByName(start.withColumn("t", F.lit(0).cast("bigint")))), "level-spans")
    ends = top(spans.filter("b is null"))
    out = totals.join(crossed_numbers(spans, totals), "symbol", "left").join(ends, "symbol", "left")
    return out.select("symbol", F.col("total").alias("applied"), F.coalesce("crossed", F.lit(0)).cast("bigint").alias("crossed"), "best_bid", "best_ask")


_LEVEL = "symbol string, day long, segment long, side string, price double, qty double"


def _openings(rows: DataFrame, chain: DataFrame, depth: int) -> DataFrame:
    """A first guess of the book that each segment of a day but its first opens with: the best `depth` of the last writes before it."""
    rows = rows.join(chain.filter("next is not null"), ["symbol", "day", "segment"], "left_semi")
    last = rows.groupBy("symbol", "day", "segment", "side", "price").agg(F.max_by("qty", F.struct("u", "seq", "pos")).alias("qty"))
    until = F.lead("segment").over(Window.partitionBy("symbol", "day", "side", "price").orderBy("segment"))
    ends = chain.groupBy("symbol", "day").agg(F.max("segment").alias("end"))
    spans = last.withColumn("until", until).filter("qty <> 0").join(ends, ["symbol", "day"]).withColumn("until", F.coalesce("until", "end")).filter("segment < until")
    held = spans.select("symbol", "day", F.explode(F.sequence(F.col("segment") + 1, F.col("until"))).alias("segment"), "side", "price", "qty")
    best = Window.partitionBy("symbol", "day", "segment", "side").orderBy(signed_price())
    return held.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= depth).drop("_n")


def _played(rows: DataFrame, openings: DataFrame, depth: int) -> DataFrame:
    """The book at the end of each segment, from its opening and its diffs, trimmed after each diff."""
    none = F.lit(None).cast("bigint")
    start = openings.select("symbol", "day", "segment", F.lit(0).alias("kind"), none.alias("u"), none.alias("seq"), F.lit(None).cast("int").alias("pos"), "side", "price", "qty")
    both = start.unionByName(rows.select("symbol", "day", "segment", F.lit(1).alias("kind"), "u", "seq", "pos", "side", "price", "qty"))
    ordered = both.repartition("symbol", "day", "segment").sortWithinPartitions("symbol", "day", "segment", "kind", "u", "seq", "pos")

    def play(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, book, at = None, Sides(), None

        def closed() -> pd.DataFrame:
            book.trim(depth)
            return pd.DataFrame([(*key, s, p, q) for s, side in book.levels.items() for p, q in side.items()], columns=["symbol", "day", "segment", "side", "price", "qty"])

        for batch in batches:
            for *where, kind, u, side, price, qty in zip(*(batch[c] for c in ("symbol", "day", "segment", "kind", "u", "side", "price", "qty")), strict=True):
                if where != key:
                    if key is not None:
                        yield closed()
                    key, book, at = where, Sides(), None
                if kind and at is not None and u != at:
                    book.trim(depth)
                at = u if kind else None
                book.put(side, price, qty)
        if key is not None:
            yield closed()

    return ordered.mapInPandas(play, _LEVEL)


def _segments(rows: DataFrame, least: int) -> DataFrame:
    """Rows with `segment` set to the first of the segments of their day that are played together: short ones that follow each other, until
    they have `least` rows. Only the segments' sizes meet."""
    where = ["symbol", "day", "segment"]
    before = F.coalesce(F.sum("n").over(Window.partitionBy("symbol", "day").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = rows.groupBy(*where).agg(F.count("*").alias("n")).select(*where, F.floor(before / least).alias("_part"))
    first = F.min("segment").over(Window.partitionBy("symbol", "day", "_part"))
    return rows.join(sizes.select(*where, first.alias("_first")), where).withColumn("segment", F.col("_first")).drop("_first")


def live_book(events: DataFrame, depth: int, segment_ms: int = HOUR, least_rows: int = 100_000) -> DataFrame:
    """Books of each symbol and day that are trimmed to the best `depth` levels after every diff.

    Trimming depends on the path: a level that was cut stays out when better ones go. Segments of a day run side by side, each
    from a guess of its opening book, the best of the last writes before it; then every segment whose guess isn't the book that the
    one before ended with is played again from that book, until all fit. A day's first segment is right at once, and each round makes
    at least the next one right, so the books are those of one sequence; guesses are wrong only where a cut level would be in the
    best `depth` again. Segments are `segment_ms` long; short ones are played together, so a segment has less than `least_rows` rows and
    those of `segment_ms` more, and only busy days take rounds. A task's group is one segment of a symbol.
    """
    parts = events.select("symbol", F.floor(F.col("timestamp_ms") / DAY).alias("day"), F.floor(F.col("timestamp_ms") / segment_ms).alias("segment"), "u", F.col("seq").cast("bigint").alias("seq"), F.col("pos").cast("int").alias("pos"), "side", "price", "qty")
    rows = _segments(written(parts, "live-events"), least_rows)
    where = ["symbol", "day", "segment"]
    follows = F.lead("segment").over(Window.partitionBy("symbol", "day").orderBy("segment"))
    chain = written(rows.groupBy(*where).agg(F.max("u").alias("u")).withColumn("next", follows), "live-segments")
    print_of = lambda df, name: df.groupBy(*where).agg(F.struct(F.count("*").alias("n"), F.bit_xor(F.xxhash64("side", "price", "qty")).alias("x")).alias(name))
    openings = written(_openings(rows, chain, depth), "live-openings")
    closings = written(_played(rows, openings.join(chain, where, "left_semi"), depth), "live-closings")
    while True:
        right = written(closings.join(chain.select(*where, "next"), where).filter("next is not null").select("symbol", "day", F.col("next").alias("segment"), "side", "price", "qty"), "live-openings")
        told = chain.select(*where).join(print_of(openings, "guess"), where, "left").join(print_of(right, "fact"), where, "left")
        wrong = written(told.filter(~F.col("guess").eqNullSafe(F.col("fact"))).select(*where), "live-wrong")
        if wrong.isEmpty():
            break
        again = _played(rows.join(wrong, where, "left_semi"), right.join(wrong, where, "left_semi"), depth)
        closings, openings = written(closings.join(wrong, where, "left_anti").unionByName(again), "live-closings"), right
    last = chain.filter("next is null").select(*where, "u")
    return closings.join(last, where).select("symbol", "day", "side", "price", "qty", "u")


def emit_snapshots(snaps: DataFrame, events: DataFrame, every_ms: int) -> DataFrame:
    """Books at each end of an interval in which a symbol has events: (symbol, at_ms, side, price, qty), by last writes."""
    rows = events.withColumn("at_ms", (F.floor(F.col("timestamp_ms") / every_ms) + 1) * every_ms)
    start = seed(snaps.join(snaps.groupBy("symbol").agg(F.min("last_update_id").alias("last_update_id")), ["symbol", "last_update_id"], "left_semi"))
    first = rows.groupBy("symbol").agg(F.min("at_ms").alias("at_ms"))
    both = start.join(first, "symbol").select("symbol", "at_ms", "side", "price", "qty", F.col("last_update_id").alias("u"), F.lit(-1).cast("bigint").alias("seq"), F.lit(0).alias("pos")).unionByName(
        rows.select("symbol", "at_ms", "side", "price", "qty", "u", F.col("seq").cast("bigint"), F.col("pos").cast("int"))
    )
    written = both.groupBy("symbol", "at_ms", "side", "price").agg(F.max_by("qty", F.struct("u", "seq", "pos")).alias("qty"))
    until = F.lead("at_ms").over(Window.partitionBy("symbol", "side", "price").orderBy("at_ms"))
    spans = written.withColumn("until", until).filter("qty <> 0")
    nth = rows.select("symbol", "at_ms").distinct().withColumn("n", F.row_number().over(Window.partitionBy("symbol").orderBy("at_ms")))
    places = nth.groupBy("symbol").agg(F.map_from_entries(F.collect_list(F.struct("at_ms", "n"))).alias("n_of"), F.sort_array(F.collect_list("at_ms")).alias("instants"))
    a, b = F.element_at("n_of", F.col("at_ms")), F.coalesce(F.element_at("n_of", F.col("until")) - 1, F.size("instants"))
    return spans.join(places, "symbol").select("symbol", F.explode(F.slice("instants", a, b - a + 1)).alias("at_ms"), "side", "price", "qty")
