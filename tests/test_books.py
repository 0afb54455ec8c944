import random

import pytest
from pyspark.sql import functions as F

from ticklattice.operators import book, windows
from ticklattice.operators.windows import ladder
from ticklattice.plans import book_now, replay_at
from ticklattice.sources import lanes

T0 = 1_768_453_200_000
DIFF = "symbol string, timestamp_ms long, u long, pu long, first_u long, seq long"
EVENT = "symbol string, timestamp_ms long, u long, seq long, side string, pos int, price double, qty double"
SNAP = "symbol string, timestamp_ms long, last_update_id long, side string, price double, qty double"


def snap(last, levels, t=T0, symbol="s"):
    return [(symbol, t, last, side, p, q) for side, p, q in levels]


SEED = snap(100, [("bid", 99.0, 1.0), ("bid", 98.0, 2.0), ("ask", 101.0, 1.5), ("ask", 102.0, 2.5)])
TAPE = [(101, 100, [("bid", 99.5, 0.4)]), (102, 101, [("ask", 101.0, 0.0)]), (103, 102, [("bid", 98.0, 0.0), ("ask", 100.8, 1.0)])]


def events(tape, t=T0):
    return [("s", t + 1000 * (i + 1), u, i, side, k, p, q) for i, (u, _, levels) in enumerate(tape) for k, (side, p, q) in enumerate(levels)]


def diffs(tape, t=T0):
    return [("s", t + 1000 * (i + 1), u, pu, u, i) for i, (u, pu, _) in enumerate(tape)]


def rebuild(spark, seed, tape, **options):
    return book.rebuild_day(spark.createDataFrame(seed, SNAP), spark.createDataFrame(events(tape), EVENT), **options).collect()[0]


def test_clean_rebuild(spark):
    got = rebuild(spark, SEED, TAPE)
    assert (got.applied, got.crossed, got.best_bid, got.best_ask) == (3, 0, 99.5, 100.8)
    assert book.continuity(spark.createDataFrame(diffs(TAPE), DIFF)).collect()[0].breaks == 0


def test_break(spark):
    got = book.continuity(spark.createDataFrame(diffs([(101, 100, []), (105, 104, []), (106, 105, [])]), DIFF)).collect()[0]
    assert (got.rows, got.breaks, got.expected, got.got, got.break_size) == (3, 1, 101, 104, 3)


def test_crossed(spark):
    assert rebuild(spark, SEED, [(101, 100, [("bid", 102.0, 1.0)])]).crossed == 1
    assert rebuild(spark, SEED, [(101, 100, [("bid", 101.0, 1.0)])]).crossed == 0  # locked
    seed = spark.createDataFrame(snap(300, [("bid", 102.0, 1.0), ("ask", 101.0, 1.0)]), SNAP)
    assert book.seed_crossed(seed).collect()[0].seed_crossed
    assert book.rebuild_day(seed, spark.createDataFrame(events([(299, 298, [("bid", 1.0, 1.0)])]), EVENT)).count() == 0


def test_newest_snapshot_by_id(spark):
    snaps = spark.createDataFrame([*snap(50, [("bid", 1.0, 1.0)], T0 + 9), *snap(200, [("bid", 99.5, 1.0), ("ask", 101.0, 1.0)])], SNAP)
    assert {r.last_update_id for r in book.seed(snaps).collect()} == {200}


def test_handoff(spark):
    day = 86_400_000
    for pu, want in ((200, "ok"), (205, "break")):
        rows = [("s", T0 - day, 200, 199, 200, 0), ("s", T0, 201 if pu == 200 else 206, pu, 201, 1)]
        got = {r.day_ms: r.handoff for r in book.midnight_handoff(spark.createDataFrame(rows, DIFF)).collect()}
        assert [got[k] for k in sorted(got)] == [None, want]


@pytest.mark.parametrize("s, rows, want", [
    (100, [(101, 110, 100)], "perfect"), (105, [(110, 120, 100)], "pu_attach"), (100, [(90, 95, 89), (96, 100, 95), (101, 110, 100)], "perfect"), (100, [(200, 210, 199)], None),
])
def test_bridge(spark, s, rows, want):
    d = spark.createDataFrame([("s", T0, u, pu, first, i) for i, (first, u, pu) in enumerate(rows)], DIFF)
    found = book.find_bridge(spark.createDataFrame(snap(s, [("bid", 1.0, 1.0)]), SNAP), d).collect()
    assert [r.rule for r in found] == ([want] if want else [])


def test_normalize_and_trim(spark):
    d = spark.createDataFrame([("s", 200, 30, 0, 30, 0), ("s", 200, 20, 0, 20, 1), ("s", 201, 10, 0, 10, 2), ("s", 201, 20, 0, 20, 3)], DIFF)
    assert sorted((r.u, r.timestamp_ms) for r in book.normalize(d).collect()) == [(10, 201), (20, 201), (30, 200)]
    levels = spark.createDataFrame([("s", "bid", float(p), 1.0) for p in range(90, 100)] + [("s", "ask", float(p), 1.0) for p in range(101, 111)], "symbol string, side string, price double, qty double")
    assert sorted(r.price for r in book.trim(levels, 3).collect()) == [97, 98, 99, 101, 102, 103]
    steps = [r.cumulative for r in ladder(levels, 5).filter("side = 'bid'").orderBy("level").collect()]
    assert steps == [1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        ladder(levels, 0)


def sequential(seed, tape, until=None, depth=None):
    out, crossed = book.Sides(), 0
    for _, _, _, side, p, q in seed:
        out.put(side, p, q)
    for i, (_, _, levels) in enumerate(tape):
        if until is not None and T0 + 1000 * (i + 1) > until:
            break
        for side, p, q in levels:
            out.put(side, p, q)
        if depth:
            out.trim(depth)
        crossed += out.crossed()
    return out, crossed


def test_last_write_equals_sequence(spark):
    rng = random.Random(1)
    tape = [(101 + i, 100 + i, [(rng.choice(["bid", "ask"]), float(rng.randint(90, 110)), float(rng.choice([0, 0, 1, 2]))) for _ in range(rng.randint(1, 3))]) for i in range(300)]
    snaps, ev = spark.createDataFrame(SEED, SNAP), spark.createDataFrame(events(tape), EVENT)
    for until in (T0 + 50_000, T0 + 250_500, None):
        want, _ = sequential(SEED, tape, until)
        got = {(r.side, r.price): r.qty for r in book.book_at(snaps, ev, until).collect()}
        assert got == {(s, p): q for s, levels in want.levels.items() for p, q in levels.items()}
    want, crossed = sequential(SEED, tape)
    for width in (3_600_000, 7_000, 1_000):
        r = rebuild(spark, SEED, tape, segment_ms=width)
        assert (r.applied, r.crossed, r.best_bid, r.best_ask) == (300, crossed, want.best["bid"], want.best["ask"])
    trimmed, _ = sequential([], tape, depth=4)
    got = {(r.side, r.price): r.qty for r in book.live_book(ev, 4).collect()}
    assert got == {(s, p): q for s, levels in trimmed.levels.items() for p, q in levels.items()}
    for width, least in ((40_000, 1), (20_000, 60)):
        got = {(r.side, r.price): r.qty for r in book.live_book(ev, 4, width, least).collect()}
        assert got == {(s, p): q for s, levels in trimmed.levels.items() for p, q in levels.items()}


def test_short_segments_are_played_together(spark):
    rows = spark.createDataFrame([("s", 0, h) for h in range(6) for _ in range(3)] + [("s", 0, 6)] * 50 + [("s", 1, 24), ("z", 0, 2)], "symbol string, day long, segment long")
    got = {(r.symbol, r.day, r.segment): r["count"] for r in book._segments(rows, 7).groupBy("symbol", "day", "segment").count().collect()}
    assert got == {("s", 0, 0): 9, ("s", 0, 3): 6, ("s", 0, 5): 53, ("s", 1, 24): 1, ("z", 0, 2): 1}
    alone = book._segments(rows, 1).groupBy("symbol", "day", "segment").count()
    assert alone.count() == 9


def test_gap_and_replay(spark):
    snaps, ev = spark.createDataFrame(SEED, SNAP), spark.createDataFrame(events(TAPE), EVENT)
    gapped = diffs([(101, 100, []), (103, 102, [])])
    assert book.book_at_gap(snaps, spark.createDataFrame(gapped, DIFF), T0 + 9000).collect()[0].gap
    lad, top = book_now(snaps, ev)
    assert (top.collect()[0].best_bid, top.collect()[0].best_ask, top.collect()[0].spread) == (99.5, 100.8, 1.3)
    rows = lambda ddl, *r: spark.createDataFrame([("s", *x) for x in r], f"symbol string, timestamp_ms long, seq long, {ddl}")
    lanes = {
        "klines": rows("close double", (T0, 0, 100.5)), "funding_rates": rows("funding_rate double, next_funding_time long", (T0, 0, 0.0001, T0)), "open_interest": rows("open_interest double, oi_value double", (T0, 0, 1.0, 2.0)),
        "long_short_ratio": rows("ratio_type string, long_short_ratio double", (T0, 0, "global", 1.9)), "trades": rows("price double, quantity double", (T0, 0, 100.0, 1.0)), "liquidations": rows("value double", (T0 + 45_000, 0, 208.0)),
    }
    at = replay_at(lanes, snaps, ev, spark.createDataFrame(diffs(TAPE), DIFF), T0 + 2000)
    assert (at["top"].collect()[0].best_bid, at["top"].collect()[0].best_ask) == (99.5, 102.0)
    assert at["tape"].count() == 1 and at["funding"].collect()[0].funding_rate == 0.0001 and not at["gap"].collect()[0].gap
    for t, n in ((T0 + 44_000, 0), (T0 + 45_500, 1)):
        assert replay_at(lanes, snaps, ev, spark.createDataFrame(diffs(TAPE), DIFF), t)["liquidations"].count() == n
    with pytest.raises(ValueError):
        replay_at(lanes, snaps, ev, spark.createDataFrame(diffs(TAPE), DIFF), T0 - 1)


def test_level_events(spark):
    d = spark.createDataFrame([("s", 1, 7, 0, '[["99.5","0.4"],["x","1"]]', '[["101","2"]]')], "symbol string, timestamp_ms long, last_update_id long, seq long, bids_json string, asks_json string")
    assert sorted((r.side, r.price, r.qty) for r in book.level_events(d).collect()) == [("ask", 101.0, 2.0), ("bid", 99.5, 0.4)]


def diff_files(root, hours, rows=40, broken=()):
    """Hourly diff files of one chained tape; `broken` are places whose prev_update_id is off. Returns the number of diffs."""
    folder = root / "orderbooks" / "btcusdt"
    n = 0
    for h in range(hours):
        day, hour = f"2026-01-{15 + h // 24}", h % 24
        (folder / day).mkdir(parents=True, exist_ok=True)
        lines = ["exchange,market,datatype,timestamp_ms,datetime_utc,symbol,first_update_id,last_update_id,prev_update_id,bids_json,asks_json"]
        for _ in range(rows):
            n += 1
            lines.append(f'x,y,depth_updates,{1768435200000 + h * 3600000 + n},t,btcusdt,{n * 10 - 9},{n * 10},{n * 10 - 10 - (n in broken)},"[[""99.5"",""{n % 3}""]]",[]')
        (folder / day / f"btcusdt_depth_updates_{day}_{hour:02d}00-to-{(hour + 1) % 24:02d}00.csv").write_text("\n".join(lines) + "\n")
    return n


def test_tape_order_over_files(spark, tmp_path):
    """A clean chain of hourly files reads as one, in many partitions and in few; a planted break is found once, at its place."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500b")
    try:
        n = diff_files(tmp_path / "clean", 30)
        diffs = lanes.read_diffs(spark, str(tmp_path / "clean")).select("symbol", "timestamp_ms", "seq", "file_name", F.col("last_update_id").alias("u"), F.col("prev_update_id").alias("pu"))
        assert diffs.rdd.getNumPartitions() > 30
        for rows in (diffs, diffs.repartition(7)):
            assert [r.u for r in rows.orderBy("seq").collect()] == [10 * i for i in range(1, n + 1)]
            r = book.continuity(rows).first()
            assert (r.rows, r.breaks, r.expected) == (n, 0, None)
        assert diffs.select("seq").distinct().count() == n
        assert {(h.handoff) for h in book.midnight_handoff(diffs).collect()} == {None, "ok"}
        diff_files(tmp_path / "broken", 30, broken={41, 500})
        rows = lanes.read_diffs(spark, str(tmp_path / "broken")).select("symbol", "seq", F.col("last_update_id").alias("u"), F.col("prev_update_id").alias("pu"))
        r = book.continuity(rows).first()
        assert (r.rows, r.breaks, r.expected, r.got) == (n, 2, 400, 399)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    again = lanes.read_diffs(spark, str(tmp_path / "clean"))
    assert [r.last_update_id for r in again.orderBy("seq").collect()] == [10 * i for i in range(1, n + 1)]


def test_stretches_join_at_their_ends(spark):
    rows = [("a", i, i * 3, "INFO" if i % 7 == 0 else "ERROR" if i % 7 == 3 else None) for i in range(100)] + [("b", 5, 1, None), ("b", 90, 2, "WARN"), ("b", 99, 3, None)]
    df = spark.createDataFrame(rows, "file_name string, seq long, u long, level string")
    whole = {(r.file_name, r.seq): r.previous for r in windows.previous(df, "u", ["file_name"], ["seq"]).collect()}
    kept = {(r.file_name, r.seq) for r in windows.filter_logs(df, "WARN", width=1 << 40).collect()}
    mean = {r.file_name: r.ema for r in windows.ema(df, "u", ["file_name"], width=1 << 40).collect()}
    for width in (1, 4, 10):
        assert {(r.file_name, r.seq): r.previous for r in windows.previous_in_tape(df, "u", ["file_name"], "seq", width=width).collect()} == whole
        assert {(r.file_name, r.seq) for r in windows.filter_logs(df, "WARN", width=width).collect()} == kept
        got = windows.ema(df, "u", ["file_name"], width=width).collect()
        assert all(abs(r.ema - mean[r.file_name]) < 1e-9 for r in got) and {r.file_name: r.samples for r in got} == {"a": 100, "b": 3}
    x = 0.0
    for r in rows[:100]:
        x = x * 0.95 + r[2] * 0.05 if r[1] else r[2]
    assert abs(mean["a"] - x) < 1e-9


def test_bridges_over_long_spans(spark):
    """Any diff may continue a snapshot, also one that spans many stretches of ids."""
    rng = random.Random(3)
    diffs = [("a", u, u - rng.choice([0, 1, 5, 300]), u - rng.choice([1, 2, 400, 5000])) for u in rng.sample(range(6000, 20000), 300)]
    snaps = [("a", i) for i in rng.sample(range(5000, 21000), 80)]
    want = {}
    for _, s in snaps:
        ok = [(u, f, p, "perfect" if f <= s + 1 else "pu_attach") for _, u, f, p in diffs if u > s and (f <= s + 1 or p <= s < f)]
        if ok:
            want[s] = min(ok)
    got = book.find_bridge(spark.createDataFrame(snaps, "symbol string, last_update_id long"), spark.createDataFrame(diffs, "symbol string, u long, first_u long, pu long"), width=16)
    assert {r.last_update_id: (r.u, r.first_u, r.pu, r.rule) for r in got.collect()} == want
