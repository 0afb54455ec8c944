import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from ticklattice.operators import windows
from ticklattice.operators.book import Sides
from ticklattice.streaming import ingest, state
from ticklattice.streaming.pages import Pages

TRADE = "symbol string, timestamp_ms long, seq long, trade_id long"


def feed(spark, tmp_path, rows, ddl, files):
    """A file stream of the rows in so many files, one per batch."""
    folder = tmp_path / uuid.uuid4().hex
    folder.mkdir()
    step = -(-len(rows) // files)
    for k in range(files):
        part = rows[k * step : (k + 1) * step]
        if part:
            spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").json(str(folder / f"part{k}"))
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).json(str(folder))


def drain(df, tmp_path, mode="append"):
    name = "t" + uuid.uuid4().hex
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    for _ in range(60):  # with timers a stream goes on without data: the first such batch ends it here
        if q.awaitTermination(1) or q.lastProgress is not None and q.lastProgress["numInputRows"] == 0:
            break
    q.stop()
    assert q.exception() is None
    return df.sparkSession.table(name).collect()


@pytest.mark.parametrize("files", [1, 3])
def test_fifo_dedup(spark, tmp_path, files):
    ids = list(range(12)) + [11, 3, 0, 12, 0]
    rows = [("s", i, i, x) for i, x in enumerate(ids)]
    seen, want = [], []
    for x in ids:
        if x not in seen:
            want.append(x)
            seen = (seen + [x])[-10:]
    got = drain(state.dedup_fifo(feed(spark, tmp_path, rows, TRADE, files), window=10, idle_ms=0), tmp_path)
    assert [r.trade_id for r in sorted(got, key=lambda r: r.seq)] == want


@pytest.mark.parametrize("files", [1, 3])
def test_new_buckets_equal_batch(spark, tmp_path, files):
    rows = [("s" if i % 2 else "t", (i * 7) % 11, i, i) for i in range(24)]
    got = drain(state.new_buckets(feed(spark, tmp_path, rows, TRADE, files), ["symbol"]), tmp_path)
    want = windows.new_buckets(spark.createDataFrame(rows, TRADE), ["symbol"]).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_watermark_dedup(spark, tmp_path):
    rows = [("s", i * 1000, i, i % 4) for i in range(9)]
    got = drain(state.dedup_trades(feed(spark, tmp_path, rows, TRADE, 3)), tmp_path)
    assert sorted(r.trade_id for r in got) == [0, 1, 2, 3]


def test_lifecycle(spark, tmp_path):
    seen = [["A", "B"], ["A"], ["A", "B"], ["A"], ["A"], ["A", "B"]]
    rows = [("x", i, s) for i, s in enumerate(seen)]
    got = drain(state.lifecycle(feed(spark, tmp_path, rows, "exchange string, cycle long, symbols array<string>", 3), most_lost=0.9), tmp_path)
    changes = sorted((r.cycle, r.symbol, r.change) for r in got)
    assert changes == [(0, "a", "added"), (0, "b", "added"), (4, "b", "removed"), (5, "b", "added")]
    table = [(s.lower(), i, s in found) for i, found in enumerate(seen) for s in "AB"]
    batch = windows.lifecycle(spark.createDataFrame(table, "symbol string, cycle long, present boolean"))
    assert sorted((r.cycle, r.symbol, r.change) for r in batch.collect()) == changes
    guard = drain(state.lifecycle(feed(spark, tmp_path, [("x", 0, list("abcdefghij")), ("x", 1, list("abc")), ("x", 2, list("abc"))], "exchange string, cycle long, symbols array<string>", 1)), tmp_path)
    assert all(r.change == "added" for r in guard)


def test_accepted_cycles(spark):
    rows = spark.createDataFrame([(0, 100), (1, 95), (2, 50), (3, 90)], "cycle long, found long")
    assert [r.accepted for r in windows.accepted_cycles(rows).orderBy("cycle").collect()] == [True, True, False, True]


def test_ingest(spark, tmp_path):
    raw = [{"data": {"e": "aggTrade", "E": 1, "s": "BTC", "a": i % 3, "p": "1", "q": "1", "f": 1, "l": 1, "T": 1_700_000_000_000 + i, "m": False}} for i in range(6)]
    raw += [{"data": {"e": "depthUpdate", "E": 1_700_000_000_000, "s": "BTC", "U": i, "u": i, "pu": i - 1, "b": [], "a": []}} for i in (3, 1, 2)] + [{"data": {"e": "what"}}]
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.txt").write_text("\n".join(map(json.dumps, raw[:5])))
    (folder / "b.txt").write_text("\n".join(map(json.dumps, raw[5:])))
    source = spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder))
    lake = str(tmp_path / "lake")
    q = ingest.start_ingest(source, lake, str(tmp_path / "check"), once=True)
    q.awaitTermination(60)
    assert q.exception() is None
    assert ingest.read_lake(spark, lake, "trades").count() == 3
    assert [r.last_update_id for r in ingest.read_lake(spark, lake, "depth_updates").collect()] == [1, 2, 3]
    counts = ingest.stream_metrics(spark.createDataFrame([("a",), ("a",)], "event_type string")).collect()
    assert counts[0].messages == 2
    changes = spark.createDataFrame([("a", 1, "added"), ("b", 1, "added"), ("b", 3, "removed")], "symbol string, cycle long, change string")
    assert [r.symbol for r in ingest.pending_listings(changes, None, 5).collect()] == ["a"]


LIVE = "symbol string, kind string, timestamp_ms long, first_u long, u long, pu long, bids array<array<double>>, asks array<array<double>>"


def test_live_books(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = [
        ("s", "diff", 1, 90, 95, 89, [[1.0, 1.0]], []), ("s", "diff", 2, 101, 110, 100, [[99.5, 2.0]], []), ("s", "snapshot", 3, 100, 100, 0, [[99.0, 1.0]], [[101.0, 1.0]]),
        ("s", "diff", 4, 111, 112, 110, [[99.5, 0.0]], [[100.5, 1.0]]), ("s", "diff", 5, 120, 121, 119, [], [[100.4, 1.0]]), ("s", "delist", 6, 0, 0, 0, [], []),
    ]
    try:
        got = drain(state.live_books(feed(spark, tmp_path, rows, LIVE, 6)), tmp_path, "update")
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    steps = {(r.state, r.u, r.best_bid, r.best_ask, r.reason) for r in got}
    assert ("Initializing", None, None, None, None) in steps and ("Live", 110, 99.5, 101.0, None) in steps
    assert ("Live", 112, 99.0, 100.5, None) in steps and ("Live", 121, 99.0, 100.4, "gap") in steps and ("Initializing", None, None, None, "delisted") in steps
    assert F is not None


def test_live_books_forget_idle_symbols(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = [
        ("s", "snapshot", 3, 100, 100, 0, [[99.0, 1.0], [98.0, 1.0]], [[101.0, 1.0]]), ("s", "diff", 4, 101, 101, 100, [[99.0, 0.0]], []),
        ("t", "diff", 5, 5, 5, 4, [], []), ("s", "diff", 6, 102, 102, 101, [], [[100.5, 1.0]]),
    ]
    try:
        kept = drain(state.live_books(feed(spark, tmp_path, rows, LIVE, 4)), tmp_path, "update")
        late = tmp_path / "late"
        late.mkdir()
        gone = drain(state.live_books(feed(spark, late, rows, LIVE, 4), idle_ms=1), late, "update")
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    ends = {r.u: (r.best_bid, r.best_ask, r.bids, r.asks) for r in kept if r.symbol == "s"}
    assert ends[101] == (98.0, 101.0, 1, 1) and ends[102] == (98.0, 100.5, 1, 2) and not any(r.reason == "idle" for r in kept)
    assert all(r.state != "Live" for r in gone) and any(r.reason == "idle" for r in gone)


def rocks(spark, run):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return run()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


@pytest.mark.parametrize("files", [1, 3])
def test_ring_dedup_equals_fifo(spark, tmp_path, files):
    rng = random.Random(4)
    rows = [(s, i, i, rng.randrange(25)) for i in range(90) for s in "st"]
    want = []
    for s in "st":
        seen = []
        for _, _, i, x in (r for r in rows if r[0] == s):
            if x not in seen:
                want.append((s, i))
                seen = (seen + [x])[-10:]
    got = rocks(spark, lambda: drain(state.dedup_ring(feed(spark, tmp_path, rows, TRADE, files), window=10), tmp_path))
    assert sorted((r.symbol, r.seq) for r in got) == sorted(want)


@pytest.mark.parametrize("high", [True, False])
def test_pages_hold_a_side(high):
    """Random writes and trims over stored pages, each batch with a directory of its own, against a plain dictionary."""
    rng, store, directory, plain = random.Random(6), {}, "[]", {}
    for _ in range(150):
        reads = []
        side = Pages(high, json.loads(directory), lambda n: reads.append(n) or dict(store[n]), size=8)
        touched = 0
        for _ in range(rng.randint(1, 6)):
            price, qty = float(rng.randint(0, 400)), float(rng.choice([0, 1, 2, 3]))
            side.put(price, qty)
            touched += 1
            if qty:
                plain[price] = qty
            else:
                plain.pop(price, None)
        side.trim(120)
        for price in sorted(plain, reverse=high)[120:]:
            del plain[price]
        assert len(side) == len(plain) and side.best == (max if high else min)(plain, default=None)
        assert len(reads) <= touched + 2  # a page a level, one for the best, one for the trim
        for n in side.gone:
            store.pop(n, None)
        store |= {n: dict(side.page(n)) for n in side.changed}
        directory = json.dumps(side.directory)
        assert {p: q for n, _, _ in side.directory for p, q in store[n].items()} == plain


def test_deep_books_equal_a_plain_one(spark, tmp_path):
    rng = random.Random(9)
    level = lambda lo: [[float(lo + rng.randint(0, 60)), float(rng.choice([0, 1, 2]))] for _ in range(rng.randint(0, 4))]
    rows = [("s", "snapshot", 1, 100, 100, 0, [[float(p), 1.0] for p in range(30, 90)], [[float(p), 1.0] for p in range(100, 160)])]
    rows += [("s", "diff", 2 + i, 101 + i, 101 + i, 100 + i, level(30), level(100)) for i in range(60)]
    plain = Sides()
    for _, _, _, _, _, _, bids, asks in rows:
        for side, levels in (("bid", bids), ("ask", asks)):
            for p, q in levels:
                plain.put(side, p, q)
        plain.trim(40)
        plain.best = {"bid": max(plain.levels["bid"], default=None), "ask": min(plain.levels["ask"], default=None)}
    got = rocks(spark, lambda: drain(state.live_books(feed(spark, tmp_path, rows, LIVE, 5), depth=40, page=8), tmp_path, "update"))
    last = max(got, key=lambda r: r.u)
    assert (last.u, last.best_bid, last.best_ask, last.bids, last.asks) == (160, plain.best["bid"], plain.best["ask"], len(plain.levels["bid"]), len(plain.levels["ask"]))


def test_waiting_diffs_expire(spark, tmp_path):
    """A diff that waited longer than it may is gone when the snapshot comes, though no other diff came since."""
    rows = [("s", "diff", 2, 101, 110, 100, [[99.5, 2.0]], []), ("s", "snapshot", 3, 100, 100, 0, [[99.0, 1.0]], [[101.0, 1.0]])]
    ends = []
    for ttl in (60_000, 1):
        folder = tmp_path / str(ttl)
        folder.mkdir()
        got = rocks(spark, lambda: drain(state.live_books(feed(spark, folder, rows, LIVE, 2), ttl_ms=ttl), folder, "update"))  # noqa: B023
        ends.append(sorted((r.state, r.u) for r in got if r.u is not None))
    assert ends == [[("Live", 110)], [("Syncing", 100)]]
