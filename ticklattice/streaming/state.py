"""Stateful operators keyed by symbol; each takes a streaming DataFrame and keeps bounded state per key."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .pages import Pages


def dedup_trades(trades: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drops repeats of (symbol, trade_id) within the watermark; state is bounded by time."""
    timed = trades.withColumn("_ts", F.timestamp_millis("timestamp_ms")).withWatermark("_ts", delay)
    return timed.dropDuplicatesWithinWatermark(["symbol", "trade_id"]).drop("_ts")


def _keyed(df: DataFrame, keys: list[str], step, schema: str, state: str, idle_ms: int | None) -> DataFrame:
    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout
    return df.groupBy(*keys).applyInPandasWithState(step, schema, state, "append", timeout)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def dedup_fifo(trades: DataFrame, window: int = 5000, idle_ms: int = 3_600_000, order: str = "seq") -> DataFrame:
    """Drops trades whose id is among the symbol's last `window` different ids; an idle symbol is forgotten."""

    def step(key: Any, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(batches).sort_values(order, kind="stable")
        known = dict.fromkeys(json.loads(state.get[0]) if state.exists else [])
        keep = []
        for i in rows["trade_id"].tolist():
            keep.append(i not in known)
            if i not in known:
                known[i] = None
                if len(known) > window:
                    del known[next(iter(known))]
        state.update((json.dumps(list(known)),))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        yield rows[keep]

    return _keyed(trades, ["symbol"], step, _ddl(trades), "ids STRING", idle_ms)


class RingProcessor(StatefulProcessor):
    """Keeps rows whose id is not among the key's last `window` different ids. Ids have a slot of a ring: a new one takes the oldest
    one's, so a row costs a look for its id, and a new id two writes and a removal, however large the window is."""

    def __init__(self, columns: list[str], window: int, idle_ms: int, id_col: str, order: str):
        self.columns, self.window, self.idle_ms, self.id_col, self.order = columns, window, idle_ms, id_col, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n BIGINT")
        self.slots = handle.getMapState("slots", "id BIGINT", "slot BIGINT")
        self.ring = handle.getMapState("ring", "slot BIGINT", "id BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        n = self.count.get()[0] if self.count.exists() else 0
        keep, known = [], {}
        for i in frame[self.id_col].tolist():
            if i not in known:
                known[i] = self.slots.containsKey((i,))
            keep.append(not known[i])
            if not known[i]:
                slot = n % self.window
                if n >= self.window:
                    old = self.ring.getValue((slot,))[0]
                    self.slots.removeKey((old,))
                    known[old] = False
                self.ring.updateValue((slot,), (i,))
                self.slots.updateValue((i,), (slot,))
                known[i] = True
                n += 1
        self.count.update((n,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if self.idle_ms:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield frame[keep][self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.count.clear(), self.slots.clear(), self.ring.clear()
        yield pd.DataFrame([], columns=self.columns)

    def close(self) -> None:
        pass


def dedup_ring(trades: DataFrame, window: int = 5000, idle_ms: int = 3_600_000, order: str = "seq") -> DataFrame:
    """As dedup_fifo, with a ring in state instead of a list that each batch rewrites; needs the RocksDB state store."""
    return trades.groupBy("symbol").transformWithStateInPandas(RingProcessor(trades.columns, window, idle_ms, "trade_id", order), _ddl(trades), "append", "ProcessingTime")


def new_buckets(df: DataFrame, keys: list[str], order: str = "seq", ts: str = "timestamp_ms") -> DataFrame:
    """Rows whose bucket is later than any that their key has had."""

    def step(key: Any, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(batches).sort_values(order, kind="stable")
        mark = state.get[0] if state.exists else None
        before = rows[ts].cummax().shift()
        if mark is not None:
            before = before.fillna(mark).clip(lower=mark)
        top = int(rows[ts].max())
        state.update((top if mark is None else max(mark, top),))
        yield rows[before.isna() | (rows[ts] > before)]

    return _keyed(df, keys, step, _ddl(df), "mark BIGINT", None)


def lifecycle(cycles: DataFrame, strikes: int = 2, most_lost: float = 0.1) -> DataFrame:
    """(exchange, cycle, symbol, change) of discoveries (exchange, cycle, symbols array): a symbol is added at once and removed at
    its second absence in a row; a discovery that lost over `most_lost` of the tracked symbols is skipped."""

    def step(key: Any, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tracked: dict[str, int] = json.loads(state.get[0]) if state.exists else {}
        out = []
        rows = pd.concat(batches).sort_values("cycle", kind="stable")
        for cycle, symbols in zip(rows["cycle"].tolist(), rows["symbols"], strict=True):
            now = {s.lower() for s in symbols}
            if tracked and len(now) < len(tracked) * (1 - most_lost):
                continue
            for s in sorted(now - tracked.keys()):
                out.append((*key, cycle, s, "added"))
            for s in sorted(tracked.keys() - now):
                tracked[s] += 1
                if tracked[s] >= strikes:
                    del tracked[s]
                    out.append((*key, cycle, s, "removed"))
            tracked |= dict.fromkeys(now, 0)
        state.update((json.dumps(tracked),))
        yield pd.DataFrame(out, columns=["exchange", "cycle", "symbol", "change"])

    return _keyed(cycles, ["exchange"], step, "exchange STRING, cycle BIGINT, symbol STRING, change STRING", "tracked STRING", None)


def freshness(rows: DataFrame, delay: str = "1 minute") -> DataFrame:
    """Newest time of each lane and symbol, updated as rows arrive (use with output mode `update`)."""
    return rows.groupBy("lane", "symbol").agg(F.max("timestamp_ms").alias("last_ms"))


BOOK_OUT = "symbol STRING, state STRING, u BIGINT, best_bid DOUBLE, best_ask DOUBLE, bids BIGINT, asks BIGINT, reason STRING"


class BookProcessor(StatefulProcessor):
    """Live books: Initializing -> Syncing (a snapshot came) -> Live (a diff continues it).

    Input rows: (symbol, kind, timestamp_ms, first_u, u, pu, bids, asks) of kind `snapshot`, `diff` or `delist`, levels as arrays
    of [price, qty]. A live book goes on over gaps, which are reported. A symbol without rows for two hours is forgotten by a timer
    (reason `idle`); `delist` clears it at once.

    Levels are stored in pages of neighbouring prices with a directory (see Pages): a batch reads and writes the pages that its diffs
    touch and those of the best prices, however deep the book is. Diffs that wait for a snapshot, the last `buffer` of them and of the
    last `span_ms`, are appended one by one and expire by themselves after `ttl_ms`; they are read only while a snapshot is to be bridged.
    """

    def __init__(self, depth: int = 1000, buffer: int = 1024, span_ms: int = 60_000, idle_ms: int = 7_200_000, ttl_ms: int | None = None, page: int = 64):
        self.depth, self.buffer, self.span_ms, self.idle_ms, self.page = depth, buffer, span_ms, idle_ms, page
        self.ttl_ms = span_ms if ttl_ms is None else ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.meta = handle.getValueState("meta", "state STRING, u BIGINT, seen BIGINT, bids STRING, asks STRING, waiting BIGINT")
        self.pages = handle.getMapState("pages", "side STRING, page BIGINT", "levels STRING")
        self.waiting = handle.getListState("waiting", "timestamp_ms BIGINT, first_u BIGINT, u BIGINT, pu BIGINT, bids STRING, asks STRING", ttlDurationMs=self.ttl_ms)

    def _side(self, side: str, directory: str | None) -> Pages:
        read = lambda number: {p: q for p, q in json.loads(self.pages.getValue((side, number))[0])}
        return Pages(side == "bid", json.loads(directory or "[]"), read, self.page)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        symbol, now = key[0], timerValues.getCurrentProcessingTimeInMs()
        state, at, seen, bids, asks, stored = self.meta.get() if self.meta.exists() else ("Initializing", None, now, None, None, 0)
        if now - seen >= self.idle_ms:
            self._forget()
            state, at, bids, asks, stored = "Initializing", None, None, None, 0
        book = {"bid": self._side("bid", bids), "ask": self._side("ask", asks)}
        held: list[tuple] | None = None  # the stored waiting diffs, once they are needed
        fresh: list[tuple] = []  # those of this batch
        reason = None

        def buffered() -> list[tuple]:
            nonlocal held
            if held is None:
                held = [tuple(x) for x in self.waiting.get()] if stored else []
            every = held + fresh
            newest = max((w[0] for w in every), default=0)
            return [w for w in every if w[0] >= newest - self.span_ms][-self.buffer :]

        frame = pd.concat(list(rows)).sort_values(["timestamp_ms", "u"], kind="stable")
        for r in frame.itertuples():
            if r.kind == "delist":
                self._forget()
                book = {"bid": self._side("bid", None), "ask": self._side("ask", None)}
                state, at, held, fresh, stored, reason = "Initializing", None, [], [], 0, "delisted"
            elif r.kind == "snapshot":
                if state != "Live":
                    for side in book.values():
                        side.clear()
                    at, state = int(r.u), "Syncing"
                    self._apply(book, r.bids, r.asks)
            elif state == "Live":
                if r.u > at:
                    reason = "gap" if r.pu != at else reason
                    self._apply(book, r.bids, r.asks)
                    self._trim(book)
                    at = int(r.u)
            else:
                fresh.append((int(r.timestamp_ms), int(r.first_u), int(r.u), int(r.pu), _text(r.bids), _text(r.asks)))
            if state == "Syncing":
                state, at = self._attach(book, at, buffered())
                if state == "Live":
                    held, fresh = [], []
                    if stored:
                        self.waiting.clear()
                        stored = 0
        if stored + len(fresh) > 2 * self.buffer:
            kept = buffered()
            self.waiting.put(kept)
            stored = len(kept)
        elif fresh:
            self.waiting.appendList(fresh)
            stored += len(fresh)
        self._save(state, at, book, stored, now)
        yield pd.DataFrame([(symbol, state, at, book["bid"].best, book["ask"].best, len(book["bid"]), len(book["ask"]), reason)], columns=[c.split()[0] for c in BOOK_OUT.split(", ")])

    def _attach(self, book: dict[str, Pages], at: int, waiting: list[tuple]) -> tuple[str, int]:
        ordered = sorted({w[2]: w for w in sorted(waiting, key=lambda w: w[0])}.values(), key=lambda w: w[2])
        start = next((i for i, w in enumerate(ordered) if w[2] > at and (w[1] <= at + 1 or w[3] <= at < w[1])), None)
        if start is None:
            return "Syncing", at
        for w in ordered[start:]:
            self._apply(book, json.loads(w[4]), json.loads(w[5]))
            self._trim(book)
            at = w[2]
        return "Live", at

    @staticmethod
    def _apply(book: dict[str, Pages], bids, asks) -> None:
        for side, levels in (("bid", bids), ("ask", asks)):
            for price, qty in levels if levels is not None else []:
                book[side].put(float(price), float(qty))

    def _trim(self, book: dict[str, Pages]) -> None:
        for side in book.values():
            side.trim(self.depth)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._forget()
        yield pd.DataFrame([(key[0], "Initializing", None, None, None, 0, 0, "idle")], columns=[c.split()[0] for c in BOOK_OUT.split(", ")])

    def _forget(self) -> None:
        self.meta.clear(), self.pages.clear(), self.waiting.clear()

    def _save(self, state: str, at: int | None, book: dict[str, Pages], stored: int, now: int) -> None:
        for name, side in book.items():
            for number in side.gone:
                if self.pages.containsKey((name, number)):
                    self.pages.removeKey((name, number))
            for number in side.changed:
                self.pages.updateValue((name, number), (json.dumps(list(side.page(number).items())),))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if state == "Initializing" and at is None and not stored:
            return
        self.handle.registerTimer(now + self.idle_ms)
        self.meta.update((state, at, now, json.dumps(book["bid"].directory), json.dumps(book["ask"].directory), stored))

    def close(self) -> None:
        pass


def _text(levels) -> str:
    return json.dumps([[float(p), float(q)] for p, q in levels] if levels is not None else [])


def live_books(rows: DataFrame, **options) -> DataFrame:
    """The stream of book states; needs the RocksDB state store."""
    return rows.groupBy("symbol").transformWithStateInPandas(BookProcessor(**options), BOOK_OUT, "update", "ProcessingTime")
