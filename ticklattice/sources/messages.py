"""Wire messages to lane rows; each function takes a batch or a streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import aggressor, flag, iso_utc, levels_json, norm_symbol, notional, shares
from ..operators.filters import drop_delisted, in_universe

#: The messages' fields.
DEPTH = "E BIGINT, T BIGINT, s STRING, U BIGINT, u BIGINT, pu BIGINT, b ARRAY<ARRAY<STRING>>, a ARRAY<ARRAY<STRING>>"
AGG_TRADE = "E BIGINT, s STRING, a BIGINT, p STRING, q STRING, f BIGINT, l BIGINT, T BIGINT, m BOOLEAN"
KLINE = "E BIGINT, s STRING, k STRUCT<t: BIGINT, T: BIGINT, s: STRING, i: STRING, o: STRING, h: STRING, l: STRING, c: STRING, v: STRING, q: STRING, n: BIGINT, x: BOOLEAN, V: STRING, Q: STRING>"
FORCE_ORDER = "E BIGINT, o STRUCT<s: STRING, S: STRING, p: STRING, q: STRING, T: BIGINT>"
PREMIUM = "symbol STRING, markPrice STRING, lastFundingRate STRING, nextFundingTime BIGINT, time BIGINT"
#: Names for fields that differ in case only, by place.
DISTINCT = {
    "depthUpdate": "E: BIGINT, T: BIGINT, s: STRING, first_u: BIGINT, last_u: BIGINT, prev_u: BIGINT, b: ARRAY<ARRAY<STRING>>, a: ARRAY<ARRAY<STRING>>",
    "kline": "E: BIGINT, s: STRING, k: STRUCT<open_ms: BIGINT, close_ms: BIGINT, s: STRING, i: STRING, o: STRING, h: STRING, l: STRING, c: STRING, v: STRING, q: STRING, n: BIGINT, x: BOOLEAN, taker_base: STRING, taker_quote: STRING>",
    "forceOrder": "E: BIGINT, o: STRUCT<symbol: STRING, side: STRING, p: STRING, q: STRING, T: BIGINT>",
}
EVENT_TYPES = {"depthUpdate": DEPTH, "aggTrade": AGG_TRADE, "kline": KLINE, "forceOrder": FORCE_ORDER}
EXCHANGE, MARKET = "binance", "futures"


def parse_messages(raw: DataFrame) -> DataFrame:
    """(event_type, payload, received_at) of envelopes `{stream, data}` in `value`; a data array fans out into one row each;
    event_type is NULL for text that is no such envelope."""
    data = F.get_json_object("value", "$.data")
    each = F.when(F.startswith(F.ltrim(data), F.lit("[")), F.from_json(data, "array<string>")).otherwise(F.array(data))
    at = F.col("received_at") if "received_at" in raw.columns else F.lit(None).cast("bigint")
    rows = raw.select(F.explode_outer(each).alias("payload"), at.alias("received_at"))
    return rows.select(F.get_json_object("payload", "$.e").alias("event_type"), "payload", "received_at")


def typed(messages: DataFrame, event_type: str) -> DataFrame:
    rows = messages.filter(F.col("event_type") == event_type)
    message = F.from_json("payload", EVENT_TYPES[event_type])
    if event_type in DISTINCT:
        message = message.cast(f"STRUCT<{DISTINCT[event_type]}>")
    return rows.select(message.alias("m"), "received_at").select("m.*", "received_at")


def route(messages: DataFrame) -> dict[str, DataFrame]:
    """One typed DataFrame per known event type, and the others under `dropped`."""
    out = {kind: typed(messages, kind) for kind in EVENT_TYPES}
    known = F.coalesce(F.col("event_type").isin(*EVENT_TYPES), F.lit(False))
    return out | {"dropped": messages.filter(~known)}


def _row(df: DataFrame, lane: str, ts: Column, symbol: Column, **own: Column) -> DataFrame:
    return df.select(
        F.lit(EXCHANGE).alias("exchange"), F.lit(MARKET).alias("market"), F.lit(lane).alias("datatype"), ts.alias("timestamp_ms"), iso_utc(ts).alias("datetime_utc"), norm_symbol(symbol).alias("symbol"),
        *[c.alias(n) for n, c in own.items()],
    )


def number(c: str) -> Column:
    return F.col(c).try_cast("double")


def to_diffs(df: DataFrame) -> DataFrame:
    c = F.col
    return _row(df, "depth_updates", c("E"), c("s"), first_update_id=c("first_u"), last_update_id=c("last_u"), prev_update_id=c("prev_u"), bids_json=levels_json(c("b")), asks_json=levels_json(c("a")))


def to_trades(df: DataFrame) -> DataFrame:
    c = F.col
    return _row(df, "trades", c("T"), c("s"), trade_id=c("a"), side=aggressor(c("m")), price=number("p"), quantity=number("q"), is_buyer_maker=flag(c("m")), first_update_id=c("f"), last_update_id=c("l"))


def to_klines(df: DataFrame) -> DataFrame:
    """Rows of closed bars."""
    c, n = F.col, lambda x: number(f"k.{x}")
    closed = df.filter("k.x")
    return _row(closed, "klines", c("k.open_ms"), c("s"), open=n("o"), high=n("h"), low=n("l"), close=n("c"), volume=n("v"), quote_volume=n("q"), trade_count=c("k.n"), taker_buy_base=n("taker_base"), taker_buy_quote=n("taker_quote"))


def to_liquidations(df: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """Rows of symbols in the universe (symbol), with value = price * quantity."""
    c, n = F.col, lambda x: number(f"o.{x}")
    rows = _row(df, "liquidations", c("o.T"), c("o.symbol"), side=F.lower("o.side"), price=n("p"), quantity=n("q"), value=notional(n("p"), n("q")))
    return rows if universe is None else in_universe(rows, universe)


def objects(df: DataFrame, schema: str, col: str = "body") -> DataFrame:
    """Fields of a response that is one object or an array of them, and the other columns."""
    many = F.startswith(F.ltrim(F.col(col)), F.lit("["))
    each = F.when(many, F.from_json(col, f"array<struct<{schema}>>")).otherwise(F.array(F.from_json(col, f"struct<{schema}>")))
    return df.select(*[c for c in df.columns if c != col], F.explode(each).alias("_x")).select(*[c for c in df.columns if c != col], "_x.*")


def to_funding(responses: DataFrame, universe: DataFrame | None = None, delisted: DataFrame | None = None) -> DataFrame:
    fields = ", ".join(x.strip().replace(" ", ": ", 1) for x in PREMIUM.split(","))
    c = F.col
    rows = _row(objects(responses, fields), "funding_rates", c("time"), c("symbol"), funding_rate=number("lastFundingRate"), next_funding_time=c("nextFundingTime"))
    rows = rows if universe is None else in_universe(rows, universe)
    return rows if delisted is None else drop_delisted(rows, delisted)


def to_open_interest(oi: DataFrame, premium: DataFrame) -> DataFrame:
    """oi (symbol, openInterest, time) with the mark price of premium (symbol, markPrice) of the same poll; without one, no row."""
    keys = ["symbol"] + (["poll"] if "poll" in oi.columns and "poll" in premium.columns else [])
    met = oi.join(premium.select(*keys, "markPrice"), keys)
    mark, n = number("markPrice"), number("openInterest")
    return _row(met, "open_interest", F.col("time"), F.col("symbol"), mark_price=mark, open_interest=n, oi_value=notional(n, mark))


def to_long_short(global_: DataFrame, account: DataFrame, position: DataFrame, period: str = "5m") -> DataFrame:
    """The three ratio endpoints (symbol, longAccount, shortAccount, longShortRatio, timestamp) as one lane; missing shares come
    from the ratio."""
    out = None
    for kind, df in (("global", global_), ("top_trader_account", account), ("top_trader_position", position)):
        ratio = number("longShortRatio")
        long, short = shares(ratio)
        part = _row(df, "long_short_ratio", F.col("timestamp"), F.col("symbol"), period=F.lit(period), ratio_type=F.lit(kind), long_ratio=F.coalesce(number("longAccount"), long), short_ratio=F.coalesce(number("shortAccount"), short), long_short_ratio=F.coalesce(ratio, F.lit(1.0)))
        out = part if out is None else out.unionByName(part)
    return out


def to_taker(df: DataFrame, period: str = "5m") -> DataFrame:
    return _row(df, "taker_buy_sell_ratio", F.col("timestamp"), F.col("symbol"), period=F.lit(period), buy_volume=number("buyVol"), sell_volume=number("sellVol"), buy_sell_ratio=number("buySellRatio"))


def to_price_klines(responses: DataFrame, lane: str) -> DataFrame:
    """Rows of bar arrays `[[t, o, h, l, c, ...], ...]` in `body`, with the request's symbol; shorter arrays are dropped."""
    bars = responses.select("symbol", F.explode(F.from_json("body", "array<array<string>>")).alias("k")).filter(F.size("k") >= 5)
    at = lambda i: F.element_at("k", i)
    return _row(bars, lane, at(1).try_cast("bigint"), F.col("symbol"), open=at(2).try_cast("double"), high=at(3).try_cast("double"), low=at(4).try_cast("double"), close=at(5).try_cast("double"))
