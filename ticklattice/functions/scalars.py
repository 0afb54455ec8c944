"""Scalar functions over columns; all of them stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DAY, HOUR

#: Instants outside these bounds (2015-01-01 to 2100-01-01) are taken for typing errors.
MIN_MS, MAX_MS = 1_420_070_400_000, 4_102_444_800_000


def norm_symbol(c: Column) -> Column:
    return F.lower(c)


def to_ms(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp column with or without a zone (read as UTC)."""
    return F.unix_millis(ts.cast("timestamp"))


def iso_utc(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def parse_iso(c: Column) -> Column:
    """Milliseconds of ISO-8601 text with `Z` or an offset; more than six fractional digits are cut; NULL if it doesn't parse."""
    return F.unix_millis(F.try_to_timestamp(F.regexp_replace(F.trim(c), r"(\.\d{6})\d+", "$1")))


def parse_instant(c: Column) -> Column:
    """Milliseconds of text that holds epoch seconds, epoch milliseconds or ISO-8601; NULL outside 2015..2100."""
    number = F.when(c.rlike(r"^\d{1,13}$"), c).try_cast("bigint")
    ms = F.when(number.isNotNull(), F.when(number < 100_000_000_000, number * 1000).otherwise(number)).otherwise(F.when(c.rlike("[-:T]"), parse_iso(c)))
    return F.when(ms.between(MIN_MS, MAX_MS), ms)


def aggressor(buyer_is_maker: Column) -> Column:
    return F.when(buyer_is_maker, "sell").otherwise("buy")


def flag(c: Column) -> Column:
    return c.cast("int")


def num(c: Column) -> Column:
    """DOUBLE of text or a number; NULL for what doesn't parse, NaN and infinities (they fail every numeric check)."""
    x = c.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def fmt12(c: Column) -> Column:
    """Twelve fixed decimals; text that doesn't parse stays as it is."""
    return F.when(c.try_cast("double").isNotNull(), F.format_string("%.12f", c.try_cast("double"))).otherwise(c.cast("string"))


def notional(price: Column, quantity: Column) -> Column:
    return price * quantity


def shares(ratio: Column) -> tuple[Column, Column]:
    """Long and short share of a long/short ratio; a missing ratio counts as 1."""
    r = F.coalesce(ratio, F.lit(1.0))
    whole = F.nullif(1 + r, F.lit(0.0))
    return r / whole, 1 / whole


def base_asset(c: Column) -> Column:
    """The asset without its lot multiplier, longest prefix first."""
    return F.regexp_replace(c, r"^(1000000|10000|1000)(?=.)", "")


LEVELS = "array<array<string>>"


def levels(json: Column) -> Column:
    """Level array `[["price","qty"],...]` as array of (price, qty) doubles."""
    return F.transform(F.from_json(json, LEVELS), lambda x: F.struct(F.get(x, F.lit(0)).try_cast("double").alias("price"), F.get(x, F.lit(1)).try_cast("double").alias("qty")))


def levels_json(pairs: Column) -> Column:
    return F.to_json(pairs)


def mid(bid: Column, ask: Column, digits: int | None = 8) -> Column:
    m = (bid + ask) / 2
    return m if digits is None else F.bround(m, digits)


def spread(bid: Column, ask: Column, digits: int | None = 8) -> Column:
    return ask - bid if digits is None else F.bround(ask - bid, digits)


def day_of(ms: Column) -> Column:
    return F.to_date(F.timestamp_millis(ms))


def bucket(ms: Column, width: int) -> Column:
    """Start of the interval of `width` milliseconds that holds ms."""
    return ms - F.pmod(ms, F.lit(width))


def partition_parts(ms: Column) -> dict[str, Column]:
    """date, hour, next_hour: the parts that name a row's partition."""
    hour = F.floor(F.pmod(ms, F.lit(DAY)) / HOUR).cast("int")
    return {"date": F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd"), "hour": hour, "next_hour": F.pmod(hour + 1, F.lit(24)).cast("int")}


def partition_path(lane: Column, symbol: Column, ms: Column) -> Column:
    """Relative path of a row's daily file."""
    date = partition_parts(ms)["date"]
    return F.concat(lane, F.lit("/"), symbol, F.lit("/"), date, F.lit("/"), symbol, F.lit("_"), lane, F.lit("_"), date, F.lit(".csv"))


def file_hour(name: Column) -> Column:
    """Start (ms) of the hour that an hourly file's name gives; NULL for other names."""
    part = lambda i: F.regexp_extract(name, r"_(\d{4}-\d{2}-\d{2})_(\d{2})00-to-", i)
    return F.unix_millis(F.try_to_timestamp(F.concat(part(1), F.lit(" "), part(2), F.lit(":00:00"))))


def close_to(a: Column, b: Column, absolute: float, relative: float) -> Column:
    """Whether a is within the larger of the absolute and the relative tolerance of b."""
    return F.abs(a - b) <= F.greatest(F.lit(absolute), relative * F.abs(b))


def valid_symbol(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^[A-Za-z0-9]{1,24}$"), F.lit(False))


def valid_date(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False))


def endpoint_weight(url: Column) -> Column:
    """Request weight: of a depth request by its limit (50 if it names none), else 1."""
    limit = F.coalesce(F.regexp_extract(url, r"limit=(\d+)", 1).try_cast("bigint"), F.lit(50))
    by_limit = F.when(limit <= 50, 2).when(limit <= 100, 5).when(limit <= 500, 10).otherwise(20)
    return F.when(F.contains(url, F.lit("/fapi/v1/depth")), by_limit).otherwise(1)


#: The class of a request and the parts of a URL that name it; the first match counts.
ENDPOINTS = {
    "premium_index_klines": ("premiumIndexKlines",),
    "funding_rates": ("premiumIndex",),
    "open_interest": ("openInterest",),
    "taker_buy_sell_ratio": ("takerlongshortRatio",),
    "long_short_ratio": ("globalLongShortAccountRatio", "topLongShortAccountRatio", "topLongShortPositionRatio"),
    "mark_price_klines": ("markPriceKlines",),
    "index_price_klines": ("indexPriceKlines",),
    "orderbooks": ("depth",),
    "exchange_info": ("exchangeInfo",),
}


def classify_request(url: Column) -> Column:
    """Struct of endpoint class (`unknown` for others), symbol (`ALL` where the URL names none) and weight."""
    kind = F.lit("unknown")
    for name, parts in reversed(ENDPOINTS.items()):
        kind = F.when(url.rlike("|".join(parts)), name).otherwise(kind)
    symbol = F.when(F.contains(url, F.lit("symbol=")), F.regexp_extract(url, r"symbol=([^&]*)", 1)).otherwise("ALL")
    return F.struct(kind.alias("endpoint"), symbol.alias("symbol"), endpoint_weight(url).alias("weight"))
