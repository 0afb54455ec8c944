"""Lanes: one append-only row family per symbol and UTC day, each with a fixed schema."""

from __future__ import annotations

from pyspark.sql.types import StructType

PREFIX = "exchange STRING, market STRING, datatype STRING, timestamp_ms BIGINT, datetime_utc STRING, symbol STRING"
BAR = "open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE"

#: The columns of each lane after the shared prefix.
OWN_COLUMNS = {
    "depth_updates": "first_update_id BIGINT, last_update_id BIGINT, prev_update_id BIGINT, bids_json STRING, asks_json STRING",
    "depth_snapshot": "event_type STRING, side STRING, price DOUBLE, quantity DOUBLE, last_update_id BIGINT",
    "trades": "trade_id BIGINT, side STRING, price DOUBLE, quantity DOUBLE, is_buyer_maker INT, first_update_id BIGINT, last_update_id BIGINT",
    "klines": BAR + ", volume DOUBLE, quote_volume DOUBLE, trade_count BIGINT, taker_buy_base DOUBLE, taker_buy_quote DOUBLE",
    "liquidations": "side STRING, price DOUBLE, quantity DOUBLE, value DOUBLE",
    "funding_rates": "funding_rate DOUBLE, next_funding_time BIGINT",
    "open_interest": "mark_price DOUBLE, open_interest DOUBLE, oi_value DOUBLE",
    "long_short_ratio": "period STRING, ratio_type STRING, long_ratio DOUBLE, short_ratio DOUBLE, long_short_ratio DOUBLE",
    "taker_buy_sell_ratio": "period STRING, buy_volume DOUBLE, sell_volume DOUBLE, buy_sell_ratio DOUBLE",
    "mark_price_klines": BAR,
    "index_price_klines": BAR,
    "premium_index_klines": BAR,
}
LANES = tuple(OWN_COLUMNS)
RATIO_TYPES = ("global", "top_trader_account", "top_trader_position")
#: Directory of a lane in the CSV tree; both depth lanes share one.
DIRECTORY = {lane: "orderbooks" if lane.startswith("depth_") else lane for lane in LANES}
MINUTE, HOUR, DAY = 60_000, 3_600_000, 86_400_000


def ddl(lane: str) -> str:
    """The lane's columns as text, which needs no session."""
    if lane not in OWN_COLUMNS:
        raise ValueError(f"unknown lane {lane!r}")
    return f"{PREFIX}, {OWN_COLUMNS[lane]}"


def schema(lane: str, as_text: bool = False) -> StructType:
    """The lane's schema; as_text gives every column as STRING, for quality checks on raw values."""
    found = StructType.fromDDL(ddl(lane))
    return StructType.fromDDL(", ".join(f"{f.name} STRING" for f in found)) if as_text else found
