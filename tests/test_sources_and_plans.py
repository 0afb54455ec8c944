import json
import os

import pytest
from pyspark.sql import functions as F

from ticklattice import functions as fn
from ticklattice.operators import filters, joins, windows
from ticklattice.plans import merged_matrix, verify_tree
from ticklattice.schemas import schema
from ticklattice.sources import lanes, messages, sinks

T0 = 1_768_453_200_000
M = 60_000


def one(spark, c, **cols):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()]).select(c).first()[0]


def test_scalars(spark):
    x = F.col("x")
    assert one(spark, fn.iso_utc(x), x=0) == "1970-01-01T00:00:00.000Z"
    assert one(spark, fn.iso_utc(x), x=1700000000123) == "2023-11-14T22:13:20.123Z"
    assert one(spark, fn.parse_iso(x), x="2023-11-14T22:13:20.123456789+00:00") == 1700000000123
    for text, want in (("1700000000", 1700000000000), ("1700000000123", 1700000000123), ("2023-11-14T22:13:20.123Z", 1700000000123), ("0", None), ("9" * 300, None), ("9999-01-01T00:00:00Z", None), ("garbage", None)):
        assert one(spark, fn.parse_instant(x), x=text) == want
    for text, want in (("BTC", "BTC"), ("1000SHIB", "SHIB"), ("10000SATS", "SATS"), ("1000000MOG", "MOG"), ("1INCH", "1INCH")):
        assert one(spark, fn.base_asset(x), x=text) == want
    assert one(spark, fn.partition_path(F.lit("trades"), F.lit("btcusdt"), x), x=1700000000000) == "trades/btcusdt/2023-11-14/btcusdt_trades_2023-11-14.csv"
    assert one(spark, fn.file_hour(x), x="btcusdt_depth_updates_2023-11-14_2200-to-2300.csv") == 1699999200000
    for limit, weight in ((50, 2), (100, 5), (500, 10), (1000, 20)):
        assert one(spark, fn.endpoint_weight(x), x=f"https://x/fapi/v1/depth?symbol=A&limit={limit}") == weight
    assert one(spark, fn.classify_request(x)["endpoint"], x="https://x/premiumIndexKlines?symbol=A") == "premium_index_klines"
    assert one(spark, fn.fmt12(x), x="1.5") == "1.500000000000" and one(spark, fn.fmt12(x), x="n/a") == "n/a"
    assert one(spark, fn.bucket(x, 300_000), x=1762050181298) % 300_000 == 0
    for text, ok in (("btcusdt", True), ("../x", False), ("a/b", False), ("", False)):
        assert one(spark, fn.valid_symbol(x), x=text) == ok
    assert one(spark, fn.valid_date(x), x="2026-01-15") and not one(spark, fn.valid_date(x), x="2026-01-15/..")


def test_selection_limits():
    for bad in ((2, 1, ["a"], ["trades"]), (0, 40 * 86_400_000, ["a"], ["trades"]), (0, 1, [], ["trades"]), (0, 1, ["a"] * 51, ["trades"]), (0, 1, ["a"], ["nope"])):
        with pytest.raises(ValueError):
            filters.check_selection(*bad)


RAW = [
    {"stream": "s", "data": {"e": "depthUpdate", "E": 1, "T": 1, "s": "BTCUSDT", "U": 1, "u": 2, "pu": 0, "b": [["99.5", "0.4"]], "a": []}},
    {"stream": "s", "data": {"e": "aggTrade", "E": 1, "s": "BTCUSDT", "a": 7, "p": "100", "q": "2", "f": 1, "l": 2, "T": 5, "m": True}},
    {"stream": "s", "data": {"e": "kline", "E": 1, "s": "BTCUSDT", "k": {"t": 0, "T": 1, "s": "BTCUSDT", "i": "1m", "o": "1", "h": "2", "l": "1", "c": "2", "v": "3", "q": "4", "n": 5, "x": True, "V": "1", "Q": "1"}}},
    {"stream": "s", "data": {"e": "kline", "E": 1, "s": "BTCUSDT", "k": {"t": 0, "x": False}}},
    {"stream": "s", "data": [{"e": "forceOrder", "E": 1, "o": {"s": "BTCUSDT", "S": "SELL", "p": "100", "q": "2", "T": 9}}, {"e": "forceOrder", "E": 1, "o": {"s": "XUSDT", "S": "BUY", "p": "1", "q": "1", "T": 9}}]},
    {"stream": "s", "data": {"e": "other"}},
]


def test_messages(spark):
    raw = spark.createDataFrame([(json.dumps(r),) for r in RAW] + [("not json",)], "value string")
    routed = messages.route(messages.parse_messages(raw))
    assert {k: v.count() for k, v in routed.items()} == {"depthUpdate": 1, "aggTrade": 1, "kline": 2, "forceOrder": 2, "dropped": 2}
    t = messages.to_trades(routed["aggTrade"]).first()
    assert (t.symbol, t.side, t.is_buyer_maker, t.price, t.trade_id) == ("btcusdt", "sell", 1, 100.0, 7)
    assert messages.to_diffs(routed["depthUpdate"]).first().bids_json == '[["99.5","0.4"]]'
    assert messages.to_klines(routed["kline"]).count() == 1
    universe = spark.createDataFrame([("btcusdt",)], "symbol string")
    assert [(r.side, r.value) for r in messages.to_liquidations(routed["forceOrder"], universe).collect()] == [("sell", 200.0)]
    for lane, df in (("trades", messages.to_trades(routed["aggTrade"])), ("liquidations", messages.to_liquidations(routed["forceOrder"])), ("klines", messages.to_klines(routed["kline"])), ("depth_updates", messages.to_diffs(routed["depthUpdate"]))):
        assert df.columns == schema(lane).names


def test_responses(spark):
    body = {"symbol": "BTCUSDT", "markPrice": "150", "lastFundingRate": "0.0001", "nextFundingTime": 8, "time": 1}
    both = spark.createDataFrame([(json.dumps(body),), (json.dumps([body, body | {"symbol": "XUSDT"}]),)], "body string")
    assert messages.to_funding(both).count() == 3
    gone = spark.createDataFrame([("xusdt",)], "symbol string")
    assert {r.symbol for r in messages.to_funding(both, None, gone).collect()} == {"btcusdt"}
    oi = spark.createDataFrame([("BTCUSDT", "1000", 1), ("NOMARK", "1", 1)], "symbol string, openInterest string, time long")
    premium = spark.createDataFrame([("BTCUSDT", "150")], "symbol string, markPrice string")
    assert [r.oi_value for r in messages.to_open_interest(oi, premium).collect()] == [150000.0]
    ratio = spark.createDataFrame([("BTCUSDT", None, None, "3", 1)], "symbol string, longAccount string, shortAccount string, longShortRatio string, timestamp long")
    assert [(r.ratio_type, r.long_ratio, r.short_ratio) for r in messages.to_long_short(ratio, ratio.limit(0), ratio.limit(0)).collect()] == [("global", 0.75, 0.25)]
    taker = spark.createDataFrame([("BTCUSDT", "1.5", "60", "40", 1)], "symbol string, buySellRatio string, buyVol string, sellVol string, timestamp long")
    assert messages.to_taker(taker).first().buy_sell_ratio == 1.5
    bars = spark.createDataFrame([("BTCUSDT", '[[0,"1","2","1","2"],[60000,"1"]]')], "symbol string, body string")
    assert [r.close for r in messages.to_price_klines(bars, "mark_price_klines").collect()] == [2.0]


def trades(spark, n=10):
    rows = [("binance", "futures", "trades", T0 + i * M, "", "btcusdt", i, "buy", 100.0, 1.0, 0, i, i) for i in range(n)]
    return spark.createDataFrame(rows, schema("trades"))


def test_lake_round_trip(spark, tmp_path):
    df = trades(spark)
    for _ in range(2):
        sinks.write_lane(df, str(tmp_path / "lake"), "trades", "overwrite")
    back = spark.read.parquet(str(tmp_path / "lake/trades"))
    assert back.count() == 10 and "date" in back.columns
    folder = tmp_path / "csv/trades/btcusdt/2026-01-15"
    os.makedirs(folder)
    df.toPandas().to_csv(folder / "btcusdt_trades_2026-01-15.csv", index=False)
    found = lanes.read_lane(spark, str(tmp_path / "csv"), "trades", ["btcusdt"], ["2026-01-15"])
    assert [(r.trade_id, r.date, r.file_name) for r in found.orderBy("seq").collect()] == [(i, "2026-01-15", "btcusdt_trades_2026-01-15.csv") for i in range(10)]
    (folder / "empty.csv").write_text("")
    (folder / "ragged.csv").write_text(",".join(schema("trades").names) + "\n1,2\n")
    report = verify_tree({"trades": lanes.read_lines(spark, str(tmp_path / "csv"), "trades")}, {"trades": schema("trades").names}, {})
    assert sorted((os.path.basename(r.file_name), r.issue) for r in report["issues"].collect()) == [("empty.csv", "empty"), ("ragged.csv", "row_width")]
    diffs = spark.createDataFrame([("s", T0 + i, 10 - i) for i in range(5)], "symbol string, timestamp_ms long, last_update_id long")
    sinks.write_diffs(diffs, str(tmp_path / "lake"))
    assert [r.last_update_id for r in spark.read.parquet(str(tmp_path / "lake/depth_updates")).collect()] == [6, 7, 8, 9, 10]


def test_json_files(spark, tmp_path):
    (tmp_path / "now.json").write_text(json.dumps({"timestamp": 100.0, "messages_total": 5}))
    (tmp_path / "broken.json").write_text('{"timestamp": 1')
    assert [r.live for r in lanes.is_live(lanes.read_heartbeats(spark, str(tmp_path / "now.json")), 110).collect()] == [True]
    assert [r.live for r in lanes.is_live(lanes.read_heartbeats(spark, str(tmp_path / "now.json")), 120).collect()] == [False]
    assert not any(r.live for r in lanes.is_live(lanes.read_heartbeats(spark, str(tmp_path / "broken.json")), 1).collect())
    (tmp_path / "btcusdt.json").write_text(json.dumps([{"type": "gap", "timestamp": 1.5}, {"type": "re_anchor", "reason": "x", "timestamp": 2.5}]))
    assert [(r.symbol, r.type) for r in lanes.read_gap_events(spark, str(tmp_path / "btcusdt.json")).orderBy("timestamp").collect()] == [("btcusdt", "gap"), ("btcusdt", "re_anchor")]
    (tmp_path / "x.log").write_text("2026 INFO a\n  more\n2026 WARN b\n  trace\n")
    logs = lanes.read_logs(spark, str(tmp_path / "x.log"))
    assert [r.line for r in windows.filter_logs(logs, "WARN").orderBy("seq").collect()] == ["2026 WARN b", "  trace"]


def test_bundle_and_matrix(spark, tmp_path):
    lane = {"trades": trades(spark)}
    parts = sinks.export_bundle(lane, ["BTCUSDT"], ["trades"], T0, T0 + 4 * M, str(tmp_path / "out"))
    assert parts["trades"].count() == 5
    with pytest.raises(ValueError):
        sinks.export_bundle(lane, ["ethusdt"], ["trades"], T0, T0 + M)
    got = merged_matrix(spark, {"trades": trades(spark, 5)}, ["btcusdt"], T0, T0 + 4 * M)
    assert got.columns == ["timestamp_ms", "datetime_utc", "trade_count", "trade_vwap"] and [r.trade_count for r in got.collect()] == [1] * 5
    two = trades(spark, 5).unionByName(trades(spark, 5).withColumn("symbol", F.lit("eth")))
    wide = merged_matrix(spark, {"trades": two}, ["btcusdt", "eth"], T0, T0 + 4 * M)
    assert "eth_trade_vwap" in wide.columns and wide.count() == 5
    sinks.write_matrix(wide, str(tmp_path / "matrix"))
    assert spark.read.option("header", True).csv(str(tmp_path / "matrix")).count() == 5
    with pytest.raises(ValueError):
        merged_matrix(spark, lane, ["nobody"], T0, T0 + M)


def test_asof_ties_and_tolerance(spark):
    left = spark.createDataFrame([("s", 100), ("s", 200), ("s", 50), ("t", 100)], "symbol string, timestamp_ms long")
    right = spark.createDataFrame([("s", 100, 0, 1.0), ("s", 100, 1, 2.0), ("s", 60, 2, 0.5)], "symbol string, timestamp_ms long, seq long, v double")
    for ties, want in (("last", 2.0), ("first", 1.0)):
        for tolerance, late in ((None, want), (100, want), (99, None)):
            got = {(r.symbol, r.timestamp_ms): r.v for r in joins.asof_join(left, right, {"v": "v"}, tolerance, ties).collect()}
            assert got == {("s", 100): want, ("s", 200): late, ("s", 50): None, ("t", 100): None}
