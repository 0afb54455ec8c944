"""One planted defect per table trips exactly its check."""

import pytest
from pyspark.sql import functions as F

from ticklattice.functions import iso_utc
from ticklattice.operators import quality
from ticklattice.plans import validate

T0 = 1_768_453_200_000
M = 60_000


def bars(spark, rows):
    return spark.createDataFrame([("s", T0 + m * M, o, h, lo, c, v) for m, o, h, lo, c, v in rows], "symbol string, timestamp_ms long, open double, high double, low double, close double, volume double")


def clean(n=5):
    return [(m, 100.0, 101.0, 99.0, 100.5, 10.0) for m in range(n)]


def failures(df, lane):
    return {r["check"]: r["failures"] for r in quality.run_checks(df, lane).collect() if r["failures"]}


def test_bars(spark):
    assert failures(bars(spark, clean()), "klines") == {}
    assert failures(bars(spark, [r for r in clean(7) if r[0] not in (3, 4)]), "klines") == {"missing_minutes": 2}
    assert failures(bars(spark, [*clean(1), (1, 100.0, 98.0, 99.5, 100.5, 10.0)]), "klines") == {"ohlc_bounds": 1}
    assert failures(bars(spark, [*clean(), clean()[2]]), "klines") == {"unique_timestamps": 1}
    assert failures(bars(spark, [*clean(), (5, 100.0, 101.0, 99.0, 100.5, -1.0), (6, 100.0, 101.0, 99.0, 100.5, None), (7, float("nan"), 101.0, 99.0, 100.5, 1.0)]), "klines") == {"volume": 2, "ohlc_bounds": 1}
    stamped = bars(spark, clean()).withColumn("datetime_utc", F.when(F.col("timestamp_ms") == T0, "1999-01-01T00:00:00Z").otherwise(iso_utc(F.col("timestamp_ms"))))
    assert failures(stamped, "klines") == {"datetime": 1}


def trades(spark, rows):
    return spark.createDataFrame([("s", T0 + i * 1000, i, *r) for i, r in enumerate(rows)], "symbol string, timestamp_ms long, seq long, trade_id string, side string, price string, quantity string")


@pytest.mark.parametrize("rows, want", [
    ([("1", "buy", "100", "1"), ("2", "sell", "100", "1")], {}),
    ([("100", "buy", "100", "1"), ("100", "buy", "100", "1")], {"unique_ids": 1}),
    ([("200", "buy", "100", "1"), ("150", "buy", "100", "1")], {"monotone_ids": 1}),
    ([("200", "buy", "100", "1"), ("x", "buy", "100", "1"), ("150", "buy", "100", "1")], {"monotone_ids": 1}),
    ([("1", "Buy", "100", "1"), ("2", "SELL", "100", "1")], {"side": 2}),
    ([("1", "buy", "0", "1"), ("2", "buy", "oops", "1"), ("3", "buy", "NaN", "1")], {"price_qty": 3}),
])
def test_trades(spark, rows, want):
    assert failures(trades(spark, rows), "trades") == want


def lane(spark, ddl, *rows):
    return spark.createDataFrame([("s", T0 + i * M, *r) for i, r in enumerate(rows)], f"symbol string, timestamp_ms long, {ddl}")


def test_other_lanes(spark):
    liq = "side string, price double, quantity double, value double"
    assert failures(lane(spark, liq, ("sell", 100.0, 2.0, 200.0), ("sell", 100.0, 2.0, 350.0)), "liquidations") == {"value": 1}
    assert failures(lane(spark, liq, ("sell", 100.0, 2.0, None), ("sell", 0.0, 2.0, 5.0)), "liquidations") == {"value": 1, "price_qty": 1}
    assert failures(lane(spark, "mark_price double, open_interest double, oi_value double", (150.0, 1000.0, 150000.0), (150.0, 1000.0, 999999.0), (150.0, -1.0, 0.0)), "open_interest") == {"oi_value": 1, "oi": 1}
    assert failures(lane(spark, "funding_rate double", (0.0001,), (3.5,), (float("nan"),)), "funding_rates") == {"rate": 2}
    ratio = "ratio_type string, long_ratio double, short_ratio double, long_short_ratio double"
    three = [(k, 0.66, 0.34, 0.66 / 0.34) for k in ("global", "top_trader_account", "top_trader_position")]
    assert failures(lane(spark, ratio, *three), "long_short_ratio") == {}
    assert failures(lane(spark, ratio, *three[:2]), "long_short_ratio") == {"ratio_types": 1}
    assert failures(lane(spark, ratio, *three, ("global", 0.8, 0.4, 2.0), ("global", 1.4, 0.9, 1.4 / 0.9), ("global", None, None, 1.0)), "long_short_ratio") == {"shares": 2}
    assert failures(lane(spark, "buy_volume double, sell_volume double, buy_sell_ratio double", (60.0, 40.0, 1.5), (60.0, 40.0, 9.9), (60.0, 0.0, 7.0), (-1.0, 4.0, 1.0)), "taker_buy_sell_ratio") == {"ratio": 1, "volumes": 1}


def test_verdicts(spark):
    bad = bars(spark, [r for r in clean(7) if r[0] != 3]).withColumn("symbol", F.lit("bad"))
    found = validate({"klines": bars(spark, clean()).unionByName(bad)})["verdicts"].collect()
    assert {r.symbol: r.verdict for r in found} == {"s": "clean", "bad": "issues"}
    with pytest.raises(ValueError):
        quality.require_rows(bad.limit(0))


def test_files(spark):
    head = "a,b"
    lines = spark.createDataFrame([("ok", head), ("ok", '1,"x,y"'), ("wide", head), ("wide", "1,2,3"), ("twice", head), ("twice", "1,2"), ("twice", head), ("none", None), ("bare", head)], "file_name string, value string")
    got = {(r.file_name, r.issue): r.n for r in quality.file_issues(lines, ["a", "b"]).collect()}
    assert got == {("wide", "row_width"): 1, ("twice", "repeated_header"): 1, ("none", "empty"): 1, ("bare", "empty"): 1}
