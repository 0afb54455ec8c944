"""The CSV tree as a data source: places, pushed filters, ranges, streams and the sink."""

import os

import pytest
from pyspark.sql import functions as F

from ticklattice.schemas import ddl, schema
from ticklattice.sources import tape

T0 = 1_768_435_200_000  # a midnight


def head(lane):
    return ",".join(c.split()[0] for c in ddl(lane).split(", "))


HEAD = head("depth_snapshot")


def put(root, path, lines):
    os.makedirs(os.path.dirname(f"{root}/{path}"), exist_ok=True)
    with open(f"{root}/{path}", "a", newline="") as f:
        f.write(lines)


def snap(symbol, t, last, price):
    return f"x,f,depth_snapshot,{t},,{symbol},snapshot,bid,{price},1.0,{last}\n"


@pytest.fixture
def tree(tmp_path):
    root = str(tmp_path / "tree")
    for day, date in ((0, "2026-01-15"), (1, "2026-01-16")):
        for symbol in ("a", "b"):
            for n in range(4):  # names that agree for long
                t = T0 + day * 86_400_000 + n * 1000
                put(root, f"orderbooks/{symbol}/{date}/{symbol}_depth_snapshot_{date}_initial_{n}.csv", HEAD + "\n" + "".join(snap(symbol, t, 10 * n + i, 100 + i) for i in range(3)))
    put(root, "orderbooks/a/2026-01-15/a_depth_updates_2026-01-15_0000-to-0100.csv", head("depth_updates") + f'\nx,f,depth_updates,{T0},,a,1,2,0,"[[""99.5"",""0.4""]]",[]\n')
    put(root, "orderbooks/a/2026-01-15/a_depth_updates_2026-01-15_0300-to-0400.csv", head("depth_updates") + f"\nx,f,depth_updates,{T0 + 3 * 3_600_000},,a,3,4,2,[],[]\n")
    return root


def leaves(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("size", [40, 100, 1 << 20])
def test_places_are_unique_and_in_the_order_of_names(spark, tree, size):
    rows = tape.read_tape(spark, tree, "depth_snapshot", bytes=size).orderBy("symbol", "seq").collect()
    assert len(rows) == 48 and len({(r.symbol, r.seq) for r in rows}) == 48
    assert [(r.symbol, r.date, r.file_name, r.last_update_id) for r in rows] == sorted((r.symbol, r.date, r.file_name, r.last_update_id) for r in rows)


def test_filters_are_pushed(spark, tree):
    df = tape.read_tape(spark, tree, "depth_snapshot").filter("symbol = 'b' AND date IN ('2026-01-16')")
    plan = leaves(df)
    assert "2026-01-16" not in plan and "= b" in plan  # the source answers for the date alone, the symbol is looked at again
    assert df.count() == 12 and {r.symbol for r in df.collect()} == {"b"}
    reader = tape.TapeSource({"path": tree, "lane": "depth_snapshot"}).reader(schema("depth_snapshot"))
    left = list(reader.pushFilters([tape.EqualTo(("symbol",), "b"), tape.In(("date",), ("2026-01-16",)), tape.EqualTo(("price",), 1.0)]))
    assert [f.attribute for f in left] == [("symbol",), ("price",)] and len(reader.partitions()) == 4
    hours = tape.TapeSource({"path": tree, "lane": "depth_updates"}).reader(schema("depth_updates"))
    list(hours.pushFilters([tape.GreaterThanOrEqual(("timestamp_ms",), T0 + 3_600_000)]))
    assert [os.path.basename(p.path)[-16:] for p in hours.partitions()] == ["0300-to-0400.csv"]


def test_odd_files(spark, tmp_path):
    root = str(tmp_path)
    put(root, "trades/a/2026-01-15/a_1.csv", "")
    put(root, "trades/a/2026-01-15/a_2.csv", head("trades") + "\n")
    put(root, "trades/a/2026-01-15/a_3.csv", head("trades") + "\r\n" + f"x,f,trades,{T0},,a,7,buy,1.5,,0,1,1\r\nx,f,trades,{T0},,a,oops,buy,n/a,2,0,1,1")
    put(root, "trades/a/2026-01-15/a_3b.csv", head("trades") + f"\nx,f\n\nx,f,trades,{T0},,a,8,buy,1.5,,0,1,1\n")
    put(root, "trades/a/2026-01-15/a_4.csv", "symbol,trade_id\na,9\n")
    put(root, "trades/a/not-a-date/a_5.csv", head("trades") + "\n")
    rows = tape.read_tape(spark, root, "trades").orderBy("seq").collect()
    assert [(r.trade_id, r.price, r.quantity, r.side) for r in rows] == [(7, 1.5, None, "buy"), (None, None, 2.0, "buy"), (8, 1.5, None, "buy"), (9, None, None, None)]
    assert {r.seq % 2**tape.PLACE_BITS for r in rows if r.file_name == "a_3b.csv"} == {len(head("trades")) + 6}
    assert tape.read_tape(spark, str(tmp_path / "none"), "trades").count() == 0


def test_stream_takes_what_grew(spark, tree, tmp_path):
    def batch():
        q = tape.stream_tape(spark, tree, "depth_snapshot").select("symbol", "file_name", "last_update_id", "seq").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out")).trigger(once=True).start()
        q.awaitTermination()
        return spark.read.parquet(str(tmp_path / "out")).count()

    assert batch() == 48
    last = "orderbooks/b/2026-01-16/b_depth_snapshot_2026-01-16_initial_3.csv"
    put(tree, last, snap("b", T0, 50, 1) + snap("b", T0, 51, 1)[:20])  # one whole line and a part of one
    put(tree, "orderbooks/c/2026-01-17/c_depth_snapshot_2026-01-17_initial_0.csv", HEAD + "\n" + snap("c", T0, 1, 1))
    assert batch() == 50
    put(tree, last, snap("b", T0, 51, 1)[20:])
    assert batch() == 51 and batch() == 51
    got = spark.read.parquet(str(tmp_path / "out"))
    want = tape.read_tape(spark, tree, "depth_snapshot").select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_sink_writes_the_tree(spark, tmp_path):
    root = str(tmp_path / "tree")
    rows = [(T0 + i * 1_800_000, "ab"[i % 2], i, i + 1, i - 1, f'[["{i}","1"]]', "[]") for i in range(60)]
    df = spark.createDataFrame(rows, "timestamp_ms long, symbol string, first_update_id long, last_update_id long, prev_update_id long, bids_json string, asks_json string")
    for _ in range(2):  # writing again changes nothing
        tape.write_tape(df, root, "depth_updates")
    names = sorted(f for _, _, fs in os.walk(root) for f in fs if f.endswith(".csv"))
    assert "a_depth_updates_2026-01-15_2300-to-0000.csv" in names and len(names) == 60 and not [f for _, _, fs in os.walk(root) for f in fs if f.endswith(".tmp")]
    back = tape.read_tape(spark, root, "depth_updates")
    assert sorted(map(tuple, back.select(*df.columns).collect())) == sorted(rows)
    assert back.filter(F.col("seq").isNull()).count() == 0


def test_a_failed_write_leaves_no_file(spark, tmp_path):
    root = str(tmp_path / "tree")
    df = spark.createDataFrame([(T0 + i, "a", float(i)) for i in range(10)], "timestamp_ms long, symbol string, price double")
    with pytest.raises(Exception, match="boom|USER_RAISED"):
        tape.write_tape(df.withColumn("side", F.when(F.col("price") > 8, F.raise_error(F.lit("boom"))).otherwise("buy")), root, "trades")
    assert not [f for _, _, fs in os.walk(root) for f in fs if f.endswith(".csv")]
