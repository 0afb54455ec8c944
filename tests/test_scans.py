"""Folds by stretches against plain windows over whole histories."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ticklattice.operators import joins, windows
from ticklattice.operators.scans import carried

ROWS = "symbol string, timestamp_ms long, seq long, x long"


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    at = sorted(rng.randrange(5000) for _ in range(600))
    data = [(rng.choice("hhhhab"), t, i, rng.choice([None, None, rng.randrange(50)])) for i, t in enumerate(at)]
    return spark.createDataFrame(data, ROWS).repartition(5)


def same(a, b):
    return sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(b.columns)).collect()))


@pytest.mark.parametrize("width", [1, 37, 10_000])
def test_carried_equals_a_window(rows, width):
    before = Window.partitionBy("symbol").orderBy("timestamp_ms", "seq").rowsBetween(Window.unboundedPreceding, -1)
    want = rows.withColumns({"a": F.last("x", ignorenulls=True).over(before), "b": F.max("x").over(before)})
    assert same(carried(rows, ["symbol"], "timestamp_ms", ["timestamp_ms", "seq"], width, a=(F.col("x"), "last"), b=(F.col("x"), "max")), want)


@pytest.mark.parametrize("width", [1, 37, 10_000])
def test_callers_equal_windows(rows, width):
    by = Window.partitionBy("symbol")
    once = rows.select("symbol", "timestamp_ms").distinct()
    assert same(windows.bar_steps(rows, width), once.withColumn("step_ms", F.lead("timestamp_ms").over(by.orderBy("timestamp_ms")) - F.col("timestamp_ms")))
    filled = rows.na.fill(0, ["x"])
    lag = lambda c: F.lag(c).over(by.orderBy("timestamp_ms", "x"))
    rate = F.when(lag("x") > 0, F.greatest(F.col("x") - lag("x"), F.lit(0)) * 1000.0 / F.nullif(F.col("timestamp_ms") - lag("timestamp_ms"), F.lit(0)))
    assert same(windows.counter_rate(filled, "x", ["symbol"], width=width), filled.withColumn("rate", rate))
    mark = F.max("x").over(by.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    assert same(windows.new_buckets(filled, ["symbol"], "seq", "x", width), filled.withColumn("m", mark).filter("m is null or x > m").drop("m"))


@pytest.mark.parametrize("width", [1, 3, 100])
def test_lifecycle_by_stretches(spark, width):
    rng = random.Random(7)
    presence, want = [], []
    for s in "abc":
        strikes, tracked = 0, False
        for cycle in range(60):
            here = rng.random() < 0.5
            presence.append((s, cycle, here))
            if here:
                if not tracked:
                    want.append((s, cycle, "added"))
                strikes, tracked = 0, True
            elif tracked:
                strikes += 1
                if strikes == 2:
                    want.append((s, cycle, "removed"))
                    tracked = False
    got = windows.lifecycle(spark.createDataFrame(presence, "symbol string, cycle long, present boolean"), width=width)
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("width", [1, 37, 10_000])
def test_asof_without_tolerance(spark, rows, width):
    right = rows.filter("x is not null")
    left = spark.createDataFrame([(s, t) for s in "habz" for t in range(0, 6000, 97)], "symbol string, timestamp_ms long")
    table = {}
    for r in sorted(right.collect(), key=lambda r: (r.timestamp_ms, r.seq)):
        table.setdefault(r.symbol, []).append(r)
    got = joins.asof_join(left, right, {"x": "y"}, width=width).collect()
    for r in got:
        last = [q for q in table.get(r.symbol, []) if q.timestamp_ms <= r.timestamp_ms][-1:]
        assert (r.y, r.matched_ms) == ((last[0].x, last[0].timestamp_ms) if last else (None, None))
    assert len(got) == left.count()


def test_a_hot_key_is_many_tasks(spark, rows):
    hot = rows.filter("symbol = 'h'")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = carried(hot, ["symbol"], "timestamp_ms", ["timestamp_ms", "seq"], 37, a=(F.col("x"), "last")).groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert spread > 1
