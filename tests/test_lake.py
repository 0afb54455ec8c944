"""Books of a lake: which directories a book at an instant, and the current book, read."""

import pytest
from pyspark.sql import functions as F

from ticklattice import plans
from ticklattice.operators import book
from ticklattice.sources import sinks

HOUR, DAY = 3_600_000, 86_400_000
T0 = 1_768_435_200_000  # a midnight


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Four days of a diff every ten minutes for two symbols, and snapshots of each at 06:00."""
    root = str(tmp_path_factory.mktemp("lake"))
    rows = [(s, T0 + i * HOUR // 6, i + 1, i + 1, i, f'[["{90 + i % 7}.0","{i % 3}"]]', f'[["{101 + i % 5}.0","{i % 4}"]]') for i in range(4 * 24 * 6) for s in ("a", "b")]
    diffs = spark.createDataFrame(rows, "symbol string, timestamp_ms long, first_update_id long, last_update_id long, prev_update_id long, bids_json string, asks_json string")
    sinks.write_diffs(diffs, root)
    late = {"a": 6, "b": 9}
    snaps = [(s, T0 + d * DAY + late[s] * HOUR, 144 * d + late[s] * 6 + 1, side, price, 1.0) for d in range(4) for s in ("a", "b") for side, price in (("bid", 90.0), ("bid", 89.0), ("ask", 110.0))]
    sinks.write_snaps(spark.createDataFrame(snaps, "symbol string, timestamp_ms long, last_update_id long, side string, price double, quantity double"), root)
    return root


def scans(df):
    """The file scans of a plan: (the plan's line, files read), after running it."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    found = [leaves.apply(i) for i in range(leaves.size())]
    return [(x.toString(), x.metrics().get("numFiles").get().value()) for x in found if "FileScan" in x.toString() and "bids_json" in x.toString()]


def plain(found):
    """The same tables without their directories, so nothing is pruned."""
    return {k: df.drop("date", "hour") for k, df in found.items()}


@pytest.mark.parametrize("t", [T0 + 2 * DAY + 8 * HOUR + 1000, T0 + 2 * DAY + 20 * HOUR, T0 + DAY + 3 * HOUR, None])
def test_books_read_the_hours_they_need(spark, lake, t):
    found = plans.lake_books(spark, lake)
    book_of = lambda x: book.book_at(x["snaps"], x["events"], t)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(book_of(found)) == key(book_of(plain(found))) != []
    gap = lambda x: book.book_at_gap(x["snaps"], x["diffs"], t)
    assert key(gap(found)) == key(gap(plain(found)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pruned, whole = scans(book_of(found)), scans(book_of(plain(found)))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert all(("dynamicpruning" in line if t is not None else "subquery" in line.lower()) for line, _ in pruned)
    # each symbol's anchor is its last 06:00 or 09:00 before t; the hours from the first of them to t are read
    end = t if t is not None else T0 + 4 * DAY - 1
    first = min(max(T0 + d * DAY + hour * HOUR for d in range(4) if T0 + d * DAY + hour * HOUR <= end) for hour in (6, 9))
    at = F.unix_date("date").cast("bigint") * DAY + F.col("hour") * HOUR
    files = spark.read.parquet(f"{lake}/depth_updates").filter(at.between(first - first % HOUR, end)).select("_metadata.file_path").distinct().count()
    assert {n for _, n in pruned} == {files} and all(n > 3 * files for _, n in whole)


def test_current_books_have_ladders(spark, lake):
    found = plans.lake_books(spark, lake, ["A"])
    ladder, top = plans.book_now(found["snaps"], found["events"])
    assert {r.symbol for r in ladder.collect()} == {"a"} and top.filter(F.col("mid").isNotNull()).count() == 1
