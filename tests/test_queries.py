"""Every registered tape query against its SQL equivalent, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from ticklattice import queries as tape

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(tape.oracle_sql()))
def test_equals_sql(spark, duck, name):
    df = tape.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    found = duck.execute(tape.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = [tuple(r[names.index(c)] for c in columns) for r in found.fetchall()]
    assert ordered(got) == ordered(want)


def test_entry_module_registers_all(spark):
    import __spark_entry__ as entry

    assert set(tape.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["q17_taker", "q21_reports", "q22_verdicts", "a13_to_taker"])
def test_nothing_is_divided_by_zero(spark, tmp_path, name):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    con.execute(f"copy (select * replace (case when event_id % 7 = 0 then 0 else value end as value) from '{SF}/events.parquet') to '{tmp_path}/events.parquet' (format parquet)")
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    df = tape.queries()[name](spark, str(tmp_path))
    found = con.execute(tape.oracle_sql()[name])
    names = [d[0] for d in found.description]
    want = [tuple(r[names.index(c)] for c in sorted(names)) for r in found.fetchall()]
    assert ordered([tuple(r[c] for c in sorted(names)) for r in df.collect()]) == ordered(want)


@pytest.mark.parametrize("name", ["b06_bundle", "m01_matrix"])
def test_more_symbols_than_a_selection_holds(spark, tmp_path, name):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    con.execute(f"copy (select * replace (event_type || event_id % 25 as event_type) from '{SF}/events.parquet') to '{tmp_path}/events.parquet' (format parquet)")
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    got = [(r.symbol, r.timestamp_ms) for r in tape.queries()[name](spark, str(tmp_path)).select("symbol", "timestamp_ms").collect()]
    want = con.execute(f"select symbol, timestamp_ms from ({tape.oracle_sql()[name]})").fetchall()
    assert sorted(got) == sorted(want) and len({s for s, _ in got}) > 100
