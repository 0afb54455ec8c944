"""Tree checks that read only changed files."""

import os

from ticklattice.operators import quality
from ticklattice.plans import verify_changed
from ticklattice.sources import lanes

HEAD = {"trades": ["a", "b"], "klines": ["a", "b", "c"]}


def put(root, path, text):
    os.makedirs(os.path.dirname(f"{root}/{path}"), exist_ok=True)
    with open(f"{root}/{path}", "w") as f:
        f.write(text)


def rows(df):
    return sorted((r.file_name.rsplit("/", 1)[1], r.issue, r.n) for r in df.collect())


def test_a_second_run_reads_what_changed(spark, tmp_path):
    root, state = str(tmp_path / "tree"), str(tmp_path / "state")
    put(root, "trades/x/1/a.csv", "a,b\n1,2\n1,2,3\n")
    put(root, "trades/x/1/b.csv", "a,b\n1,2\n")
    put(root, "trades/x/2/c.csv", "")
    put(root, "klines/x/1/d.csv", 'a,b,c\n1,"2,5",3\na,b,c\n')
    first = verify_changed(spark, root, HEAD, state)
    want = [("a.csv", "row_width", 1), ("c.csv", "empty", 1), ("d.csv", "repeated_header", 1)]
    assert rows(first["issues"]) == want and (first["listed"], first["read"]) == (4, 4)
    again = verify_changed(spark, root, HEAD, state)
    assert rows(again["issues"]) == want and (again["listed"], again["read"]) == (4, 0)
    put(root, "trades/x/1/b.csv", "a,b\n1\n")
    put(root, "trades/x/3/e.csv", "a,b\n1,2\n")
    os.remove(f"{root}/trades/x/1/a.csv")
    third = verify_changed(spark, root, HEAD, state)
    assert (third["listed"], third["read"]) == (4, 2)
    assert rows(third["issues"]) == [("b.csv", "row_width", 1), ("c.csv", "empty", 1), ("d.csv", "repeated_header", 1)]
    full = [r for kind, head in HEAD.items() for r in rows(quality.file_issues(lanes.read_lines(spark, root, kind), head))]
    assert rows(third["issues"]) == sorted(full)
