"""Training-data queries against their SQL, on the smallest tables and on planted ones."""

import os
import random

import duckdb
import pytest

from ticklattice.llm import queries as training

SF = "/root/testdata/sf0.001"


def planted(folder):
    """Copies, near copies, lines an edit apart (beyond ASCII too), shared passages, items in long texts, odd texts."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdeéß😀") for _ in range(rng.randint(1, 5)))
    line = lambda n: " ".join(word() for _ in range(n))
    lines, items, texts = [line(rng.randint(3, 12)) for _ in range(30)], [line(n) for n in (3, 5, 6, 9, 20)], []
    for _ in range(120):
        text = []
        for x in rng.choices(lines, k=rng.randint(1, 6)):
            at = rng.randrange(len(x))
            text.append(rng.choice([x, x, x[:at] + x[at + 1 :], x[:at] + "x" + x[at:], x[:at] + "é" + x[at + 1 :], x[:at] + "zz" + x[at:], line(4)]))
        texts.append("\n".join(text))
    texts += [line(40) + " " + x + " " + line(40) for x in items] + [items[0], "", " \n\t", None, "\n", texts[0], texts[0].upper(), " ".join(lines), "a" * 350]
    con = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", texts), ("benchmark", "item_id", [*items, None, ""])):
        con.execute(f"create table {name} ({key} bigint, text varchar)")
        con.executemany(f"insert into {name} values (?, ?)", list(enumerate(rows)))
        con.execute(f"copy {name} to '{folder}/{name}.parquet' (format parquet)")
    vectors = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(150)]
    vectors += [vectors[3], [0.0] * 64, [0.25] * 64, None, [None] * 64, [float("nan")] * 64, [float("-inf")] * 64]
    con.execute("create table embeddings (vec_id bigint, embedding float[], label integer)")
    con.executemany("insert into embeddings values (?, ?, ?)", [(i, v, rng.choice([0, 1, 2, None])) for i, v in enumerate(vectors)])
    con.execute(f"copy embeddings to '{folder}/embeddings.parquet' (format parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    return {"planted": planted(tmp_path_factory.mktemp("sf")), "given": SF}


@pytest.mark.parametrize("name", sorted(training.oracle_sql()))
@pytest.mark.parametrize("which", ["planted", "given"])
def test_equals_sql(spark, folders, which, name):
    folder = folders[which]
    if not os.path.isdir(folder):
        pytest.skip("no tables")
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    found = con.execute(training.oracle_sql()[name])
    names = [d[0] for d in found.description]
    want = [dict(zip(names, row, strict=True)) for row in found.fetchall()]
    df = training.queries()[name](spark, folder)
    assert sorted(names) == sorted(df.columns)
    key = lambda r: [str(r[c]) for c in sorted(names)]
    assert sorted((r.asDict() for r in df.collect()), key=key) == sorted(want, key=key)
