"""The corpus pipeline on small tables: each stage against what its operator is to give, odd rows included."""

import random

import pytest

import corpus_pipeline as cp

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, uid string"


def prose(rng, n, words="the of and house blue river stone over under light that with from this".split()):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rng = random.Random(1)
    base = [" ".join(f"{w}{rng.randrange(50)}" for w in prose(rng, 80).split()) for _ in range(40)]
    spanish = "el la de y casa rio piedra sobre bajo luz que con".split()
    texts = [(i, t, "en") for i, t in enumerate(base)] + [(40 + i, " ".join(f"{w}" for w in prose(rng, 90, spanish).split()), "es") for i in range(20)]
    texts += [(100, base[0].replace("the", "a", 1), "en"), (101, base[1], "en"), (102, None, None), (103, "", "en"), (104, "12 34 !!", "en"), (3, "quite another text of doc three with words that nobody has said before now", "en"), (3, base[3], "en"), (None, base[5], "en")]
    texts += [(105, f"{base[7][:80]} one benchmark item has exactly these nine words {prose(rng, 40)}", "en"), (106, "long " + " ".join(rng.choice(base).split()[rng.randrange(80)] for _ in range(30_000)), "en"), (107, f"{prose(rng, 30)}\n{base[8]}\nan own line with the number {rng.random()}", "en")]
    docs = spark.createDataFrame([(d, t, lang, "s", len(t) if t is not None else None, "clash", "clash") for d, t, lang in texts], SCHEMA).coalesce(2)
    folder = tmp_path_factory.mktemp("sf")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "one benchmark item has exactly these nine words"), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), texts


def test_stages_in_turn(spark, made, tmp_path):
    folder, texts = made
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = [(r.doc_id, r.text) for r in docs.collect()]
    ids = {name: sorted((-1 if d is None else d) for d, _ in rows) for name, rows in kept.items()}
    assert ids["language_id"] == sorted((-1 if d is None else d) for d, *_ in texts if d not in (102, 103, 104))
    first = kept["line_dedup"]
    assert 101 not in ids["line_dedup"] and ids["line_dedup"].count(3) == 2  # the copy; the two texts of one doc_id, the row without an id takes base[5]
    assert 5 not in ids["line_dedup"] and -1 in ids["line_dedup"]
    assert all("\n" not in t or d != 107 for d, t in first if d == 107 and t.count("\n") > 1)
    assert 100 not in ids["near_dedup"] and 0 in ids["near_dedup"] and ids["near_dedup"].count(3) == 2
    assert 105 not in ids["decontamination"] and 106 in ids["decontamination"] and set(ids["near_dedup"]) - set(ids["decontamination"]) == {105}
    packed = cp.STAGES[-1][1](spark, docs, folder).collect()
    assert sorted({-1 if r.doc_id is None else r.doc_id for r in packed}) == sorted(set(ids["decontamination"])) and all(0 < r.length <= 2048 for r in packed)
    assert cp.run(spark, folder).count() == len(packed)


def test_empty_tables(spark, made, tmp_path):
    folder, _ = made
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_line_dedup_cuts_each_text_once(spark, made):
    """A filter on what is left must not bring a second function, whose workers come on top of the first one's."""
    folder, _ = made
    out = cp.line_dedup(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
