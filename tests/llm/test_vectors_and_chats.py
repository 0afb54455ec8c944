import functools
import random
import re

import numpy as np

from ticklattice.llm import ann, chat


def exact(rows, k):
    ok = [(i, np.asarray(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(np.asarray(v, float)).all() and any(v)]
    out = {}
    for q, x in ok:
        if q % 20 == 0:
            out[q] = sorted(((-float(x @ y), i) for i, y in ok if i != q))[:k]
    return out


def test_nearest_finds_nine_tenths(spark):
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(30, 8))
    rows = [(i, [float(x) for x in middle[i % 30] + 0.3 * rng.normal(size=8)]) for i in range(800)]
    rows += [(800 + i, rows[7][1]) for i in range(120)]  # one hot vector
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [1.0, None] + [0.0] * 6), (2060, [float("nan")] * 8), (2080, [float("inf")] * 8), (2100, [1.0, 2.0]), (None, rows[0][1])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, cell string").repartition(3)
    want, got = exact(rows, 20), {}
    for r in ann.nearest(df, block=64).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, *_ in found] == list(range(1, 21)) and [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        hits += len({i for _, i, _ in found} & {i for _, i in want[q]})
    assert hits >= 0.9 * 20 * len(want)
    copies = [i for _, i, _ in got[20] if i == 7 or 800 <= i < 920]
    assert copies == sorted(copies)


def test_nearest_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 3.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(df).collect()] == [(0, 1, 1, 0.5), (0, 2, 2, 0.0)]
    assert ann.nearest(df.filter("false")).count() == 0 and ann.nearest(df.filter("vec_id > 0")).count() == 0


def test_all_candidates_where_there_are_few(spark):
    """Tables of 1 to 50 vectors, with equal scores of different vectors, against brute force."""
    rng = np.random.default_rng(7)
    for n in (1, 2, 8, 21, 22, 50):
        rows = [(i, [float(x) for x in rng.integers(-1, 2, 8)] if i % 3 else [1.0] * 8) for i in range(n)]
        want = {q: [(i, s) for s, i in near] for q, near in exact(rows, 20).items()}
        got = {}
        for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
            got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, -r.score)
        assert {q: [x for _, x in sorted(near.items())] for q, near in got.items()} == {q: near for q, near in want.items() if near}


def answers(spark, rows, **options):
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), **options).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    return {q: [x for _, x in sorted(near.items())] for q, near in got.items()}


def summed(rows, k=20):
    """Brute force, with products summed in order as doubles are."""
    product = lambda a, b: functools.reduce(lambda t, xy: t + xy[0] * xy[1], zip(a, b, strict=True), 0.0)
    return {q: [(i, s) for s, i in sorted((-product(x, y), i) for i, y in rows if i != q)[:k]] for q, x in rows if q % 20 == 0}


def test_queries_without_candidates_are_searched_exactly(spark):
    """Cells so narrow that every query is short of candidates, ordinary, far, tiny and huge vectors: all by the exact way."""
    rng = np.random.default_rng(11)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(90)]
    far = [(i, [x + (50.0 if i % 2 else -50.0) for x in v]) for i, v in rows]
    tiny = [*rows, (100, [1e-200] * 8), (101, [-1e-200] * 8), (120, [1e-170, 0.0] * 4), (140, [3e-320] * 8)]
    huge = [*rows, (100, [1e150] * 8), (101, [-1e150] * 8), (120, [1e140, 0.0] * 4)]
    for table in (rows, far, tiny, huge):
        want = {q: [(i, -s) for i, s in near] for q, near in summed(table).items()}
        assert answers(spark, table, width=0.01, block=16) == want


def test_tiny_and_huge_vectors_at_default_settings(spark):
    rng = np.random.default_rng(12)
    rows = [(i, [float(x) * (1e-200 if i % 7 == 0 else 1e120 if i % 11 == 0 else 1.0) for x in rng.normal(size=8)]) for i in range(120)]
    want, got = summed(rows), answers(spark, rows)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 20 * len(want)


def test_dimensions_are_searched_apart(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [2.0, 0.0, 1.0]), (20, [1.0, 1.0, 1.0]), (3, [0.5, 0.0, 0.0]), (40, [7.0])]
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()]
    assert sorted(got) == [(0, 1, 1, 1.0), (20, 1, 2, 3.0), (20, 2, 3, 0.5)]


def test_ties_at_the_last_rank(spark):
    rows = [(i, [1.0, 0.0, float(i)] if i else [1.0, 1.0, 0.0]) for i in range(60)]
    got = sorted((r.rank, r.vec_id) for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect() if r.query_id == 0)
    assert [i for _, i in got] == list(range(1, 21))


def test_probe_order_starts_with_the_own_cell():
    order = ann.probe_order(4, 81)
    assert order[0] == () and order[1] == (1,) and len(order) == len(set(order)) == 81


def brute_order(turns):
    """Pre-order of a conversation given as turn -> parent."""
    kids = {}
    for t, p in sorted(turns.items()):
        kids.setdefault(p, []).append(t)
    out = []

    def walk(t, depth):
        out.append((t, depth))
        for x in kids.get(t, []):
            walk(x, depth + 1)

    for t in kids.get(None, []):
        walk(t, 0)
    return out


def test_chats(spark):
    rows = [
        (1, 0, "user", "Hello there, world\nSecond line here"), (1, 1, "assistant", "> Hello there world\nHi!"), (1, 2, "user", ">> Hello there world\n> Hi!\nThanks"), (1, 3, "user", "> second  LINE here\nabout that"),
        (1, 4, "assistant", "plain"), (1, 5, "user", "> not said by anyone\nreally"), (2, 0, "u", "a b"), (2, 5000, "v", None), (2, 9000, "w", "> a b\nyes"), (None, 1, "x", "q"), (3, None, "x", "q"), (4, 1, "x", ""), (4, 1, "x", ""),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, position int")
    got = chat.format_chats(df).collect()
    assert len(got) == len(rows)
    one = {r.turn: r for r in got if r.conv_id == 1}
    parents = {0: None, 1: 0, 2: 1, 3: 0, 4: 3, 5: 4}
    assert {t: r.reply_to for t, r in one.items()} == parents
    assert [(r.turn, r.depth) for r in sorted(one.values(), key=lambda r: r.position)] == brute_order(parents)
    assert one[2].text == "Thanks" and one[2].max_level == 2 and one[2].n_quoted == 2 and one[4].text == "plain"
    two = {r.turn: r for r in got if r.conv_id == 2}
    assert two[9000].reply_to == 0 and two[5000].reply_to == 0 and two[9000].text == "yes" and two[5000].text is None
    assert all(r.reply_to is None and r.position == 0 for r in got if r.conv_id is None or r.turn is None)
    assert [r.text for r in got if r.conv_id == 4] == ["", ""]
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chats_of_several_passages(spark):
    said = {0: "alpha one\nalpha two", 1: "beta one\nbeta two", 2: "gamma one\ngamma two", 3: "delta one"}
    rows = [(1, t, "user", text) for t, text in said.items()]
    rows += [
        (1, 10, "user", "> alpha one\n> alpha two\nyes\n> beta one\n> beta two\n\n> gamma one\n> gamma two\nall three"), (1, 11, "user", "> no such line\n> nor this\n> nor that\n\n> beta  TWO\nwell"),
        (1, 12, "user", ">> alpha one\n> unknown\n>> gamma two\ndeep"), (1, 13, "user", "> alpha one\n>> gamma one\n> alpha two\nouter first"), (1, 13, "user", "> alpha one\n>> gamma one\n> alpha two\nouter first"), (1, 14, "user", "> unknown\n> alpha one\n> also unknown\nno share"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in chat.format_chats(df).collect()}
    assert {t: got[t].reply_to for t in (10, 11, 12, 13, 14)} == {10: 2, 11: 1, 12: 2, 13: 0, 14: 13}
    assert got[10].text == "yes\n\nall three" and got[10].n_quoted == 6
    links = chat.quote_links(df.selectExpr("xxhash64(*) AS uid", "conv_id", "turn", "text")).collect()
    assert sorted((r.turn, r.passage, r.level, r.source_turn, r.found, r.of) for r in links) == [(10, 0, 1, 0, 2, 2), (10, 3, 1, 1, 2, 2), (10, 6, 1, 2, 2, 2), (11, 4, 1, 1, 1, 1), (12, 0, 2, 0, 1, 1), (12, 2, 2, 2, 1, 1), (13, 0, 1, 0, 1, 1), (13, 1, 2, 2, 1, 1), (13, 2, 1, 0, 1, 1)]


def test_links_against_brute_force(spark):
    """Random chats in which short lines come again and again, quoted alone and in passages; repeated and very long messages."""
    rng, pool, rows = random.Random(4), [f"line {i} of all" for i in range(6)], []
    for conv in range(3):
        for turn in range(0, 60, 2):
            said = "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 3)))
            quoted = [f"> {rng.choice(pool)}" if rng.random() < 0.7 else "between" for _ in range(rng.randint(0, 5))]
            rows.append((conv, turn, "user", "\n".join([*quoted, said])))
    rows += [rows[5], (7, 0, "user", "word " * 200_000 + "\n" + pool[0]), (7, 1, "user", f"> {pool[0]}\nyes")]
    form = lambda x: " ".join(re.findall(r"[a-z0-9]+", x.lower()))
    want = set()
    for conv, turn, _, text in rows:
        passages, before = [], None
        for place, line in enumerate(text.split("\n")):
            level = line.startswith(">")
            if level and not before:
                passages.append((place, set()))
            if level:
                passages[-1][1].add(form(line))
            before = level
        for place, keys in passages:
            met = []
            for c, t, _, other in rows:
                if c == conv and t < turn:
                    own = {form(x) for x in other.split("\n") if not x.startswith(">")}
                    if 2 * len(own & keys) >= len(keys):
                        met.append((len(own & keys), t))
            if met:
                want.add((conv, turn, place, max(met)[1], max(met)[0], len(keys)))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.quote_links(df.selectExpr("xxhash64(*) AS uid", "conv_id", "turn", "text")).collect()
    assert {(r.conv_id, r.turn, r.passage, r.source_turn, r.found, r.of) for r in got} == want and len(want) > 60
    assert chat.format_chats(df).count() == len(rows)
