"""The n-gram join, importance resampling and vector codes on planted rows, against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticklattice.llm import codes, resampling, setjoin
from ticklattice.llm.common import shingle_hashes

DOCS = "doc_id long, text string, rep string, key string, weight string, rank string"


def rows_of(texts):
    return [(i, t, "x", "y", "z", "r") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    word = lambda: rng.choice("the of river stone blue over light song under glass Kite é😀 zwölf x1".split()) + rng.choice(["", "s", "ed"])
    out, base = [], [[word() for _ in range(n)] for n in (4, 5, 6, 7, 9, 12, 20, 40, 80, 160, 400)]
    for words in base:
        for _ in range(14):
            some = list(words)
            for _ in range(rng.randint(0, max(1, len(some) // 40))):
                at = rng.randrange(len(some))
                some[at : at + rng.randint(0, 1)] = [word()] * rng.randint(0, 2)
            out.append(" ".join(some))
    long = [word() for _ in range(6000)]
    return [*out, None, "", " \n\t", "one two", "ONE two", " ".join(long), " ".join(long[40:]), "...---", *out[:5]]


def linked(texts, num=85):
    """(number of shingles, smallest index reachable) of each text."""
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set())
    near = list(range(len(texts)))

    def root(i):
        while near[i] != i:
            i = near[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= num * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                near[y] = x
    return [(len(s), root(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("options", [{}, {"star_rounds": 0, "block": 3}, {"star_rounds": 1, "tokens": 100}])
def test_join_equals_brute_force(spark, texts, options):
    got = setjoin.join_sets(spark.createDataFrame(rows_of(texts), DOCS).repartition(3), **options).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == dict(enumerate(linked(texts)))


def test_join_odd_rows(spark):
    same = "a b c d e f g h i j k l m n o p"
    rows = [(None, same, *"abcd"), (7, same, *"abcd"), (7, "other words that are not like it at all", *"abcd"), (9, same + " q", *"abcd"), (3, None, *"abcd")]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in setjoin.join_sets(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [(False, 3, 0, 3), (False, 7, 6, 7), (False, 7, 13, 7), (False, 9, 14, 7), (True, 0, 13, None)]
    assert setjoin.join_sets(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("n", [6, 7, 10, 13, 20, 33, 60, 150, 700])
def test_linked_sets_meet(n):
    """Sets with as many differences as a link allows share a key of a class."""
    rng, classes = np.random.default_rng(n), setjoin.Classes(85, 100)
    keys = lambda s: {k for c in {classes.of(len(s)), max(0, classes.of(len(s)) - 1)} if len(s) <= classes.top(c) for part in setjoin.meeting_keys(np.sort(s), c, classes)[0] for k in part.tolist()}
    for _ in range(150 if n < 100 else 20):
        a = rng.integers(0, 2**64, n, np.uint64)
        gone = rng.integers(0, n + 1)
        while gone and 100 * (n - gone) < 85 * n:
            gone -= 1
        more = 0
        while 100 * (n - gone) >= 85 * (n + more + 1):
            more += 1
        b = np.r_[a[gone:], rng.integers(0, 2**64, more, np.uint64)]
        if gone + more:
            assert keys(a) & keys(b)


def test_box_tree_finds_all():
    rng = np.random.default_rng(5)
    centers = rng.integers(0, 30, (6, 16))
    points = np.maximum(0, centers[rng.integers(0, 6, 300)] + rng.integers(-2, 3, (300, 16))).astype(np.int32)
    tree = setjoin.BoxTree(points, leaf=4)
    for asked in points[::17]:
        shared = np.minimum(points, asked).sum(1)
        assert sorted(tree.search(asked, 85, 100).tolist()) == np.flatnonzero(185 * shared >= 85 * (asked.sum() + points.sum(1))).tolist()
    assert len(shingle_hashes("a b c", 4)) == 1


def drawn(docs, target):
    """The contract of importance resampling, feature by feature."""

    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]

    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = [0] * 10_000, [0] * 10_000
    for table, into in ((docs, s), (target, t)):
        for _, text in table:
            for f in features(text):
                into[bucket(f)] += 1
    gain = [math.floor(1000 * math.log(((y + 1.0) * (sum(s) + 10_000.0)) / ((x + 1.0) * (sum(t) + 10_000.0)))) for x, y in zip(s, t, strict=True)]
    out = []
    for doc, text in docs:
        found = features(text)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= 39), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    rank = {r: i + 1 for i, r in reversed(list(enumerate(able[: 25 * len(able) // 100])))}
    return sorted(((*r, rank.get(r)) for r in out), key=str)


@pytest.mark.parametrize("options", [{}, {"words": 6, "pairs": 4, "held": 8}, {"words": 0, "pairs": 0}])
def test_resampling_equals_brute_force(spark, texts, options):
    target = [(0, "The river stone, over blue light"), (1, None), (2, "KITE x1s")]
    docs = [*enumerate(texts), (None, texts[100])]
    got = resampling.resample(spark.createDataFrame([(*r, *"abcd") for r in docs], DOCS).repartition(3), spark.createDataFrame(target, "item_id long, text string"), **options).collect()
    assert sorted((tuple(r) for r in got), key=str) == drawn(docs, target)


def test_resampling_of_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert resampling.resample(none, none).collect() == []
    (row,) = resampling.resample(spark.createDataFrame([(1, None, *"abcd")], DOCS), none).collect()
    assert (row.n_features, row.weight, row["rank"]) == (0, 0, None)


def test_counts_keep_what_is_frequent():
    counts, rng = resampling._Counts(50), random.Random(1)
    keys = ["often"] * 400 + [f"w{i}" for i in range(3000)]
    rng.shuffle(keys)
    for at in range(0, len(keys), 20):
        counts.add(keys[at : at + 20])
        assert len(counts.counts) <= 50
    assert counts.counts.most_common(1)[0][0] == "often"


VECTORS = "vec_id long, embedding array<float>, label string, code string, error string"


def coded(rows, parts=16, entries=64, rounds=2):
    """Plain rounds over all parts, in Python's integers."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[[math.floor(256 * float(np.float32(x))) for x in r[1]][p * len(r[1]) // parts : (p + 1) * len(r[1]) // parts] for p in range(parts)] for r in rows]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda p, x: min((apart(x, e), i) for i, e in enumerate(books[p]))
    for _ in range(rounds):
        took = [[near(p, c[p])[1] for c in cut] for p in range(parts)]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, t in zip(cut, took[p], strict=True) if t == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    best = [[near(p, c[p]) for p in range(parts)] for c in cut]
    error = [sum(d for d, _ in b) for b in best]
    label = lambda r: sum(e for e, o in zip(error, rows, strict=True) if o[2] == r[2])
    return sorted(((str(r[0]), r[2], "".join(f"{i:02x}" for _, i in b), e, label(r), sha) for r, b, e in zip(rows, best, error, strict=True)), key=str)


def vectors(n, width, seed):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(9, width))
    out = [(i, (centers[rng.integers(9)] + rng.normal(size=width) * rng.choice([0, 0.05, 1.0])).astype("float32").tolist(), rng.choice(["a", "b", None, "c"]), "x", "y") for i in range(n)]
    out = [(i, v, None if k is None else str(k), x, y) for i, v, k, x, y in out]
    bad = [(n, None, "a", "x", "y"), (n + 1, [None] * width, "a", "x", "y"), (n + 2, [float("nan")] * width, "a", "x", "y"), (n + 3, [float("inf")] + [0.0] * (width - 1), "b", "x", "y")]
    return out + bad + [(None, [0.5] * width, None, "x", "y"), (3, [0.25] * width, "a", "x", "y"), (3, out[5][1], "a", "x", "y"), (n + 4, [0.0] * width, "b", "x", "y"), (n + 5, [-1e5] * width, "b", "x", "y")]


@pytest.mark.parametrize(("width", "options"), [(64, {}), (32, {"chunk": 40, "leaf": 2}), (16, {"chunk": 1000, "leaf": 5}), (48, {"parts": 4, "entries": 5, "leaf": 3, "rounds": 4})])
def test_codes_equal_plain_rounds(spark, width, options):
    rows = vectors(260, width, width)
    got = codes.compress(spark.createDataFrame(rows, VECTORS).repartition(2), **options).collect()
    plain = {k: v for k, v in options.items() if k in ("parts", "entries", "rounds")}
    assert sorted(((str(r.vec_id), r.label, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got), key=str) == coded(rows, **plain)


def test_codes_of_few_and_other_vectors(spark):
    frame = lambda rows: spark.createDataFrame([(i, v, "a", "x", "y") for i, v in rows], VECTORS)
    assert codes.compress(frame([])).collect() == []
    assert codes.compress(frame([(1, None), (2, [])])).collect() == []
    got = codes.compress(frame([(1, [1.0] * 16), (2, [2.0] * 16), (3, [3.0] * 32)])).collect()
    assert sorted((r.vec_id, r.code[:2], r.error) for r in got) == [(1, "00", 0), (2, "01", 0)]
    with pytest.raises(ValueError, match="equal parts"):
        codes.compress(frame([(1, [1.0] * 15)]))
    with pytest.raises(Exception, match="fit a long"):
        codes.compress(frame([(1, [1e30] * 16), (2, [1.0] * 16)])).collect()


def test_balls_own_whole_ranges():
    """Most points are settled by cached sums where they lie in clumps, and each is settled once."""
    rng = np.random.default_rng(2)
    points = (rng.integers(0, 8, (4000, 1)) * 1000 + rng.integers(-3, 4, (4000, 4))).astype(np.int64)
    balls, sums, order = codes.grow(points, 0, 16)
    books = (np.arange(8)[None, :, None] * 1000 + np.zeros((1, 8, 4))).astype(np.int64)
    whole, seen = 0, np.zeros(4000, int)
    for place, entry, ball in codes.owners(balls, sums, points[order], books):
        for p, e, b in zip(place, entry, ball, strict=True):
            span = slice(balls[b]["start"], balls[b]["end"]) if b >= 0 else slice(p, p + 1)
            seen[span] += 1
            whole += (span.stop - span.start) if b >= 0 else 0
            assert (np.rint(points[order][span] / 1000) == e).all()
    assert (seen == 1).all() and whole == 4000
