"""Vector codes: codebooks for equal parts of vectors, fitted by exact rounds over anchors-hierarchy metric trees.

Vectors become integers floor(`scale` * x) and are cut into `parts` consecutive parts. Rows are taken in chunks as they lie in the
files; for each part of a chunk a metric tree is built once, middle out: anchors (each new one is the farthest point of the widest
and takes from the others what is nearer to it), then balls over the anchors, merged two by two by the least enclosing radius, and
the same again inside each anchor. Every ball keeps the sum and the number of its points. The trees are a written table, which each
round reads.

A round goes down the trees with lists of the codebook entries that may own a point of a ball. A ball inherits its parent's list and
drops each entry that is farther than the list's nearest one from every point of the ball; a ball with one entry left adds its cached
sum and number as a whole, and the points of a leaf are compared with what is left of its list. What rounding could decide is never
dropped, and points are compared in integers, so the results are those of the plain rounds.

A task gives sums per part and entry; the driver holds the codebooks alone, of parts * entries * width numbers.

Defined results: rows whose vector is null or empty or holds null or non-finite components are dropped, as are those whose length is not that of
the least kept id's vector; that length must be a multiple of `parts`, else ValueError. Null ids are kept and come last in the order of
ids; rows of one id count each, ordered by their components. With fewer vectors than `entries` the codebook has an entry for each.
An empty table gives an empty result. Squared distances must fit a long (components up to 2**28 in steps at widths up to 8), else
OverflowError. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, free_model, write_table

#: A ball of a chunk: its part, its points (a range of the part's points in tree order), and its two halves (0: a leaf).
_BALL = [("part", "<i4"), ("start", "<i4"), ("end", "<i4"), ("left", "<i4"), ("right", "<i4"), ("radius", "<f8")]


def anchors(points: np.ndarray, wanted: int) -> list[np.ndarray]:
    """Points dealt to at most `wanted` anchors: the rows that each one owns."""
    at = np.sqrt(((points - points[0]) ** 2).sum(1))
    order = np.argsort(-at, kind="stable")
    heads, owned, far = [points[0]], [order], [at[order]]  # distances to the owner, falling
    while len(heads) < wanted:
        widest = max(range(len(heads)), key=lambda k: far[k][0] if len(far[k]) else 0.0)
        if not len(far[widest]) or far[widest][0] == 0:
            break
        head = points[owned[widest][0]]
        taken, apart = [], []
        between = np.sqrt(((np.asarray(heads) - head) ** 2).sum(1))
        for k in range(len(heads)):
            near = np.searchsorted(-far[k], -between[k] / 2, "right")  # only those beyond half way can be nearer to the new one
            if near:
                rows = owned[k][:near]
                new = np.sqrt(((points[rows] - head) ** 2).sum(1))
                goes = new < far[k][:near]
                if goes.any():
                    taken.append(rows[goes])
                    apart.append(new[goes])
                    stays = np.r_[~goes, np.ones(len(owned[k]) - near, bool)]
                    owned[k], far[k] = owned[k][stays], far[k][stays]
        rows, at = np.concatenate(taken), np.concatenate(apart)
        order = np.argsort(-at, kind="stable")
        heads.append(head)
        owned.append(rows[order])
        far.append(at[order])
    return [rows for rows in owned if len(rows)]


def _tree(points: np.ndarray, leaf: int):
    """A tree over rows of points: a leaf is an array of rows, any other ball a pair of trees."""

    def build(rows: np.ndarray):
        if len(rows) <= leaf:
            return rows
        groups = anchors(points[rows], max(2, math.isqrt(len(rows))))
        if len(groups) == 1:  # all points are equal
            return rows
        balls = [build(rows[g]) for g in groups]
        centers = np.asarray([points[rows[g]].mean(0) for g in groups])
        radius = np.asarray([np.sqrt(((points[rows[g]] - c) ** 2).sum(1)).max() for g, c in zip(groups, centers, strict=True)])
        weight = np.asarray([len(g) for g in groups], float)
        cost = (np.sqrt(((centers[:, None] - centers[None]) ** 2).sum(2)) + radius[:, None] + radius[None]) / 2
        np.fill_diagonal(cost, np.inf)
        for _ in range(len(balls) - 1):
            i, j = np.unravel_index(cost.argmin(), cost.shape)
            balls[i], balls[j] = (balls[i], balls[j]), None
            radius[i] = cost[i, j]
            centers[i] = (centers[i] * weight[i] + centers[j] * weight[j]) / (weight[i] + weight[j])
            weight[i] += weight[j]
            cost[i] = cost[:, i] = (np.sqrt(((centers - centers[i]) ** 2).sum(1)) + radius + radius[i]) / 2
            weight[j] = 0
            gone = weight == 0
            cost[i, gone] = cost[gone, i] = cost[j] = cost[:, j] = np.inf
            cost[i, i] = np.inf
        return next(b for b in balls if b is not None)

    return build(np.arange(len(points)))


def grow(points: np.ndarray, part: int, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The balls of one part's points, with exact sums and the order in which the balls hold the points."""
    values = points.astype(float)
    balls, sums, order, done = [], [], [], 0
    stack = [(_tree(values, leaf), None, None)]
    while stack:  # a ball before its halves, so a range of points for each
        tree, parent, side = stack.pop()
        if parent is not None:
            balls[parent][side] = len(balls)
        me = len(balls)
        balls.append([part, done, 0, 0, 0, 0.0])
        if isinstance(tree, tuple):
            stack += [(tree[1], me, 4), (tree[0], me, 3)]
        else:
            order.append(tree)
            done += len(tree)
            balls[me][2] = done
    for ball in reversed(balls):
        if ball[3]:
            ball[2] = balls[ball[4]][2]
    order = np.concatenate(order)
    values, points = values[order], points[order]
    reach = float(np.abs(values).max()) * 1e-12  # more than rounding moves a center
    before = np.concatenate([np.zeros((1, points.shape[1]), np.int64), points.cumsum(0)])
    for ball in balls:
        start, end = ball[1], ball[2]
        total = before[end] - before[start]
        sums.append(total)
        ball[5] = float(np.sqrt(((values[start:end] - total / (end - start)) ** 2).sum(1)).max()) * (1 + 1e-9) + reach
    return np.asarray([tuple(b) for b in balls], _BALL), np.asarray(sums, np.int64), order


def owners(balls: np.ndarray, sums: np.ndarray, points: np.ndarray, books: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, entries, balls) that settle every point once: a ball that one entry owns as a whole (balls: its index, places: its
    index too), or points (balls: -1, places: row of the part, as part * rows + row). books: part, entry, position."""
    rows = len(points) // len(books)
    centers = sums / (balls["end"] - balls["start"])[:, None]
    front = np.flatnonzero(balls["start"] == 0)
    front = front[np.r_[True, balls["part"][front][1:] != balls["part"][front][:-1]]]  # each part's first ball
    lists = np.ones((len(front), books.shape[1]), bool)
    entries = books.astype(float)
    slack = 1e-12 * max(1.0, float(np.abs(points).max()), float(np.abs(entries).max()))
    while len(front):
        mine = entries[balls["part"][front]]
        far = ((centers[front][:, None] - mine) ** 2).sum(2)
        far[~lists] = np.inf
        best = far.argmin(1)
        at = np.arange(len(front))
        lead, least = mine[at, best], far[at, best][:, None]
        apart = np.sqrt(((mine - lead[:, None]) ** 2).sum(2))
        with np.errstate(invalid="ignore"):
            lists &= ~(far - least > 2 * balls["radius"][front][:, None] * apart * (1 + 1e-9) + 1e-9 * (far + least) + slack * (np.sqrt(far) + np.sqrt(least)))
        lists[at, best] = True
        owned = lists.sum(1) == 1
        yield front[owned], best[owned], front[owned]
        leaves = ~owned & (balls["left"][front] == 0)
        if leaves.any():
            ends = balls[front[leaves]]
            size = ends["end"] - ends["start"]
            place = np.repeat(ends["part"].astype(np.int64) * rows + ends["start"] - (size.cumsum() - size), size) + np.arange(size.sum())
            ball = np.repeat(np.arange(len(ends)), size)
            kept, entry = np.nonzero(lists[leaves])
            many = np.bincount(kept, minlength=len(ends))
            first = many.cumsum() - many
            each = many[ball]
            start = each.cumsum() - each
            listed = entry[np.repeat(first[ball] - start, each) + np.arange(each.sum())]
            who = np.repeat(np.arange(len(place)), each)
            apart = ((points[place[who]] - books[place[who] // rows, listed]) ** 2).sum(1)
            least = np.minimum.reduceat(apart, start)
            hit = np.flatnonzero(apart == least[who])
            hit = hit[np.r_[True, who[hit][1:] != who[hit][:-1]]]  # lists rise, so ties go to the lower entry
            yield place, listed[hit], np.full(len(place), -1)
        on = np.flatnonzero(~owned & ~leaves)
        front, lists = np.concatenate([balls["left"][front[on]], balls["right"][front[on]]]), np.concatenate([lists[on], lists[on]])


def _fits(points: np.ndarray, books: np.ndarray) -> None:
    reach = max(int(np.abs(x).max()) if x.size else 0 for x in (points, books))
    if points.shape[1] * 4 * reach * reach >= 2**63:
        raise OverflowError("squared distances of these components do not fit a long")


_CHUNK = "rows array<struct<id:{id},label:{label}>>, width int, points binary, balls binary, sums binary, place binary"


def _chunked(kept: DataFrame, parts: int, scale: int, chunk: int, leaf: int) -> DataFrame:
    """A row for each chunk: its ids and labels, the parts' points in tree order, their balls, and where each point's row is."""
    schema = _CHUNK.format(id=kept.schema["id"].dataType.simpleString(), label=kept.schema["label"].dataType.simpleString())

    def made(ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
        values = np.floor(x * scale)
        if np.abs(values).max() >= 2**31:
            raise OverflowError("squared distances of these components do not fit a long")
        values = values.astype(np.int64).reshape(len(x), parts, -1)
        balls, sums, points, place, base = [], [], [], [], 0
        for part in range(parts):
            b, s, order = grow(values[:, part], part, leaf)
            for side in ("left", "right"):
                b[side] = np.where(b[side] > 0, b[side] + base, 0)
            base += len(b)
            balls.append(b)
            sums.append(s)
            points.append(values[order, part])
            place.append(order)
        put = [np.concatenate(v).tobytes() for v in (points, balls, sums, place)]
        rows = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        return pa.RecordBatch.from_arrays([rows, pa.array([values.shape[2]], pa.int32()), *(pa.array([v], pa.binary()) for v in put)], ["rows", "width", "points", "balls", "sums", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_model()
        ids, held, size = [], [], 0
        for batch in batches:
            if not len(batch):
                continue
            vec = batch.column("vec")
            ids.append(pa.StructArray.from_arrays([batch.column("id"), batch.column("label")], ["id", "label"]))
            held.append(vec.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1))
            size += len(batch)
            if size >= chunk:
                yield made(pa.concat_arrays(ids), np.concatenate(held))
                ids, held, size = [], [], 0
        if size:
            yield made(pa.concat_arrays(ids), np.concatenate(held))

    return kept.mapInArrow(run, schema)


def _read(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(balls, sums, points) of a chunk."""
    width = batch.column("width")[i].as_py()
    of = lambda name: np.frombuffer(batch.column(name)[i].as_buffer(), np.int64).reshape(-1, width)
    return np.frombuffer(batch.column("balls")[i].as_buffer(), _BALL), of("sums"), of("points")


def _totals(chunks: DataFrame, books: np.ndarray) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(part, entry) -> number and componentwise sum of the points that it owns: at most as many rows as the codebooks have."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_model()
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for i in range(len(batch)):
                balls, sums, points = _read(batch, i)
                _fits(points, books)
                rows = len(points) // parts
                for place, entry, ball in owners(balls, sums, points, books):
                    whole = len(ball) and ball[0] >= 0
                    part = balls["part"][place] if whole else place // rows
                    np.add.at(count, (part, entry), (balls["end"] - balls["start"])[place] if whole else 1)
                    np.add.at(total, (part, entry), sums[place] if whole else points[place])
        part, entry = np.nonzero(count)
        sums = pa.array(list(total[part, entry]), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry], pa.int64()), sums], ["part", "entry", "n", "total"])

    given = chunks.select("width", "points", "balls", "sums").mapInArrow(run, "part int, entry int, n long, total array<long>")
    exact = lambda c: F.sum(c.cast("decimal(20,0)"))
    added = given.groupBy("part", "entry").agg(exact(F.col("n")).alias("n"), F.array(*(exact(F.col("total")[k]) for k in range(width))).alias("total"))
    return {(r["part"], r["entry"]): (int(r["n"]), [int(x) for x in r["total"]]) for r in added.collect()}


def fit(kept: DataFrame, chunks: DataFrame, parts: int, entries: int, rounds: int, scale: int) -> np.ndarray:
    """Codebooks (part, entry, position) after the rounds."""
    first = [r["vec"] for r in kept.orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).collect()]
    start = np.floor(np.asarray(first, float) * scale)
    books = start.astype(np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        for (part, entry), (n, total) in _totals(chunks, books).items():
            books[part, entry] = [x // n for x in total]
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, chunk: int = 8192, leaf: int = 24) -> DataFrame:
    """(id_col, label, code, error, label_error, codebooks_sha256) of each kept row; the code has two hex digits for each part."""
    spark = rows.sparkSession
    bound_batches(spark)
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index has two hex digits")
    named = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vec"))
    kept = named.filter(F.col("vec").isNotNull() & (F.size("vec") > 0) & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    kinds = {c: named.schema[c].dataType.simpleString() for c in ("id", "label")}
    out = f"id {kinds['id']}, label {kinds['label']}, code string, error long"
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vec").select(F.size("vec").alias("n")).first()
    if first is None:
        return spark.createDataFrame([], f"{out}, label_error long, codebooks_sha256 string").withColumnRenamed("id", id_col)
    if first["n"] % parts:
        raise ValueError(f"vectors of {first['n']} components are not cut into {parts} equal parts")
    kept = kept.filter(F.size("vec") == first["n"])
    chunks = write_table(_chunked(kept, parts, scale, chunk, leaf), "vector-trees")
    books = fit(kept, chunks, parts, entries, rounds, scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_model()
        for batch in batches:
            for i in range(len(batch)):
                balls, sums, points = _read(batch, i)
                _fits(points, books)
                n = len(points) // parts
                found = np.empty(parts * n, np.int64)
                for place, entry, ball in owners(balls, sums, points, books):
                    if len(ball) and ball[0] >= 0:
                        for b, e in zip(balls[place], entry, strict=True):
                            found[b["part"] * n + b["start"] : b["part"] * n + b["end"]] = e
                    else:
                        found[place] = entry
                part = np.repeat(np.arange(parts), n)
                apart = ((points - books[part, found]) ** 2).sum(1)
                where = np.frombuffer(batch.column("place")[i].as_buffer(), np.int64)
                code, error = np.empty((n, parts), np.uint8), np.zeros(n, np.int64)
                code[where, part] = found
                np.add.at(error, where, apart)
                ids, labels = batch.column("rows")[i].values.flatten()
                codes = [c.tobytes().hex() for c in code]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(codes, pa.string()), pa.array(error, pa.int64())], ["id", "label", "code", "error"])

    coded = write_table(chunks.select("rows", "width", "points", "balls", "sums", "place").mapInArrow(run, out), "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    both = coded.join(by_label, coded["label"].eqNullSafe(by_label["of"])).drop("of")
    return both.withColumn("codebooks_sha256", F.lit(digest(books))).withColumnRenamed("id", id_col)
