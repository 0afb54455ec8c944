"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled and given one more coordinate so that the largest inner product is the least distance; each of `tables`
hash tables keys them by `width`-wide cells of Gaussian projections. A query visits its own cell and then perturbed ones
in the order of their estimated success (the expected squared distances to the cell walls), `probes` in all per table.
Cells and visiting queries meet by cell; each task merges what its cells give a query, and exact inner products in double
precision rank the rest.

`probes` is fitted: a bounded sample of queries is searched by brute force, and the least number of probes is taken whose
cells hold `target` of these true neighbours, with room for the sample's error (one side of 95 %). Without structure in the vectors this comes to most of the cells.

Equal vectors are one class, searched once; a class keeps its k + 1 smallest ids, which is all an answer can use. Cells are
split in blocks of `block` classes, so a hot cell is no single task's. A query that its cells give fewer than k candidates, though
there are more, is compared with every class: these queries are dealt in groups to blocks of classes.

Defined results: null, zero, and non-finite vectors and null ids take no part; vectors of each dimension are searched among
themselves, as no inner product joins others; rows with one id count as candidates each, and a query id that is repeated asks
with the first of its vectors, in order of their components; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_model, write_table

LADDER = (8, 12, 16, 24, 32, 48, 81)


def probe_order(bits: int, count: int) -> list[tuple[int, ...]]:
    """Perturbation sets in falling order of estimated success. A set names ranks among the 2 * bits wall distances; ranks
    j and 2 * bits + 1 - j are the two walls of one projection and never go together."""
    m = bits
    cost = [0.0] + [
        j * (j + 1) / (4 * (m + 1) * (m + 2)) if j <= m else 1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2))
        for j in range(1, 2 * m + 1)
    ]
    found: list[tuple[int, ...]] = [()]
    heap = [(cost[1], (1,))]
    while heap and len(found) < count:
        total, ranks = heapq.heappop(heap)
        if not any(2 * m + 1 - r in ranks for r in ranks):
            found.append(ranks)
        last = ranks[-1]
        if last < 2 * m:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*ranks, last + 1)))
    return found


class Hashing:
    """The hash tables' projections; norm: the largest norm of all vectors."""

    def __init__(self, dim: int, norm: float, tables: int, bits: int, width: float, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.norm, self.tables, self.bits = norm, tables, bits
        self.lines = rng.normal(size=(dim + 1, tables * bits)) / width
        self.shift = rng.uniform(0, 1, tables * bits)

    def cells(self, x: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray]:
        """Cells (row, table, bit) and places within them."""
        if query:
            x, last = _units(x), np.zeros(len(x))
        else:
            x = x / self.norm
            last = np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))
        at = (np.c_[x, last] @ self.lines + self.shift).reshape(len(x), self.tables, self.bits)
        cell = np.floor(at)
        return cell.astype(np.int64), at - cell

    def key(self, cell: np.ndarray, table: np.ndarray) -> np.ndarray:
        """A 64-bit key of a table's cells (last axis: bits)."""
        with np.errstate(over="ignore"):
            h = table.astype(np.int64) + np.int64(1)
            for b in range(self.bits):
                h = (h ^ cell[..., b]) * np.int64(-0x61C8864680B583EB)
                h = h ^ (h >> np.int64(31))
        return h

    def own(self, x: np.ndarray) -> np.ndarray:
        cell, _ = self.cells(x, False)
        return self.key(cell, np.arange(self.tables)[None, :])

    def visited(self, x: np.ndarray, order: list[tuple[int, ...]]) -> np.ndarray:
        """Keys (row, table, probe) of the cells that queries visit."""
        cell, place = self.cells(x, True)
        walls = np.argsort(np.concatenate([place, 1 - place], 2), 2)  # rank -> wall; walls below come first
        keys = np.empty((len(x), self.tables, len(order)), np.int64)
        rows, tables = np.ogrid[: len(x), : self.tables]
        for i, ranks in enumerate(order):
            moved = cell.copy()
            for r in ranks:
                wall = walls[:, :, r - 1]
                moved[rows, tables, wall % self.bits] += np.where(wall < self.bits, -1, 1)
            keys[:, :, i] = self.key(moved, tables)
        return keys


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def _usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec) of rows that take part."""
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec")).filter(F.col("id").isNotNull() & F.col("vec").isNotNull())
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(finite & F.exists("vec", lambda x: x != 0))


def _units(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, however long or short they are."""
    x = x / np.abs(x).max(1)[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed component by component as the answers' scores are."""
    total = np.zeros(len(b))
    with np.errstate(over="ignore", invalid="ignore", under="ignore"):
        for x, y in zip(a.T, b.T, strict=True):
            total += x * y
    return np.where(np.isnan(total), np.inf, total)


def _top(asked: np.ndarray, vectors: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each asked row's n largest inner products, ties to the smaller id: the rows, the places of the vectors, the products. A fast product finds what may be
    among them, with room for its rounding; exact sums decide."""
    n = min(n, len(vectors))
    scale = np.abs(vectors).max()
    near = _units(asked) @ (vectors / scale).T
    room = 2.0**-40 * np.sqrt(((vectors / scale) ** 2).sum(1).max())
    least = np.partition(near, near.shape[1] - n, 1)[:, near.shape[1] - n] - room
    # sums too small or large for doubles to tell apart
    with np.errstate(over="ignore", under="ignore"):
        reach = np.abs(asked).max(1) * scale
    blurred = (reach < 1e-280) | ~(reach < 1e290)
    rows, at = np.nonzero((near >= least[:, None]) | blurred[:, None])
    score = _products(asked[rows], vectors[at])
    order = np.lexsort((ids[at], -score, rows))
    rows, at, score = rows[order], at[order], score[order]
    many = np.bincount(rows, minlength=len(asked))
    kept = np.arange(len(rows)) - np.repeat(many.cumsum() - many, many) < n
    return rows[kept], at[kept], score[kept]


def _fit(classes: DataFrame, queries: DataFrame, hashing: Hashing, k: int, target: float, sample: int) -> list[tuple[int, ...]]:
    """The probe order that reaches the target on a bounded sample of queries, searched by brute force."""
    asked = queries.orderBy(F.xxhash64("id")).limit(sample).collect()
    q, own = _matrix([r["vec"] for r in asked]), [r["id"] for r in asked]

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame({"n": [], "rep": [], "score": []})
        for batch in batches:
            if len(batch):
                reps = batch["rep"].to_numpy()
                rows, at, score = _top(q, _matrix(batch["vec"]), reps, k + 1)
                held = pd.concat([held, pd.DataFrame({"n": rows, "rep": reps[at], "score": score})]).sort_values(["n", "score", "rep"], ascending=[True, False, True])
                held = held[held.groupby("n").cumcount() <= k]
        yield held

    near = classes.select("rep", "vec").mapInPandas(best, "n int, rep long, score double")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("n").orderBy(F.desc("score"), "rep"))).filter(F.col("rank") <= k + 1).select("n", "rep")
    # the vectors of at most sample * (k + 1) answers
    ranked = ranked.join(classes.select("rep", "vec"), "rep").collect()
    order = probe_order(hashing.bits, LADDER[-1])
    visited = hashing.visited(q, order)
    at = [r for r in ranked if r["rep"] != own[r["n"]]]
    if not at:
        return order
    cells = hashing.own(np.asarray([r["vec"] for r in at]))
    hits = visited[[r["n"] for r in at]] == cells[:, :, None]
    first = np.where(hits.any(1), 1, 0)
    for probes in LADDER:
        found = first[:, :probes].any(1).mean()
        if found - 1.64 * np.sqrt(found * (1 - found) / len(first)) >= target:
            return order[:probes]
    return order


SCHEMA = "query_id long, rank int, vec_id long, score double"


def nearest(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", query_step: int = 20, k: int = 20, **options) -> DataFrame:
    """(query_id, rank, vec_id, score): of each row whose id is divisible by query_step, its k nearest others found."""
    usable = _usable(rows, id_col, vector_col)
    out = rows.sparkSession.createDataFrame([], SCHEMA)
    for (dim,) in usable.select(F.size("vec")).distinct().orderBy(F.size("vec")).collect():
        out = out.unionByName(_nearest(usable.filter(F.size("vec") == dim), dim, query_step, k, **options))
    return out


def _nearest(usable: DataFrame, dim: int, query_step: int, k: int, tables: int = 6, bits: int = 4, width: float = 1.2, target: float = 0.95, block: int = 4096, index_rows: int = 40_000, sample: int = 64) -> DataFrame:
    """The search among vectors of one dimension."""
    spark: SparkSession = usable.sparkSession
    classed = usable.withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(1), "vec")})
    few = Window.partitionBy("h1", "h2").orderBy("id")
    members = classed.withColumn("n", F.row_number().over(few)).filter(F.col("n") <= k + 1)
    classes = members.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids"), F.first("vec").alias("vec"))
    classes = write_table(classes.select(F.monotonically_increasing_id().alias("class"), "rep", "ids", "vec"), "vector-classes")
    queries = write_table(usable.filter(F.col("id") % query_step == 0).groupBy("id").agg(F.min("vec").alias("vec")), "query-vectors")
    size = classes.agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("vec", F.abs))).alias("most")).first()
    if not size["n"] or queries.isEmpty():
        return spark.createDataFrame([], SCHEMA)
    most = float(size["most"])  # lengths are compared in its multiples, so that their squares neither vanish nor overflow
    longest = classes.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + (x / most) * (x / most)))).first()[0]
    hashing = Hashing(dim, min(most * float(np.sqrt(longest)), 1.7e308), tables, bits, width)
    order = _fit(classes, queries, hashing, k, target, sample)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.iloc[at : at + 2000]
                keys = hashing.own(_matrix(part["vec"]))
                again = lambda c: np.repeat(part[c].to_numpy(), tables)  # noqa: B023, E731
                yield pd.DataFrame({"cell": keys.ravel(), "id": again("class"), "rep": again("rep"), "vec": [v for v in part["vec"] for _ in range(tables)]})

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 100):
                part = batch.iloc[at : at + 100]
                keys = hashing.visited(_matrix(part["vec"]), order).reshape(len(part), -1)
                ids = np.repeat(part["id"].to_numpy(), keys.shape[1])
                yield pd.DataFrame({"cell": keys.ravel(), "id": ids, "rep": ids, "vec": [v for v in part["vec"] for _ in range(keys.shape[1])]})

    where = "cell long, id long, rep long, vec array<double>"
    indexed = classes.select("class", "rep", "vec").mapInPandas(index, where)
    sizes = write_table(classes.select("class", "rep", "vec").mapInPandas(index, where).groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")), "cells")
    spread = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    left = indexed.join(sizes, "cell").select("cell", spread.alias("part"), F.lit(0).alias("kind"), "id", "rep", "vec")
    right = queries.mapInPandas(visits, where).join(sizes, "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), F.lit(1).alias("kind"), "id", "rep", "vec")
    # a query gets one short list from each task it visits, so cells are dealt to few tasks, of index_rows each
    tasks = max(2, -(-size["n"] * tables // index_rows))
    met = left.unionByName(right).withColumn("deal", F.pmod(F.xxhash64("cell", "part"), F.lit(tasks)))
    found = write_table(_best(_searched(met, k), k), "near-found")
    # a class may hold up to k + 1 members, so a query is complete if its classes hold k others, or are all there are
    held = classes.select("class", F.size("ids").alias("members"))
    total = classes.agg(F.sum(F.size("ids"))).first()[0]
    have = found.join(held, "class").groupBy("query_id").agg(F.sum("members").alias("have"))
    short = queries.join(have, queries["id"] == have["query_id"], "left").filter(F.coalesce("have", F.lit(0)) < F.least(F.lit(k + 1), F.lit(total))).select("id", "vec")
    short = write_table(short.withColumn("rest", F.lit(True)), "short-queries")
    missed = short.count()
    if missed:
        blocks, groups = -(-size["n"] // block), -(-missed // block)
        deal = F.pmod(F.xxhash64("id"), F.lit(groups)).cast("long")
        every = lambda n, kind: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast(f"array<{kind}>"))
        asked = short.select(deal.alias("cell"), every(blocks, "int").alias("part"), F.lit(1).alias("kind"), "id", F.col("id").alias("rep"), "vec")
        there = classes.select(every(groups, "long").alias("cell"), F.pmod(F.xxhash64("class"), F.lit(blocks)).cast("int").alias("part"), F.lit(0).alias("kind"), F.col("class").alias("id"), "rep", "vec")
        exact = _searched(there.unionByName(asked).withColumn("deal", F.xxhash64("cell", "part")), k)
        found = _best(found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(exact), k)
    exactly = F.aggregate(F.zip_with("asked", "vec", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    scored = found.drop("score").join(queries.select(F.col("id").alias("query_id"), F.col("vec").alias("asked")), "query_id").join(classes.select("class", "ids", "vec"), "class")
    each = scored.select("query_id", exactly.alias("score"), F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(last).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best(found: DataFrame, k: int) -> DataFrame:
    """Each query's k + 1 best classes, once each."""
    best = found.groupBy("query_id", "class", "rep").agg(F.max("score").alias("score"))
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "rep", "class")
    return best.withColumn("n", F.row_number().over(place)).filter(F.col("n") <= k + 1).drop("n")


def _searched(met: DataFrame, k: int) -> DataFrame:
    """(query_id, class, rep, score): classes (kind 0) and queries (kind 1) of each (cell, part) compared by inner products, a short
    list per query and task."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        free_model()
        held: list[pd.DataFrame] = []  # the best so far of the task's queries
        count, where_at, ids, reps, vectors = 0, None, [], [], []

        def pruned() -> pd.DataFrame:
            every = pd.concat(held, ignore_index=True).drop_duplicates(["query_id", "class"])
            every = every.sort_values(["query_id", "score", "rep"], ascending=[True, False, True], ignore_index=True)
            return every[every.groupby("query_id").cumcount() <= k]

        for batch in batches:
            change = (batch["cell"].diff().ne(0) | batch["part"].diff().ne(0) | batch["kind"].diff().ne(0)).cumsum()
            for _, group in batch.groupby(change, sort=False):
                here = (group["cell"].iloc[0], group["part"].iloc[0])
                if here != where_at:
                    where_at, ids, reps, vectors = here, [], [], []
                if group["kind"].iloc[0] == 0:
                    ids.append(group["id"].to_numpy())
                    reps.append(group["rep"].to_numpy())
                    vectors.append(_matrix(group["vec"]))
                    continue
                if not ids:
                    continue
                if len(ids) > 1:
                    ids, reps, vectors = [np.concatenate(ids)], [np.concatenate(reps)], [np.concatenate(vectors)]
                asked, names = _matrix(group["vec"]), group["id"].to_numpy()
                for at in range(0, len(asked), 1000):
                    some = asked[at : at + 1000]
                    row, flat, score = _top(some, vectors[0], reps[0], k + 1)
                    held.append(pd.DataFrame({"query_id": names[at : at + 1000][row], "class": ids[0][flat], "rep": reps[0][flat], "score": score}))
                    count += len(flat)
                if count > 1_000_000:
                    held = [pruned()]
                    count = len(held[0])
                    if count > 500_000:
                        yield held[0]
                        held, count = [], 0
        if held:
            yield pruned()

    dealt = met.repartition("deal").sortWithinPartitions("cell", "part", "kind", "id").drop("deal")
    return dealt.mapInPandas(search, "query_id long, class long, rep long, score double")
