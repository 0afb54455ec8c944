"""Jaccard join of n-gram sets by count vectors.

The tokens of a set are dealt to groups by their hash. The numbers of tokens per group are a point, and the sum of the smaller
coordinates of two points bounds their sets' overlap from above. Two sets of sizes a and b that link differ in at most
d = (den - num) / (den + num) * (a + b) tokens. Sizes are cut into classes, and a class has more groups than its largest pair has
differences, so linked sets agree exactly on some group. A set's d + 1 fullest groups of two or more tokens are its meeting places, by
their contents: the fullest group on which two sets agree comes after at most d others in either, all of them differing. A set with
fewer such groups gives all it has and is dealt to groups anew by another hash, until it has enough; a linked set that agrees on none
of them does the same. So no link is lost, but for collisions of 64-bit hashes.

Where sets meet, the bound drops pairs before any full set is read. Candidates come in rounds: twice the first set of each
meeting place against those of other components; then all that is left between different components, in blocks of bounded size, each
an R-tree over its points: a ball of it is a box with the largest coordinates and the range of sizes, a search leaves out boxes whose
summed minima with the asked point are too few, and what survives is verified on full sets. Pairs inside a component can't change it
and are never made. One R-tree over all points would not do: coordinates of unlike sets of one size are alike up to chance, so boxes
of more than a few sets exclude nothing.

Defined results: null, empty and blank texts have an empty set and are linked with nothing; rows with one doc_id are documents of
their own, told apart by uid; a null doc_id has component null and is linked with nothing; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, U64, bound_batches, free_model, identified, if_small, mix64, release, shingle_hashes, write_table
from .minhash import _confirmed, _merged, _sets

_STEP = U64(0x9E3779B97F4A7C15)


class Classes:
    """Classes of set sizes, and the groups that pairs with the smaller set in a class use."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self._lows, self._groups = num, den, [1], []

    def of(self, n: int) -> int:
        while self._lows[-1] <= n:
            low = self._lows[-1]
            self._lows.append(max(low + 1, low * self.den**4 // self.num**4 + 1))
        return int(np.searchsorted(self._lows, n, "right")) - 1

    def top(self, k: int) -> int:
        """The largest size that a set of class k links with."""
        while len(self._lows) < k + 2:
            self.of(self._lows[-1])
        return self.den * (self._lows[k + 1] - 1) // self.num

    def differences(self, n: int, k: int) -> int:
        """The most tokens that a set of n and one that it links with may differ in, within class k."""
        other = min(self.den * n // self.num, self.top(k))
        return (self.den - self.num) * (n + other) // (self.den + self.num)

    def groups(self, k: int) -> int:
        while len(self._groups) <= k:
            most = (self.den - self.num) * 2 * self.top(len(self._groups)) // (self.den + self.num)
            self._groups.append(most + most // 10 + 3)
        return self._groups[k]


def meeting_keys(tokens: np.ndarray, k: int, classes: Classes) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys of the groups that a set (sorted tokens) has in class k, and its count vector."""
    most, n_groups = classes.differences(len(tokens), k), classes.groups(k)
    keys, counts, seed = [], None, 0
    while most:  # without differences only equal sets link
        with np.errstate(over="ignore"):
            dealt = tokens if seed == 0 else np.sort(mix64(tokens + U64(seed) * _STEP))
            group = (((dealt >> U64(32)) * U64(n_groups)) >> U64(32)).astype(np.int64)  # rises with the tokens
            start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            size = np.diff(np.r_[start, len(dealt)])
            if counts is None:
                counts = np.zeros(n_groups, np.int64)
                counts[group[start]] = size
            good = np.flatnonzero(size >= 2)
            good = good[np.argsort(-size[good], kind="stable")][: most + 1]
            held = np.add.reduceat(mix64(dealt ^ _STEP), start)[good]
            name = ((U64(k) << U64(48)) | (U64(seed) << U64(32)) | group[start][good].astype(U64)) * _STEP
            keys.append(mix64(held ^ mix64(name)).view(np.int64))
        if len(good) > most:
            break
        seed += 1
    return keys, counts if counts is not None else np.zeros(0, np.int64)


def _packed(counts: np.ndarray | None) -> bytes | None:
    """A count vector in bytes; null where a coordinate has no room in one, so that nothing is known of its pairs."""
    return None if counts is None or counts.max(initial=0) > 255 else counts.astype(np.uint8).tobytes()


def sketches(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """doc, uid, n_shingles, rep (a hash of the whole set; null: empty), class, keys, and count vectors by the groups of its class and of
    the one below (null: too large for it, or not to be packed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_model()
        classes = Classes(num, den)
        for batch in batches:
            n, reps, own, keys, ends, counts, below = [], [], [], [], [0], [], []
            for text in batch.column("text").to_pylist():
                tokens = np.unique(shingle_hashes(text, width))
                n.append(len(tokens))
                many, vector, lower = [], None, None
                if len(tokens):
                    k = classes.of(len(tokens))
                    many, vector = meeting_keys(tokens, k, classes)
                    if k and len(tokens) <= classes.top(k - 1):
                        more, lower = meeting_keys(tokens, k - 1, classes)
                        many = many + more
                reps.append(xxhash.xxh3_64_intdigest(tokens.tobytes()) - 2**63 if len(tokens) else None)
                own.append(k if len(tokens) else None)
                keys += many
                ends.append(ends[-1] + sum(map(len, many)))
                counts.append(_packed(vector))
                below.append(_packed(lower))
            flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
            columns = {"doc": batch.column("doc"), "uid": batch.column("uid"), "n_shingles": pa.array(n, pa.int64()), "rep": pa.array(reps, pa.int64()), "class": pa.array(own, pa.int32())}
            columns |= {"keys": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)), "counts": pa.array(counts, pa.binary()), "below": pa.array(below, pa.binary())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
        release()

    return docs.select("doc", "uid", "text").mapInArrow(run, "doc long, uid long, n_shingles long, rep long, class int, keys array<long>, counts binary, below binary")


def bounded(pairs: DataFrame, points: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose points allow den * intersection >= num * union."""
    side = lambda x: points.select(F.col("rep").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n_shingles", "class", "counts", "below")))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(F.abs(F.col("class_a") - F.col("class_b")) <= 1)
    pick = lambda x, y: F.when(F.col(f"class_{x}") > F.col(f"class_{y}"), F.col(f"below_{x}")).otherwise(F.col(f"counts_{x}"))
    both = both.select("a", "b", (F.col("n_shingles_a") + F.col("n_shingles_b")).alias("n"), pick("a", "b").alias("x"), pick("b", "a").alias("y"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            most = batch["n"].to_numpy().copy()  # where a vector is missing, all may be shared
            for i, (x, y) in enumerate(zip(batch["x"], batch["y"], strict=True)):
                if x is not None and y is not None:
                    most[i] = np.minimum(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)).sum(dtype=np.int64)
            yield batch.loc[(num + den) * most >= num * batch["n"].to_numpy(), ["a", "b"]]

    return both.mapInPandas(run, "a long, b long")


class BoxTree:
    """An R-tree over count vectors, loaded in bulk: boxes are halved along their widest coordinate."""

    def __init__(self, points: np.ndarray, leaf: int = 16):
        self.points, self.sizes = points, points.sum(1, dtype=np.int64)
        rows, boxes = np.arange(len(points)), []  # a box: first and last place of its points, its halves
        stack = [(0, len(points), None, None)]
        while stack:
            start, end, parent, side = stack.pop()
            if parent is not None:
                boxes[parent][side] = len(boxes)
            boxes.append([start, end, 0, 0])
            if end - start > leaf:
                mine = rows[start:end]
                axis = int(np.argmax(points[mine].max(0).astype(np.int64) - points[mine].min(0)))
                rows[start:end] = mine[np.argsort(points[mine, axis], kind="stable")]
                middle, me = (start + end) // 2, len(boxes) - 1
                stack += [(middle, end, me, 3), (start, middle, me, 2)]
        self.rows, self.boxes = rows, np.asarray(boxes)
        self.high = np.asarray([points[rows[s:e]].max(0) for s, e, _, _ in boxes])
        self.least = np.asarray([self.sizes[rows[s:e]].min() for s, e, _, _ in boxes])
        self.most = np.asarray([self.sizes[rows[s:e]].max() for s, e, _, _ in boxes])

    def search(self, point: np.ndarray, num: int, den: int) -> np.ndarray:
        """Rows of the points that may link with `point`."""
        n, front, found = int(point.sum(dtype=np.int64)), np.zeros(1, np.int64), []
        while len(front):
            shared = np.minimum(np.minimum(self.high[front], point).sum(1, dtype=np.int64), self.most[front])
            front = front[((num + den) * shared >= num * (n + self.least[front])) & (den * self.most[front] >= num * n) & (den * n >= num * self.least[front])]
            ends = self.boxes[front]
            leaves = ends[:, 2] == 0
            found += [self.rows[s:e] for s, e in ends[leaves, :2]]
            front = ends[~leaves, 2:].ravel()
        if not found:
            return np.empty(0, np.int64)
        rows = np.concatenate(found)
        shared = np.minimum(self.points[rows], point).sum(1, dtype=np.int64)
        return rows[(num + den) * shared >= num * (n + self.sizes[rows])]


def vectors(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """Count vectors in 2**bits groups."""
    out = np.zeros((len(sets), 1 << bits), np.int32)
    for row, items in zip(out, sets, strict=True):
        row += np.bincount((items >> U64(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.int32)
    return out


def tree_links(labelled: DataFrame, heads: DataFrame, sets: DataFrame, points: DataFrame, num: int, den: int, block: int, tokens: int) -> DataFrame:
    """Links (a, b) between different components among the sets of meeting places that have one head. The sets outside a place's largest
    component ask an R-tree of each of its blocks, of `block` sets and `tokens` tokens on average at most."""
    inside = write_table(labelled.join(heads.select("key", "head"), "key").select("head", "rep", "comp").distinct().join(points.select("rep", "n_shingles"), "rep"), "inside")
    counts = inside.groupBy("head", "comp").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("tokens"))
    group = counts.groupBy("head").agg(F.max(F.struct("n", "comp"))["comp"].alias("main"), F.greatest(F.ceil(F.sum("n") / block), F.ceil(F.sum("tokens") / tokens)).cast("int").alias("blocks"))
    placed = inside.join(if_small(write_table(group, "heads")), "head")
    members = placed.select("head", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("part"), F.lit(0).alias("kind"), "rep", "comp")
    others = placed.filter("comp <> main").select("head", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), F.lit(1).alias("kind"), "rep", "comp")
    rows = members.unionByName(others).join(sets, "rep").repartition("head", "part").sortWithinPartitions("head", "part", "kind", "rep")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, held, tree = None, [], None
        for batch in batches:
            found = []
            for head, part, kind, rep, comp, items in zip(*(batch[c] for c in ("head", "part", "kind", "rep", "comp", "items")), strict=True):
                if (head, part) != where:
                    where, held, tree = (head, part), [], None
                items = np.frombuffer(items, U64)
                if kind == 0:
                    held.append((rep, comp, items))
                elif held:
                    if tree is None:
                        bits = min(12, max(4, int(max(len(x) for _, _, x in held)).bit_length() - 2))
                        tree = BoxTree(vectors([x for _, _, x in held], bits))
                    for row in tree.search(vectors([items], bits)[0], num, den).tolist():
                        other, their, full = held[row]
                        if their != comp:
                            both = len(np.intersect1d(items, full, assume_unique=True))
                            if den * both >= num * (len(items) + len(full) - both):
                                found.append((max(rep, other), min(rep, other)))
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows.select("head", "part", "kind", "rep", "comp", "items").mapInPandas(compare, "a long, b long").distinct()


def join_sets(docs: DataFrame, width: int = 4, num: int = 85, den: int = 100, star_rounds: int = 2, block: int = 2048, tokens: int = 2_000_000, uid: Column | None = None) -> DataFrame:
    """Per row: doc_id, uid, n_shingles, component_id. Links: Jaccard index of at least num / den.

    uid, if given, tells rows of one doc_id apart (place_in_file, say); without it the rows are numbered and written.
    """
    bound_batches(docs.sparkSession)
    docs = identified(docs, uid, F.col("text").cast("string").alias("text"))
    sketched = write_table(sketches(docs, width, num, den), "set-sketches")
    filled = sketched.filter(F.col("rep").isNotNull() & (F.col("doc") != NULL_ID))
    firsts = write_table(filled.groupBy("rep").agg(F.min(F.struct("doc", "uid")).alias("at")), "set-classes")
    keyed = filled.select("rep", F.explode("keys").alias("key"))
    places = keyed.groupBy("key").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).filter("least < most")
    shared = write_table(write_table(keyed.join(places.select("key"), "key"), "shared").distinct(), "shared")
    met = firsts.join(write_table(shared.select("rep").distinct(), "met"), "rep").select("rep", "at.doc", "at.uid")
    points = write_table(filled.join(met, ["rep", "doc", "uid"]).select("rep", "doc", "uid", "n_shingles", "class", "counts", "below"), "points")
    sets, comps = None, None
    for number in range(star_rounds + 1):
        if comps is None:
            labelled = shared.withColumn("comp", F.col("rep"))
        else:
            labelled = shared.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("comp"))
        heads = labelled.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.min(F.struct("comp", "rep"))["rep"].alias("head")).filter("c0 < c1")
        heads = if_small(write_table(heads, "heads"))
        if sets is None:
            sets = _sets(docs, points.select("rep", "doc", "uid"), width)
        if number < star_rounds:  # a place's first set against those of other components
            pairs = labelled.join(heads, "key").filter("comp <> c0").select(F.least("head", "rep").alias("a"), F.greatest("head", "rep").alias("b"))
            hopeful = write_table(bounded(write_table(pairs.distinct(), "pairs"), points, num, den), "hopeful")
            links = write_table(_confirmed(hopeful, sets, num, den), "links")
        else:
            links = write_table(tree_links(labelled, heads, sets, points, num, den, block, tokens), "links")
        comps = _merged(comps, links)
    placed = write_table(comps.join(firsts.withColumnRenamed("rep", "node"), "node"), "members")
    least = if_small(write_table(placed.groupBy("component").agg(F.min("at.doc").alias("component_id")), "heads"))
    named = placed.join(least, "component").select(F.col("node").alias("rep"), "component_id")
    alone = firsts.join(comps.select(F.col("node").alias("rep")), "rep", "left_anti").select("rep", F.col("at.doc").alias("component_id"))
    members = if_small(write_table(named.unionByName(alone), "class-components"))
    known = F.when(F.col("doc") != NULL_ID, F.col("doc"))
    usable = sketched.select("doc", "uid", "n_shingles", F.when(F.col("doc") != NULL_ID, F.col("rep")).alias("rep"))
    return usable.join(members, "rep", "left").select(known.alias("doc_id"), "uid", "n_shingles", F.when(known.isNotNull(), F.coalesce("component_id", known)).alias("component_id"))
