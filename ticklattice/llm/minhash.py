"""Near-duplicate removal with HyperMinHash sketches.

A document's set of word shingles is dealt to 160 buckets by each shingle's hash; a bucket's register keeps the leading-zero
count of the least remaining hash and the ten bits after the leading one. Runs of five registers are the 32 bands, which
miss a pair at the threshold of 0.8 once in 300,000 times. Documents with equal sets form one class, classes that share a band are candidates, the collision-corrected
Jaccard estimate drops the hopeless ones, and the rest are confirmed on full sets.

Candidates come in rounds: twice each bucket's first class against those of other components, then all that is left between
different components of a bucket, in blocks that give links only; pairs inside a component can't change it and are never
made.

Defined results: null, empty and blank texts have an empty set and are linked with nothing; rows with one doc_id are documents
of their own, told apart by their place in the input, so only the texts decide what is linked; a null doc_id has component null,
is kept and linked with nothing; extra columns are ignored. `kept` is doc_id = component_id; where doc_ids repeat, `first` is true
for just one row of each component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, U64, bound_batches, free_model, identified, if_small, mix64, release, shingle_hashes, write_table
from .components import components

BUCKETS, MANTISSA, ROWS = 160, 10, 5
SIGMAS = 6.0
#: Where an empty bucket looks for a filled one, when bands are made: a fixed random order of the others for each bucket.
_PROBES = np.argsort(mix64(np.arange(BUCKETS * BUCKETS, dtype=U64)).reshape(BUCKETS, BUCKETS), axis=1)


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers (uint16; 0: empty bucket) of sorted, distinct 64-bit hashes."""
    out = np.zeros(BUCKETS, "<u2")
    if not len(hashes):
        return out
    with np.errstate(over="ignore"):
        dealt = (hashes >> U64(32)) * U64(BUCKETS)
    bucket = (dealt >> U64(32)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])  # sorted: the first of a bucket is its least
    rest = (dealt[first] << U64(32)) | (hashes[first] & U64(0xFFFFFFFF)) | U64(1)
    zeros = np.maximum(63 - np.floor(np.log2(rest.astype(np.float64))).astype(np.int64), 0)
    zeros += ((rest << zeros.astype(U64)) >> U64(63) == 0).astype(np.int64)  # where rounding to float gave one too few
    zeros = np.minimum(zeros, 60)
    mantissa = ((rest << zeros.astype(U64)) << U64(1)) >> U64(64 - MANTISSA)
    out[bucket[first]] = ((zeros + 1) << MANTISSA) | mantissa.astype(np.int64)
    return out


def band_keys(regs: np.ndarray) -> list[int]:
    """A 64-bit key of each band. Empty buckets borrow a filled one's register, so that a band of a small set agrees as seldom
    as one of a large set."""
    filled = regs != 0
    if not filled.any():
        return []
    if not filled.all():
        empty = np.flatnonzero(~filled)
        regs = regs.copy()
        order = _PROBES[empty]
        regs[empty] = regs[order[np.arange(len(empty)), filled[order].argmax(1)]]
    return [xxhash.xxh3_64_intdigest(band.tobytes(), seed=i) - 2**63 for i, band in enumerate(regs.reshape(-1, ROWS))]


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers, less the chance collisions of registers of sets of sizes n and m."""
    filled = ((a != 0) | (b != 0)).sum(1)
    equal = ((a == b) & (a != 0)).sum(1)
    ratio = np.maximum(n, m) / np.maximum(1, np.minimum(n, m))
    chance = 0.169919487159739 * BUCKETS / 2.0**MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return np.clip((equal - chance) / np.maximum(1, filled), 0, 1)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc, uid, n_shingles, set_hash (null: empty set), regs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        free_model()
        for batch in batches:
            rows = []
            for text in batch["text"]:
                s = np.unique(shingle_hashes(text, width))
                rows.append((len(s), xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None, registers(s).tobytes() if len(s) else None))
            out = pd.DataFrame(rows, columns=["n_shingles", "set_hash", "regs"])
            out.insert(0, "doc", batch["doc"].to_numpy())
            out.insert(1, "uid", batch["uid"].to_numpy())
            yield out
        release()

    return docs.select("doc", "uid", "text").mapInPandas(run, "doc long, uid long, n_shingles long, set_hash string, regs binary")


def _bands(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = [band_keys(np.frombuffer(r, "<u2")) for r in batch["regs"]]
            yield pd.DataFrame({"band": np.asarray([k for x in keys for k in x], np.int64), "rep": np.repeat(batch["rep"].to_numpy(np.int64), [len(x) for x in keys])})

    return classes.select("rep", "regs").mapInPandas(run, "band long, rep long")


def _hopeful(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of classes whose sizes and estimate allow a Jaccard index of `least`."""
    side = lambda x: classes.select(F.col("rep").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("regs").alias(f"regs_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * F.lit(least) - 1e-9)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch[f"regs_{x}"]), "<u2").reshape(-1, BUCKETS) for x in "ab")
            n, m = batch["n_a"].to_numpy(float), batch["n_b"].to_numpy(float)
            filled = np.maximum(1, ((a != 0) | (b != 0)).sum(1))
            floor = least - SIGMAS * np.sqrt(least * (1 - least) / filled)
            yield batch.loc[estimate(a, b, n, m) >= floor, ["a", "b"]]

    return both.select("a", "b", "n_a", "n_b", "regs_a", "regs_b").mapInPandas(run, "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(rep, items): the sorted shingle hashes of classes, from the text of each one's first document (rep, doc, uid)."""

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"rep": batch["rep"], "items": [np.unique(shingle_hashes(t, width)).tobytes() for t in batch["text"]]})
        release()

    return write_table(docs.join(if_small(wanted), ["doc", "uid"]).select("rep", "text").mapInPandas(gather, "rep long, items binary"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs with den * intersection >= num * union, on full sets."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield batch.loc[np.asarray(keep, bool), ["a", "b"]]

    wanted = write_table(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "wanted")
    few = sets.join(if_small(wanted), "rep", "left_semi")
    side = lambda k, v: few.select(F.col("rep").alias(k), F.col("items").alias(v))
    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y").mapInPandas(check, "a long, b long")


def _block_links(labelled: DataFrame, heads: DataFrame, sets: DataFrame, num: int, den: int, block: int) -> DataFrame:
    """Links (a, b) between different components within groups of buckets that have one head.

    In each group the members outside its largest component meet all members, dealt in blocks, and are compared on full sets in
    the task: what comes out are links alone. Rows go up with the members, and comparisons with members times outsiders.
    """
    inside = write_table(labelled.join(heads.select("band", "head"), "band").select("head", "rep", "comp").distinct(), "inside")
    counts = inside.groupBy("head", "comp").agg(F.count("*").alias("n"))
    group = if_small(write_table(counts.groupBy("head").agg(F.max(F.struct("n", "comp"))["comp"].alias("main"), F.sum("n").alias("size")), "heads"))
    wide = F.greatest(F.lit(block // 16), F.least(F.lit(block), F.ceil(F.col("size") / 8)))
    placed = inside.join(group, "head").withColumn("blocks", F.ceil(F.col("size") / wide).cast("int"))
    members = placed.select("head", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("part"), F.lit(0).alias("kind"), "rep", "comp")
    others = placed.filter("comp <> main").select("head", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), F.lit(1).alias("kind"), "rep", "comp")
    rows = members.unionByName(others).join(sets, "rep")
    rows = rows.repartition("head", "part").sortWithinPartitions("head", "part", "kind", "rep")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, index = None, [], None
        for batch in batches:
            found = []
            for head, part, kind, rep, comp, items in zip(*(batch[c] for c in ("head", "part", "kind", "rep", "comp", "items")), strict=True):
                if (head, part) != at:
                    at, held, index = (head, part), [], None
                items = np.frombuffer(items, U64)
                if kind == 0:
                    held.append((rep, comp, items))
                    continue
                if not held:
                    continue
                if index is None:  # shingle -> members, as sorted postings
                    reps, comps, sets_ = zip(*held, strict=True)
                    sizes = np.asarray([len(x) for x in sets_])
                    flat, who = np.concatenate(sets_), np.repeat(np.arange(len(sets_)), sizes)
                    order = np.argsort(flat, kind="stable")
                    index = (np.asarray(reps), np.asarray(comps), sizes, flat[order], who[order])
                reps, comps, sizes, flat, who = index
                low, high = np.searchsorted(flat, items), np.searchsorted(flat, items, "right")
                n = high - low
                places = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
                both = np.bincount(who[places], minlength=len(reps))
                hit = (comps != comp) & (den * both >= num * (len(items) + sizes - both))
                found += [(max(rep, r), min(rep, r)) for r in reps[hit].tolist()]
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows.select("head", "part", "kind", "rep", "comp", "items").mapInPandas(compare, "a long, b long").distinct()


def _merged(comps: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components (node, component) with further links put in; the links are renamed to what is known, so only a small graph of
    components is searched anew."""
    if comps is None:
        return write_table(components(links), "components")
    for end in ("a", "b"):
        known = comps.select(F.col("node").alias(end), F.col("component").alias("c"))
        links = links.join(known, end, "left").withColumn(end, F.coalesce("c", end)).drop("c")
    step = write_table(components(links), "joined")
    later = step.select(F.col("node").alias("component"), F.col("component").alias("far"))
    old = comps.join(later, "component", "left").select("node", F.coalesce("far", "component").alias("component"))
    return write_table(old.unionByName(step.join(comps, "node", "left_anti")), "components")


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, star_rounds: int = 2, block: int = 4096, uid: Column | None = None) -> DataFrame:
    """Per row: doc_id, uid, n_shingles, component_id, kept, first. Links: Jaccard index of at least num / den.

    uid, if given, tells rows of one doc_id apart (place_in_file, say); without it the rows are numbered and written.
    """
    bound_batches(docs.sparkSession)
    least = num / den
    docs = identified(docs, uid, F.col("text").cast("string").alias("text"))
    sketched = write_table(sketches(docs, width), "sketches")
    filled = sketched.filter(F.col("set_hash").isNotNull() & (F.col("doc") != NULL_ID))
    found = filled.groupBy("set_hash").agg(F.min(F.struct("doc", "uid")).alias("at"), F.first("n_shingles").alias("n_shingles"), F.first("regs").alias("regs"))
    classes = write_table(found.withColumn("rep", F.monotonically_increasing_id()), "classes")
    bands = _bands(classes)
    buckets = bands.groupBy("band").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).filter("least < most")
    shared = write_table(bands.join(if_small(write_table(buckets.select("band"), "buckets")), "band"), "bands")
    in_buckets = if_small(write_table(shared.select("rep").distinct(), "wanted"))
    sets = _sets(docs, write_table(classes.join(in_buckets, "rep").select("rep", "at.doc", "at.uid"), "wanted"), width)

    comps = None
    for number in range(star_rounds + 1):
        if comps is None:
            labelled = shared.withColumn("comp", F.col("rep"))
        else:
            labelled = shared.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select("band", "rep", F.coalesce("component", "rep").alias("comp"))
        heads = labelled.groupBy("band").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.min(F.struct("comp", "rep"))["rep"].alias("head")).filter("c0 < c1")
        heads = if_small(write_table(heads, "heads"))
        if number < star_rounds:  # a bucket's first class against those of other components
            pairs = labelled.join(heads, "band").filter("comp <> c0").select(F.least("head", "rep").alias("a"), F.greatest("head", "rep").alias("b"))
            hopeful = write_table(_hopeful(write_table(pairs.distinct(), "pairs"), classes, least), "hopeful")
            links = write_table(_confirmed(hopeful, sets, num, den), "links")
        else:
            links = write_table(_block_links(labelled, heads, sets, num, den, block), "links")
        comps = _merged(comps, links)
    placed = write_table(comps.join(classes.select(F.col("rep").alias("node"), "set_hash", "at"), "node"), "members")
    heads = write_table(placed.groupBy("component").agg(F.min("at").alias("head")), "heads")
    named = placed.join(if_small(heads), "component").select("set_hash", "head")
    alone = classes.join(comps.select(F.col("node").alias("rep")), "rep", "left_anti").select("set_hash", F.col("at").alias("head"))
    members = write_table(named.unionByName(alone), "class-heads")
    usable = F.when(F.col("doc") != NULL_ID, F.col("set_hash"))
    out = sketched.select("doc", "uid", "n_shingles", usable.alias("set_hash")).join(members, "set_hash", "left")
    doc_id = F.when(F.col("doc") != NULL_ID, F.col("doc"))
    component = F.when(F.col("doc") != NULL_ID, F.coalesce("head.doc", "doc"))
    first = F.col("head").isNull() | ((F.col("head.doc") == F.col("doc")) & (F.col("head.uid") == F.col("uid")))
    return out.select(doc_id.alias("doc_id"), "uid", "n_shingles", component.alias("component_id"), F.coalesce(component == doc_id, F.lit(True)).alias("kept"), first.alias("first"))
