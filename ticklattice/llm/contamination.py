"""Benchmark decontamination: size-partitioned MinHash containment search, confirmed by exact shingle containment.

Items are partitioned by the size of their shingle sets, class B (1, 2, 4 and so on) holding those of more than B/2 and at most
B shingles. A document is cut, once per class, into blocks of B shingles, and each two neighbouring blocks are a window, so that
any passage of an item lies in one window and a containment of c there is a Jaccard index of at least about c/4. Items of one
shingle are looked up as they are, among all shingles of the documents. One-row
bands over `functions` MinHash values find it: a window and an item are candidates where one value agrees. Candidates are
confirmed by the share of the item's shingles that the whole document holds.

The index of items goes to the executors in blocks of bounded size, one pass over the documents for each; where there are several,
each pass is written before the next block is indexed.

Defined results: null, empty and blank texts match nothing; an item or document of fewer than `width` words is one shingle
of all its words, so it meets only texts of just these words; repeated rows of documents or items are matched each; null
ids are kept; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import U64, bound_batches, free_model, identified, if_small, mix64, shingle_hashes, write_table


class ItemIndex:
    """Shingle sets and MinHash values of a block of items."""

    def __init__(self, ids: list, texts: list, width: int, functions: int):
        self.width = width
        self.multipliers = mix64(np.arange(1, functions + 1, dtype=U64)) | U64(1)
        self.ids, self.sets = [], []
        for i, t in zip(ids, texts, strict=True):
            s = np.unique(shingle_hashes(t, width))
            if len(s):
                self.ids.append(i)
                self.sets.append(s)
        level = [(len(s) - 1).bit_length() for s in self.sets]
        self.classes = {}
        for c in sorted(set(level)):
            members = [i for i, x in enumerate(level) if x == c]
            tables, bits = [], 1 << min(18, max(12, (64 * len(members)).bit_length()))
            with np.errstate(over="ignore"):
                for m in self.multipliers if c else self.multipliers[:1]:  # one shingle: equal values are equal shingles
                    least = np.asarray([(self.sets[i] * m).min() for i in members], U64)
                    order = np.argsort(least, kind="stable")
                    seen = np.zeros(bits, bool)
                    seen[_low_bits(least, bits)] = True
                    tables.append((least[order], np.asarray(members)[order], seen))
            self.classes[c] = tables

    def candidates(self, shingles: list[np.ndarray]) -> set[tuple[int, int]]:
        """(document, item) positions with an equal MinHash value in some window."""
        sizes = np.asarray([len(s) for s in shingles])
        filled = np.flatnonzero(sizes)
        if not len(filled) or not self.classes:
            return set()
        flat, n = np.concatenate([shingles[i] for i in filled]), sizes[filled]
        found: set[tuple[int, int]] = set()
        if 0 in self.classes:
            with np.errstate(over="ignore"):
                self._meet(found, flat * self.multipliers[0], np.repeat(filled, n), self.classes[0][0])
        bottom, top = min((c for c in self.classes if c), default=0), max(self.classes)
        if not bottom:
            return found
        smallest = 1 << bottom
        blocks = -(-n // smallest)
        doc_start = np.cumsum(n) - n
        starts = np.repeat(doc_start - (np.cumsum(blocks) - blocks) * smallest, blocks) + np.arange(blocks.sum()) * smallest
        shapes = []  # of each level: starts of pairs of the level below, document of each block, whether the next is the same document's
        for _ in range(bottom, top + 1):
            doc = np.repeat(np.arange(len(filled)), blocks)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            shapes.append((np.flatnonzero(nth % 2 == 0), doc, np.r_[doc[1:] == doc[:-1], False]))
            blocks = -(-blocks // 2)
        with np.errstate(over="ignore"):
            for f, m in enumerate(self.multipliers):
                least = np.minimum.reduceat(flat * m, starts)
                for c in range(bottom, top + 1):
                    if c > bottom:
                        least = np.minimum.reduceat(least, shapes[c - bottom - 1][0])
                    if c not in self.classes:
                        continue
                    _, doc, joined = shapes[c - bottom]
                    window = np.where(joined, np.minimum(least, np.r_[least[1:], least[-1:]]), least)
                    self._meet(found, window, filled[doc], self.classes[c][f])
        return found

    @staticmethod
    def _meet(found: set[tuple[int, int]], window: np.ndarray, doc: np.ndarray, table: tuple) -> None:
        """Adds the (document, item) positions of equal MinHash values."""
        values, members, seen = table
        hit = np.flatnonzero(seen[_low_bits(window, len(seen))])
        a, b = np.searchsorted(values, window[hit]), np.searchsorted(values, window[hit], "right")
        for h, x, y in zip(hit[b > a], a[b > a], b[b > a], strict=True):
            found.update((int(doc[h]), int(i)) for i in members[x:y])


def _low_bits(x: np.ndarray, size: int) -> np.ndarray:
    """Place of a MinHash value in a filter of `size` (a power of two)."""
    return ((x >> U64(16)) & U64(size - 1)).astype(np.int64)


def contained_items(docs: DataFrame, items: DataFrame, width: int = 5, least: float = 0.8, functions: int = 48, items_per_block: int = 20_000, bytes_per_block: int = 32_000_000) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of all pairs with n_shared >= least * n_item."""
    bound_batches(docs.sparkSession)
    items = items.select("item_id", "text")
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    blocks = max(1, -(-size["n"] // items_per_block), -(-size["b"] // bytes_per_block))
    kind = items.schema["item_id"].dataType
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {kind.simpleString()}, n_item long, n_shared long, containment double"
    types = (to_arrow_type(kind), pa.int64(), pa.int64(), pa.float64())
    out = None
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        index = ItemIndex([r["item_id"] for r in rows], [r["text"] for r in rows], width, functions)

        def run(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            free_model()
            for whole in batches:
                for at in range(0, whole.num_rows, 200):
                    batch = whole.slice(at, 200)
                    shingles = [shingle_hashes(t, index.width) for t in batch.column(1).to_pylist()]
                    found, sets = [], {}
                    for d, i in sorted(index.candidates(shingles)):
                        if d not in sets:
                            sets = {d: np.unique(shingles[d])}
                        item, own = index.sets[i], sets[d]
                        place = np.searchsorted(own, item)
                        shared = int((own[np.minimum(place, len(own) - 1)] == item).sum())
                        if shared >= least * len(item) - 1e-9:
                            found.append((d, index.ids[i], len(item), shared, shared / len(item)))
                    docs_at, *columns = zip(*found, strict=True) if found else [()] * 5
                    made = [pa.array(column, of) for column, of in zip(columns, types, strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(docs_at, pa.int32())), *made], ["doc_id", "item_id", "n_item", "n_shared", "containment"])

        part = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
        if blocks > 1:  # one pass at a time, so that the driver holds one block's index
            part = write_table(part, "contained")
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, uid: Column | None = None, **options) -> DataFrame:
    """Documents that hold no item.

    uid, if given, tells rows of one doc_id apart (place_in_file, say); without it the rows are numbered and written.
    """
    rows = identified(docs, uid, F.col("text").cast("string").alias("text"), F.struct("*").alias("row"))
    found = contained_items(rows.select(F.struct("doc", "uid").alias("doc_id"), "text"), items, **options)
    hit = if_small(write_table(found.select("doc_id.*").distinct(), "contaminated"))
    return rows.join(hit, ["doc", "uid"], "left_anti").select("row.*")
