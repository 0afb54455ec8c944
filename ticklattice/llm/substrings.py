"""Removal of repeated 100-byte strings by column-wise construction over aligned contexts.

1. Winnowing picks anchors of 24 bytes so that every 100-byte window holds one, chosen by its bytes alone: equal windows
   hold equal anchors at equal places. Each anchor comes with a hash of its context, the 76 bytes on either side.
2. Anchors are sorted by (anchor, context, document, place). Where a whole context repeats an earlier one, all its
   windows do. Anchors that occur once end here.
3. The first of each different context under a shared anchor goes to the column-wise construction: the contexts are laid
   side by side at their anchors, and one symbol of each is put in per round, from the last column to the first. Each
   round updates the order of all suffixes that start in the column (the collection's positional Burrows-Wheeler order)
   and their common prefixes. Where neighbours share 100 symbols or more, all but the earliest are covered.
4. Covered stretches are merged per document and cut out.

An anchor under which more than `hot` contexts meet is split, and again while a group stays larger: the windows that start in a
range of columns are taken by themselves, grouped by the bytes that all of them hold, and the range is halved each time. Of rows
whose windows all hold the same bytes, found by a plain aggregate, only the earliest is split on: the others are covered by it. At
the end a range is one window, and none is left. So no group of the construction has more than `hot` rows.

Defined results: null text is empty; texts under 100 bytes stay whole; a null doc_id counts as smaller than any other; rows with
one doc_id are documents of their own, told apart by their place in the input, which is also their order; doc_id must be a whole
number; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, U64, bound_batches, free_model, identified, if_small, mix64, to_bytes, write_table

LENGTH, ANCHOR = 100, 24
SIDE = LENGTH - ANCHOR
SPAN = 2 * SIDE + ANCHOR
CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 5
_TABLE = mix64(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        forth, back = np.full(n, U64(BASE)), np.full(n, U64(pow(BASE, -1, 2**64)))
        forth[0] = back[0] = 1
        return np.multiply.accumulate(forth), np.multiply.accumulate(back)


_POW, _INV = _powers(1 << 16)


def _grown(n: int) -> None:
    global _POW, _INV
    if n > len(_POW):
        _POW, _INV = _powers(1 << (n - 1).bit_length())


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over all windows of `width`, by doubling."""
    done = 1
    while done * 2 <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    return pick(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of a text's anchors, and hashes of the anchor, its context and the context's halves left and right."""
    whole = np.frombuffer(data, np.uint8)
    out: list[list[np.ndarray]] = [[] for _ in range(5)]
    for at in range(0, max(0, len(whole) - LENGTH + 1), CHUNK):
        end_window = min(len(whole) - LENGTH + 1, at + CHUNK)
        low, high = max(0, at - SIDE), min(len(whole), end_window + LENGTH + SIDE)
        part = whole[low:high]
        _grown(len(part) + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(part) + 1, U64)
            np.cumsum(_TABLE[part] * _POW[: len(part)], out=sums[1:])
            span = lambda a, b: (sums[b] - sums[a]) * _INV[a]
            first, last = at - low, end_window - 1 + SIDE - low  # anchors that lie in a window of this chunk
            keys = mix64((sums[first + ANCHOR : last + ANCHOR + 1] - sums[first : last + 1]) * _INV[first : last + 1])
            order = (keys >> U64(32)).astype(np.uint32)
            least = _slide(order, SIDE + 1, np.minimum)
            padded = np.concatenate([np.zeros(SIDE, np.uint32), least, np.zeros(SIDE, np.uint32)])
            chosen = np.flatnonzero(_slide(padded, SIDE + 1, np.maximum) == order)
            p = chosen + first
            a, b = np.maximum(p - SIDE, 0), np.minimum(p + ANCHOR + SIDE, len(part))
            clip = ((p - a) * 256 + (b - p)).astype(U64)
            context = mix64(span(a, b) ^ mix64(clip + U64(1)))
            out[0].append(p + low)
            out[1].append(keys[chosen])
            out[2].append(context)
    if not out[0]:
        return tuple(np.empty(0, U64) for _ in range(3))
    p, k, c = (np.concatenate(x) for x in out[:3])
    if len(p) > 1:
        _, i = np.unique(p, return_index=True)  # chunks may share places
        p, k, c = p[i], k[i], c[i]
    return p, k, c


def _occurrences(docs: DataFrame) -> DataFrame:
    """anchor, context, doc, uid, place, n_bytes: of each (anchor, context) the first in a batch; the later ones of a batch are
    surely covered and have `covered` set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        free_model()
        for batch in batches:
            cols: list[list[np.ndarray]] = [[], [], [], [], [], []]
            for doc, uid, text in zip(batch["doc"], batch["uid"], batch["text"], strict=True):
                data = to_bytes(text)
                p, k, c = anchors(data)
                for col, x in zip(cols, (k, c, np.full(len(p), doc), np.full(len(p), uid), p, np.full(len(p), len(data))), strict=True):
                    col.append(x)
            if not cols[0]:
                continue
            k, c = (np.concatenate(x).view(np.int64) for x in cols[:2])
            d, u, p, n = (np.concatenate(x).astype(np.int64) for x in cols[2:])
            if not len(k):
                continue
            order = np.lexsort((p, u, d, c, k))
            k, c, d, u, p, n = k[order], c[order], d[order], u[order], p[order], n[order]
            covered = np.r_[False, (k[1:] == k[:-1]) & (c[1:] == c[:-1])]
            yield pd.DataFrame({"anchor": k, "context": c, "doc": d, "uid": u, "place": p, "n_bytes": n, "covered": covered})

    return docs.mapInPandas(run, "anchor long, context long, doc long, uid long, place long, n_bytes long, covered boolean")


def _runs(occurrences: DataFrame) -> DataFrame:
    """From rows sorted by (anchor, context, doc, uid, place): kind 0, a context that repeats an earlier one; kind 1, the first of
    a context under an anchor that has several. State is one row, whatever the size of a run."""
    names = ["anchor", "context", "doc", "uid", "place", "n_bytes"]
    out = ["anchor", "doc", "uid", "place", "n_bytes"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the last context's first row, and whether its anchor has another
        for batch in batches:
            known = batch["covered"].to_numpy(bool)
            if known.any():
                yield batch.loc[known, out].assign(kind=0)
                batch = batch[~known]
            if not len(batch):
                continue
            cols = [batch[c].to_numpy(np.int64) for c in names]
            front = held is not None
            if front:
                cols = [np.r_[h, c] for h, c in zip(held, cols, strict=False)]
            k, c = cols[:2]
            new = np.r_[True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])]
            starts = np.flatnonzero(new)
            before = np.r_[bool(front and held[-1]), k[starts[1:]] == k[starts[:-1]]]
            after = np.r_[k[starts[1:]] == k[starts[:-1]], False]
            several = starts[:-1][(before | after)[:-1]]
            for kind, i in ((0, np.flatnonzero(~new)), (1, several)):
                if len(i):
                    yield pd.DataFrame({"kind": kind} | {name: col[i] for name, col in zip(names, cols, strict=True) if name != "context"})
            held = [*(col[starts[-1]] for col in cols), bool(before[-1])]
        if held is not None and held[-1]:
            yield pd.DataFrame({"kind": [1]} | {name: [x] for name, x in zip(names, held, strict=False) if name != "context"})

    return occurrences.mapInPandas(run, "kind int, anchor long, doc long, uid long, place long, n_bytes long")


def covered_starts(symbols: np.ndarray, rank: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Column-wise construction over contexts (rows of SPAN symbols, aligned). rank: order of their places in the collection;
    windows that start in columns low..high of a row count. Returns a mask (row, start) of windows that an earlier row has."""
    m = len(symbols)
    covered = np.zeros((m, SIDE + 1), bool)
    order = np.arange(m)
    common = np.zeros(m, np.int64)  # of a suffix and the one before it in the order
    for column in range(SPAN - 1, -1, -1):
        symbol = symbols[order, column]
        put = np.argsort(symbol, kind="stable")
        # the least common prefix over each stretch of the old order between new neighbours
        left, right = put[:-1] + 1, put[1:]
        alike = symbol[put[1:]] == symbol[put[:-1]]
        shared = np.zeros(m, np.int64)
        near = alike & (left == right)
        shared[1:][near] = common[right[near]] + 1
        far = np.flatnonzero(alike & (left != right))
        if len(far):
            width = right[far] - left[far] + 1
            table, level = common, 0
            by_level = np.floor(np.log2(width)).astype(np.int64)
            while len(far):
                now = by_level == level
                if now.any():
                    a, b = left[far[now]], right[far[now]] - (1 << level) + 1
                    shared[far[now] + 1] = np.minimum(table[a], table[b]) + 1
                if level >= by_level.max():
                    break
                table = np.minimum(table[: len(table) - (1 << level)], table[1 << level :])
                level += 1
        order, common = order[put], shared
        if column <= SIDE and m:
            same = common >= LENGTH
            if same.any():
                group = np.cumsum(~same) - 1
                ok = (low[order] <= column) & (column <= high[order])
                value = np.where(ok, rank[order], np.iinfo(np.int64).max)
                least = np.minimum.reduceat(value, np.flatnonzero(~same))
                covered[order, column] = ok & (value > least[group])
    return covered


def _stretches(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last column of each run of set cells."""
    edge = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, start = np.nonzero(edge == 1)
    return row, start, np.nonzero(edge == -1)[1] - 1


def _construct(contexts: DataFrame, chunk: int = 150_000) -> DataFrame:
    """Stretches (doc, uid, start, stop) covered according to the construction; rows of a group come one after the other."""

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        symbols = np.frombuffer(b"".join(frame["bytes"]), np.uint8).reshape(-1, SPAN)
        doc, uid, place = (frame[c].to_numpy(np.int64) for c in ("doc", "uid", "place"))
        rank = np.empty(len(frame), np.int64)
        rank[np.lexsort((place, uid, doc))] = np.arange(len(frame))
        mask = covered_starts(symbols, rank, frame["low"].to_numpy(np.int64), frame["high"].to_numpy(np.int64))
        row, a, b = _stretches(mask)
        return pd.DataFrame({"doc": doc[row], "uid": uid[row], "start": place[row] - SIDE + a, "stop": place[row] - SIDE + b + LENGTH})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += len(batch)
            if count >= chunk:
                frame = pd.concat(held, ignore_index=True)
                last = (frame["group"] == frame["group"].iloc[-1]).to_numpy()  # its group may go on
                if not last.all():
                    yield solve(frame[~last])
                    held, count = [frame[last]], int(last.sum())
        if held:
            yield solve(pd.concat(held, ignore_index=True))

    return contexts.mapInPandas(run, "doc long, uid long, start long, stop long")


def _contexts(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """The bytes around each first occurrence, padded to SPAN, with the columns in which a window may start."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, uid, text, marks in zip(batch["doc"], batch["uid"], batch["text"], batch["marks"], strict=True):
                data = to_bytes(text)
                for anchor, place in {(m["anchor"], m["place"]) for m in marks}:
                    a, b = place - SIDE, place + ANCHOR + SIDE
                    piece = b"\0" * max(0, -a) + data[max(0, a) : b]
                    rows.append((anchor, doc, uid, place, piece + b"\0" * (SPAN - len(piece)), max(0, -a), min(SIDE, len(data) - LENGTH - a)))
            yield pd.DataFrame(rows, columns=["anchor", "doc", "uid", "place", "bytes", "low", "high"])

    marks = firsts.groupBy("doc", "uid").agg(F.collect_list(F.struct("anchor", "place")).alias("marks"))
    return docs.join(marks, ["doc", "uid"]).select("doc", "uid", "text", "marks").mapInPandas(run, "anchor long, doc long, uid long, place long, bytes binary, low int, high int")


def _halved(groups: DataFrame) -> DataFrame:
    """Rows of groups that are too large, each put under the halves of its range of starts (a, b); a half's group is named by the
    bytes that all its windows hold."""
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    halves = F.array(F.struct(F.col("a").alias("a"), middle.alias("b")), F.struct((middle + 1).alias("a"), F.col("b").alias("b")))
    rows = groups.select("doc", "uid", "place", "bytes", F.col("low").alias("l"), F.col("high").alias("h"), F.explode(halves).alias("s"))
    rows = rows.select("doc", "uid", "place", "bytes", F.greatest("l", "s.a").alias("low"), F.least("h", "s.b").alias("high"), "s.a", "s.b").filter("low <= high")
    return rows.withColumn("group", F.xxhash64("a", "b", F.substring("bytes", F.col("b") + 1, F.col("a") + LENGTH - F.col("b"))))


def _covered_contexts(contexts: DataFrame, hot: int) -> DataFrame:
    """Stretches (doc, uid, start, stop) that contexts under one anchor have from earlier ones."""
    out = None
    rows = contexts.select("doc", "uid", "place", "bytes", "low", "high", F.lit(0).alias("a"), F.lit(SIDE).alias("b"), F.col("anchor").alias("group"))
    while True:
        large = write_table(rows.groupBy("group").agg(F.count("*").alias("n")).filter(F.col("n") > hot).select("group"), "large-groups")
        fit = rows.join(if_small(large), "group", "left_anti").repartition("group").sortWithinPartitions("group", "doc", "uid", "place")
        found = _construct(fit.select("group", "doc", "uid", "place", "bytes", "low", "high"))
        out = found if out is None else out.unionByName(found)
        if large.isEmpty():
            return out
        rest = write_table(_halved(rows.join(if_small(large), "group", "left_semi")), "split-groups")
        rest = rest.withColumn("span", F.substring("bytes", F.col("a") + 1, F.col("b") - F.col("a") + LENGTH))
        at, same = F.struct("doc", "uid", "place"), ["a", "b", "low", "high", "span"]
        heads = write_table(rest.groupBy(*same).agg(F.min(at).alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n"), "span-heads")
        rest = write_table(rest.join(if_small(heads), same, "left").withColumn("again", F.coalesce(at > F.col("least"), F.lit(False))).drop("least", "span"), "split-spans")
        start = F.col("place") - SIDE
        out = out.unionByName(rest.filter("again").select("doc", "uid", (start + F.col("low")).alias("start"), (start + F.col("high") + LENGTH).alias("stop")))
        rows = rest.filter("not again and a < b").drop("again")


def merge_spans(starts: list[int], stops: list[int]) -> list[tuple[int, int]]:
    """Maximal runs covered by the stretches."""
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, stops, strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def repeated_spans(docs: DataFrame, hot: int = 5000) -> DataFrame:
    """(doc, uid, start, stop): stretches of bytes covered by a 100-byte string that also starts earlier. docs: (doc, uid, text)."""
    found = _occurrences(docs).withColumn("deal", F.when(F.col("covered"), F.xxhash64("doc", "uid", "place")).otherwise(F.col("anchor")))
    dealt = found.repartition("deal").sortWithinPartitions("anchor", "context", "doc", "uid", "place")
    kinds = write_table(_runs(dealt.drop("deal")), "anchor-runs")
    whole = kinds.filter("kind = 0").select("doc", "uid", F.greatest(F.col("place") - SIDE, F.lit(0)).alias("start"), F.least(F.col("place") + ANCHOR + SIDE, F.col("n_bytes")).alias("stop"))
    contexts = write_table(_contexts(docs, kinds.filter("kind = 1").select("anchor", "doc", "uid", "place")), "contexts")
    return whole.unionByName(_covered_contexts(contexts, hot))


def remove_repeats(docs: DataFrame, hot: int = 5000, uid: Column | None = None) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the removed spans and the kept bytes.

    uid, if given, tells rows of one doc_id apart (place_in_file, say); without it the rows are numbered and written.
    """
    bound_batches(docs.sparkSession)
    own = identified(docs, uid, F.col("text").cast("string").alias("text"))
    by_doc = repeated_spans(own, hot).groupBy("doc", "uid").agg(F.collect_set(F.struct("start", "stop")).alias("cuts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, text, cuts in zip(batch["doc"], batch["text"], batch["cuts"], strict=True):
                data, cuts = to_bytes(text), cuts if cuts is not None else []
                spans = merge_spans([c["start"] for c in cuts], [c["stop"] for c in cuts])
                at, kept = 0, []
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                kept = b"".join([*kept, data[at:]])
                rows.append((None if doc == NULL_ID else doc, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), [{"start": a, "stop": b} for a, b in spans], kept))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]).astype({"doc_id": "Int64"})

    return own.join(by_doc, ["doc", "uid"], "left").select("doc", "text", "cuts").mapInPandas(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, stop: long>>, kept binary"
    )
