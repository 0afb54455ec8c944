"""Near-equal line removal by a deletion-neighbourhood join, within one edit.

All lines that are not blank count, over all documents; the earliest occurrence (doc_id, row, line number) stays. A line goes if
an equal line occurs earlier, or, between lines of at least `min_chars` characters, one within one edit (a character put in, left
out or changed); shorter lines that differ say different things. This is judged on the input, not on what is left.

Emitting a variant per character of every line would swamp the shuffle, so it is done in two steps. Different lines within one
edit agree outside one half: first each line is keyed by what is left without each half, for its own length and
for the length of a line one shorter. Only inside halves whose key two different lines share are the one-character
deletions emitted as hashed variants. Equal variants are joined by aggregates: deletions at the same place are
one change apart, and a deletion that equals a whole line is one character apart. The earliest partner's edit distance is
then verified on the lines themselves.

A very common line is one row once its occurrences are aggregated; its occurrences then meet that row in a join of two plain
shuffles, which Spark splits where it is skewed.

Defined results: null text stays null; empty texts and blank lines stay; a null doc_id sorts first; rows with one doc_id are
told apart by their place in the input, the earlier keeping its lines; columns of any name are kept in `row`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, bound_batches, free_model, identified, if_small, mix64, release, write_table

PARTS = 2
BASE = 0xC2B2AE3D27D4EB4F


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        forth, back = np.full(n, U64(BASE)), np.full(n, U64(pow(BASE, -1, 2**64)))
        forth[0] = back[0] = 1
        return np.multiply.accumulate(forth), np.multiply.accumulate(back)


_POW, _INV = _powers(1 << 18)


class LineHashes:
    """Hashes of stretches of many lines, laid end to end."""

    def __init__(self, lines: list[str]):
        global _POW, _INV
        flat = "".join(lines).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(flat, "<u4").astype(U64)
        if len(codes) + 1 > len(_POW):
            _POW, _INV = _powers(1 << len(codes).bit_length())
        self.n = np.fromiter(map(len, lines), np.int64, len(lines))
        self.at = np.cumsum(self.n) - self.n
        with np.errstate(over="ignore"):
            codes = (codes + U64(1)) * U64(0x9FB21C651E98DF25)
            self.sums = np.zeros(len(codes) + 1, U64)
            np.cumsum((codes ^ (codes >> U64(35))) * _POW[: len(codes)], out=self.sums[1:])

    def without(self, line: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of each line without its characters from a to b."""
        start = self.at[line]
        with np.errstate(over="ignore"):
            head = (self.sums[start + a] - self.sums[start]) * _INV[start]
            tail = (self.sums[start + self.n[line]] - self.sums[start + b]) * _INV[start + b - a]
            return head + tail


def part_bounds(frame: np.ndarray, extra: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Stretches of a line's parts; `extra` is 1 where the line is one longer than its frame."""
    return [(q * frame // PARTS, (q + 1) * frame // PARTS + extra) for q in range(PARTS)]


def _tagged(x: np.ndarray, *tags) -> np.ndarray:
    with np.errstate(over="ignore"):
        for t in tags:
            x = mix64(x ^ (np.asarray(t).astype(np.int64).astype(U64) * U64(0xA24BAED4963EE407) + U64(0x9FB21C651E98DF25)))
    return x.view(np.int64)


def _part_keys(lines: list[str]) -> np.ndarray:
    """Per line, a row of 2 * PARTS keys: frames of its own length and of one less, by part."""
    h, every = LineHashes(lines), np.arange(len(lines))
    keys = []
    for extra in (0, 1):
        frame = h.n - extra
        for q, (a, b) in enumerate(part_bounds(frame, np.full(len(lines), extra))):
            keys.append(_tagged(h.without(every, a, b), frame, q))
    return np.stack(keys, 1) if lines else np.empty((0, 2 * PARTS), np.int64)


def _occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc, uid, line_no, h1, h2 and part keys (none under min_chars) of each line that counts."""
    lines = docs.select("doc", "uid", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).filter(F.col("line").rlike(r"\S"))
    lines = lines.withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), "line")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        free_model()
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.iloc[at : at + 1000]
                texts = part["line"].tolist()
                made = iter(_part_keys([t for t in texts if len(t) >= min_chars]))
                yield part[["doc", "uid", "line_no", "h1", "h2"]].assign(keys=[next(made) if len(t) >= min_chars else () for t in texts])
        release()

    return lines.mapInPandas(run, "doc long, uid long, line_no int, h1 long, h2 long, keys array<long>")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Adds `line` to (doc, uid, line_no, h1, h2, slots)."""
    marks = wanted.groupBy("doc", "uid").agg(F.collect_list(F.struct("line_no", "h1", "h2", "slots")).alias("marks"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, uid, text, found in zip(batch["doc"], batch["uid"], batch["text"], batch["marks"], strict=True):
                lines = text.split("\n")
                rows += [(doc, uid, m["line_no"], m["h1"], m["h2"], m["slots"], lines[m["line_no"]]) for m in found]
            yield pd.DataFrame(rows, columns=["doc", "uid", "line_no", "h1", "h2", "slots", "line"])
        release()

    return docs.join(if_small(write_table(marks, "line-marks")), ["doc", "uid"]).select("doc", "uid", "text", "marks").mapInPandas(
        run, "doc long, uid long, line_no int, h1 long, h2 long, slots array<int>, line string"
    )


def _variants(candidates: DataFrame) -> DataFrame:
    """From (line, h1, h2, doc, uid, line_no, slots): variant, side (0: a place of change, 1: the shorter line, 2: the longer)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at : at + 200].reset_index(drop=True)
                if not len(part):
                    continue
                h = LineHashes(part["line"].tolist())
                slots = [sorted({int(x) for x in s}) for s in part["slots"]]
                line = np.repeat(np.arange(len(part)), [len(s) for s in slots])
                slot = np.asarray([x for s in slots for x in s], np.int64)
                extra = slot // PARTS
                frame, q = h.n[line] - extra, slot % PARTS
                a, b = q * frame // PARTS, (q + 1) * frame // PARTS + extra
                width = b - a
                row = np.repeat(np.arange(len(line)), width)
                place = np.arange(len(row)) - np.repeat(np.cumsum(width) - width, width) + a[row]
                rest = h.without(line[row], place, place + 1)
                change = extra[row] == 0
                own = np.flatnonzero(extra == 0)
                zero = np.zeros(len(own), np.int64)
                parts = [
                    (line[row][change], _tagged(rest[change], 0, frame[row][change], place[change]), 0),
                    (line[own], _tagged(h.without(line[own], zero, zero), 1, frame[own]), 1),
                    (line[row][~change], _tagged(rest[~change], 1, frame[row][~change]), 2),
                ]
                for who, variant, side in parts:
                    out = pd.DataFrame({"variant": variant, "side": side, "who": who}).drop_duplicates()
                    for c in ("h1", "h2", "doc", "uid", "line_no"):
                        out[c] = part[c].to_numpy()[out["who"]]
                    yield out.drop(columns="who")
        release()

    return candidates.select("line", "h1", "h2", "doc", "uid", "line_no", "slots").mapInPandas(run, "variant long, side int, h1 long, h2 long, doc long, uid long, line_no int")


def _links(variants: DataFrame) -> DataFrame:
    """From (variant, side, h1, h2, doc, uid, line_no): h1, h2 of each line that shares a variant with an earlier one, and t1, t2,
    doc, uid and line_no of the earliest that does. A side meets its own (0), or the other (1 and 2). Rows come sorted by variant
    and place, so the state is the first row of each side; a variant's rows are as many as there are letters to put in its place."""
    names = ["variant", "side", "h1", "h2", "doc", "uid", "line_no"]
    partner = np.asarray([0, 2, 1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [np.empty(0, np.int64) for _ in names]  # the first row of each side of the last variant
        for batch in batches:
            if not len(batch):
                continue
            cols = [np.r_[h, batch[c].to_numpy(np.int64)] for h, c in zip(held, names, strict=True)]
            variant, side = cols[:2]
            group = np.cumsum(np.r_[True, variant[1:] != variant[:-1]]) - 1
            first = np.full((group[-1] + 1, 3), len(variant))
            np.minimum.at(first, (group, side), np.arange(len(variant)))
            to = first[group, partner[side]]
            i = np.flatnonzero((to < np.arange(len(variant))) & (np.arange(len(variant)) >= len(held[0])))
            if len(i):
                t = to[i]
                yield pd.DataFrame({"h1": cols[2][i], "h2": cols[3][i], "t1": cols[2][t], "t2": cols[3][t], "doc": cols[4][t], "uid": cols[5][t], "line_no": cols[6][t]})
            last = np.sort(first[-1][first[-1] < len(variant)])
            held = [c[last] for c in cols]

    dealt = variants.repartition("variant").sortWithinPartitions("variant", "doc", "uid", "line_no", "side")
    return dealt.mapInPandas(run, "h1 long, h2 long, t1 long, t2 long, doc long, uid long, line_no int")


def doomed_lines(docs: DataFrame, min_chars: int = 16) -> DataFrame:
    """(doc, uid, line_no) of lines that go. docs: (doc, uid, text), doc and uid not null and together unique."""
    seen = write_table(_occurrences(docs, min_chars), "lines")
    of_line = seen.groupBy("h1", "h2").agg(F.min(F.struct("doc", "uid", "line_no")).alias("at"), F.count("*").alias("n"), F.first("keys").alias("keys"))
    lines = write_table(of_line.select("h1", "h2", "at.doc", "at.uid", "at.line_no", "n", "keys"), "distinct-lines")
    slot_bits = F.lit(2 * PARTS - 1).cast("bigint")
    # the slot takes the place of the lowest bits of h1, which only names candidates here
    named = F.col("h1").bitwiseAND(F.bitwise_not(slot_bits))
    name_of = lambda c: F.col(c).bitwiseAND(F.bitwise_not(slot_bits))
    keyed = lines.select(named.alias("name"), F.posexplode("keys").alias("slot", "key")).select("key", F.col("name").bitwiseOR(F.col("slot").cast("bigint")).alias("spot"))
    shared = keyed.groupBy("key").agg(F.min("spot").alias("x"), F.max("spot").alias("y")).filter(name_of("x") != name_of("y")).select("key")
    slots = keyed.join(if_small(write_table(shared, "shared-keys")), "key").select(name_of("spot").alias("name"), F.col("spot").bitwiseAND(slot_bits).cast("int").alias("slot"))
    slots = write_table(slots.groupBy("name").agg(F.collect_set("slot").alias("slots")), "line-names")
    wanted = lines.filter(F.size("keys") > 0).drop("keys", "n").withColumn("name", named).join(if_small(slots), "name").drop("name")
    texts = write_table(_texts(docs, wanted), "line-texts")
    links = _links(_variants(texts)).groupBy("h1", "h2").agg(F.min(F.struct("doc", "uid", "line_no", "t1", "t2")).alias("to")).select("h1", "h2", "to.t1", "to.t2")
    near = texts.select("h1", "h2", "line")
    checked = links.join(near, ["h1", "h2"]).join(near.select(F.col("h1").alias("t1"), F.col("h2").alias("t2"), F.col("line").alias("other")), ["t1", "t2"])
    gone = write_table(checked.filter(F.levenshtein("line", "other", 1) >= 0).select("h1", "h2", F.lit(True).alias("gone")), "near-lines")
    firsts = lines.select("h1", "h2", F.col("doc").alias("doc0"), F.col("uid").alias("uid0"), F.col("line_no").alias("line0"), "n").join(if_small(gone), ["h1", "h2"], "left")
    firsts = write_table(firsts.filter("gone or n > 1").drop("n"), "repeated-lines")
    placed = seen.drop("keys").join(if_small(firsts), ["h1", "h2"])
    return placed.filter("gone or doc <> doc0 or uid <> uid0 or line_no <> line0").select("doc", "uid", "line_no")


def dedup_lines(docs: DataFrame, min_chars: int = 16, uid: Column | None = None) -> DataFrame:
    """(row, text, n_lines, n_removed): row is a struct of the columns of docs, text what is left of its text.

    uid, if given, tells rows of one doc_id apart (place_in_file, say); without it the rows are numbered and written.
    """
    bound_batches(docs.sparkSession)
    rows = identified(docs, uid, F.col("text").cast("string").alias("text"), F.struct("*").alias("row"))
    cuts = if_small(write_table(doomed_lines(rows.select("doc", "uid", "text"), min_chars).groupBy("doc", "uid").agg(F.collect_set("line_no").alias("cuts")), "line-cuts"))

    def rest(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        out = []
        for t, cut in zip(texts, cuts, strict=True):
            if t is not None and cut is not None:
                gone = set(cut)
                t = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
            out.append(t)
        return pd.Series(out, dtype=object)

    joined = rows.join(cuts, ["doc", "uid"], "left")
    n_lines = F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1, F.lit(0))
    # marked so that Spark doesn't run it a second time, in other workers, for a filter on what is left
    left = F.pandas_udf(rest, "string").asNondeterministic()
    return joined.select("row", left("text", "cuts").alias("text"), n_lines.alias("n_lines"), F.coalesce(F.size("cuts"), F.lit(0)).alias("n_removed"))
