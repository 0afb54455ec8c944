"""Importance resampling towards a target's distribution, with hashed features and a head-tail vocabulary.

The features of a text are its words and its pairs of neighbouring words; a feature's bucket is the CRC-32 of its UTF-8 bytes modulo
`buckets`. The head are the most frequent words, each with its number and its CRC state, and the most frequent pairs of them, each
with its bucket: a bounded table that all tasks get. A pair's CRC goes on from the state of its first word, so a pair outside the head
costs its second word alone; words outside the head take a direct CRC. Both ways give the same buckets, so the head decides speed and
nothing else. It is found in one pass over all texts: a task keeps at most `held` counts, lowering all when there are more, which loses
no word or pair that makes up more than 2 / held of the task's.

Bucket totals of corpus and target are exact sums over all texts; a bucket's gain is the logarithm of its share in the target over that
in the corpus, in thousandths, and a document's weight the mean of the gains of its features. Scores add Gumbel noise from a hash of
doc_id, so the highest scores are a draw without replacement by weight. Ranks come from counts per score (scores are integers in a
range that the buckets bound) and an order within equal scores, so no task sorts all rows.

Defined results: a null, empty or wordless text has no features and weight 0; documents with under `least_words` words have a score and are not
drawn; rows of one doc_id are documents of their own; a null doc_id hashes as an empty one and comes last among equals; an empty
target has equal shares; extra columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, free_model, model, to_bytes, write_table

#: A-Z become a-z; every byte that is no digit, letter or part of a character beyond ASCII becomes a space.
_FOLD = bytes(b if chr(b).isdigit() and b < 128 or 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_in(text: str | None) -> list[bytes]:
    return to_bytes(text).translate(_FOLD).split()


class _Counts:
    """The most frequent of many keys, in bounded memory."""

    def __init__(self, held: int):
        self.held, self.counts = held, Counter()

    def add(self, keys) -> None:
        self.counts.update(keys)
        if len(self.counts) > self.held:
            floor = int(np.partition(np.fromiter(self.counts.values(), np.int64, len(self.counts)), -(self.held // 2))[-(self.held // 2)])
            self.counts = Counter({k: n - floor for k, n in self.counts.items() if n > floor})


def head(docs: DataFrame, words: int, pairs: int, held: int) -> tuple[list[bytes], list[tuple[int, int]]]:
    """The head's words, and its pairs as numbers of words: at most `words` and `pairs`, whatever the texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        free_model()
        ones, twos = _Counts(held), _Counts(held)
        for batch in batches:
            for text in batch["text"]:
                found = words_in(text)
                for at in range(0, len(found), held):
                    ones.add(found[at : at + held])
                    twos.add(pairwise(found[at : at + held + 1]))
        top = [(a, None, n) for a, n in ones.counts.most_common(words) if n > 1] + [(a, b, n) for (a, b), n in twos.counts.most_common(pairs) if n > 1]
        for at in range(0, len(top), 50_000):
            yield pd.DataFrame(top[at : at + 50_000], columns=["a", "b", "n"])

    counted = write_table(docs.select("text").mapInPandas(run, "a binary, b binary, n long").groupBy("a", "b").agg(F.sum("n").alias("n")), "head-counts")

    def best(of: str, most: int) -> list:
        """The rows of the highest steps of frequency, a sixteenth of a doubling each, that have at most `most` rows together. A step is
        left out as a whole, so nothing is sorted and the driver gets no more than it keeps."""
        step = F.floor(16 * F.log2("n"))
        sizes, low, held = counted.filter(of).groupBy(step.alias("step")).agg(F.count("*").alias("rows")).collect(), None, 0
        for s in sorted(sizes, key=lambda s: -s["step"]):
            if held + s["rows"] > most:
                break
            low, held = s["step"], held + s["rows"]
        found = [] if low is None else counted.filter(of).filter(step >= low).collect()
        return sorted(found, key=lambda r: (-r["n"], bytes(r["a"]), bytes(r["b"] or b"")))

    ones = [bytes(r["a"]) for r in best("b IS NULL", words)]
    number = {w: i for i, w in enumerate(ones)}
    twos = [(number.get(bytes(r["a"])), number.get(bytes(r["b"]))) for r in best("b IS NOT NULL", pairs)]
    return ones, [(a, b) for a, b in twos if a is not None and b is not None]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        return -1


class Head:
    """Buckets of features, by the head where it has them."""

    def __init__(self, words: list[bytes], pairs: list[tuple[int, int]], buckets: int):
        self.buckets, self.number = buckets, _Numbers((w, i) for i, w in enumerate(words))
        self.states = np.fromiter(map(crc32, words), np.int64, len(words))
        self.bits = max(4, (2 * len(pairs)).bit_length() + 1)
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        if pairs:  # one place for each key; where keys share one, the most frequent has it
            a, b = np.asarray(pairs[::-1], np.int64).T
            keys = (a << 32) | b
            at = self._place(keys)
            self.keys[at] = keys
            put = self.keys[at] == keys
            self.values[at[put]] = [crc32(b" " + words[y], int(self.states[x])) % buckets for x, y in zip(a[put].tolist(), b[put].tolist(), strict=True)]

    def _place(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.int64(-0x61C8864680B583EB)) >> np.int64(64 - self.bits)) & np.int64((1 << self.bits) - 1)

    def features(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of all features of lists of words, text by text, and the number of features of each."""
        n = np.fromiter(map(len, texts), np.int64, len(texts))
        words = [w for t in texts for w in t]
        ids = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        states = self.states[ids] if len(self.states) else np.zeros(len(words), np.int64)
        tail = np.flatnonzero(ids < 0)
        states[tail] = [crc32(words[i]) for i in tail.tolist()]
        text = np.repeat(np.arange(len(texts)), n)
        first = np.flatnonzero(text[1:] == text[:-1])
        keys = (ids[first] << 32) | (ids[first + 1] & 0xFFFFFFFF)
        at = self._place(keys)
        twos = self.values[at]
        direct = np.flatnonzero((self.keys[at] != keys) | (ids[first] < 0) | (ids[first + 1] < 0))
        where = first[direct]
        twos[direct] = [crc32(b" " + words[i + 1], s) % self.buckets for i, s in zip(where.tolist(), states[where].tolist(), strict=True)]
        both = np.r_[states % self.buckets, twos]
        order = np.argsort(np.r_[text, text[first]], kind="stable")
        return both[order], n + np.maximum(n - 1, 0)


def _held(known: Broadcast) -> Head:
    return model(("head", known.value["key"]), lambda: Head(known.value["words"], known.value["pairs"], known.value["buckets"]))


def totals(docs: DataFrame, known: Broadcast) -> DataFrame:
    """(bucket, n): features of all texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = _held(known)
        counts = np.zeros(table.buckets, np.int64)
        for batch in batches:
            counts += np.bincount(table.features([words_in(t) for t in batch["text"]])[0], minlength=table.buckets)
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"bucket": at, "n": counts[at]})

    return docs.select("text").mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """Of each bucket: 1000 times the logarithm of its smoothed share in the target over that in the corpus, floored."""
    n, s, t = float(len(corpus)), float(sum(corpus)), float(sum(target))
    return [math.floor(1000 * math.log(((float(y) + 1) * (s + n)) / ((float(x) + 1) * (t + n)))) for x, y in zip(corpus, target, strict=True)]


def _weighed(docs: DataFrame, known: Broadcast, gain: list[int]) -> DataFrame:
    value = np.asarray(gain, np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = _held(known)
        for batch in batches:
            found, n = table.features([words_in(t) for t in batch["text"]])
            total = np.concatenate([[0], value[found].cumsum()])
            ends = n.cumsum()
            weight = np.where(n > 0, (total[ends] - total[ends - n]) // np.maximum(n, 1), 0)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_features": n, "weight": weight})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, "doc_id long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (25, 100), least_words: int = 20, seed: int = 7, buckets: int = 10_000, words: int = 20_000, pairs: int = 100_000, held: int = 200_000) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null where it isn't drawn."""
    spark = docs.sparkSession
    bound_batches(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    ones, twos = head(docs, words, pairs, held)
    known = spark.sparkContext.broadcast({"key": uuid.uuid4().hex, "words": ones, "pairs": twos, "buckets": buckets})
    sums = []
    for table in (docs, target.select(F.col("text").cast("string").alias("text"))):
        found = dict.fromkeys(range(buckets), 0) | {r["bucket"]: r["n"] for r in totals(table, known).collect()}  # a row for each bucket at most
        sums.append([found[b] for b in range(buckets)])
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))
    scored = write_table(_weighed(docs, known, gains(*sums)).withColumn("score", F.col("weight") + noise), "scores")
    able = F.col("n_features") >= 2 * least_words - 1 if least_words > 0 else F.lit(True)
    counts = write_table(scored.filter(able).groupBy("score").agg(F.count("*").alias("n")), "score-counts")
    most = (counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] * share[0]) // share[1]
    above = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a row for each score: at most the range of gains and noise, some 100,000, whatever the number of documents
    reached = F.broadcast(write_table(counts.select("score", above.alias("above")).filter(F.col("above") < most), "scores-reached"))
    among = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features")
    ranked = scored.filter(able).join(reached, "score").withColumn("rank", F.col("above") + F.row_number().over(among)).withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    rest = scored.filter(~able).unionByName(scored.filter(able).join(reached, "score", "left_anti").select(scored.columns)).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*scored.columns, "rank").unionByName(rest)
