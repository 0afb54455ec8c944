"""Best-fit packing by hierarchical residual packing.

Texts become token pieces; each partition packs its pieces by best fit; bins that are nearly full are final and the rest
go on as items of the next round, over as many partitions as they fill. Where they still fill several, rounds end when one saves
under a hundredth of its bins, for what is left then doesn't fit together; a single partition's worth is packed once more.

Defined results: null and empty texts are one piece that holds only the end id; repeated rows are packed each; a null
doc_id is kept, a doc_id must be a whole number; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, free_model, model, partitions_for, release, write_table

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Fixed value: the split pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Ids of a text as packed little-endian 32-bit numbers.

    The vocabulary of the tokenizers file, whose ids are in merge order, is given to tiktoken, which takes a third of the time.
    Both split texts by the same pattern and then merge the pair of least rank first, so the ids are those of tokenizers; the
    tests hold both against each other over all code points, all borders between kinds of characters and the whole vocabulary.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        slow = Tokenizer.from_file(path)
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(map(byte_of.__getitem__, token)): i for token, i in slow.get_vocab(with_added_tokens=False).items() if all(c in byte_of for c in token)}
        for token in slow.get_added_tokens_decoder().values():  # their strings in a text are ordinary text
            ranks.pop(token.content.encode(), None)
        self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", self.fast.encode_ordinary(t)).tobytes() for t in texts]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids: all of `capacity`, but the first, which may be shorter."""
    first = n % capacity or capacity
    return [(0, min(n, first))] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Each text's ids, then end_id; documents of more than `capacity` ids are cut."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end = model(("tokens", tokenizer_path), lambda: Encoder(tokenizer_path)), np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at : at + 512]
                rows = []
                for doc, ids in zip(part["doc_id"], encoder.encode([t if isinstance(t, str) else "" for t in part["text"]]), strict=True):
                    ids += end
                    for k, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                        rows.append((doc, k, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)])))
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": "Int64"})
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best fit in falling order of length: bin and offset of each item, and the bins' fills."""
    bins, offsets, room_of = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin with r free places is open
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(room_of)
            room_of.append(capacity)
        bins[i], offsets[i] = b, capacity - room
        room_of[b] = room = room - n
        if room:
            if not open_bins[room]:
                rooms |= 1 << room
            open_bins[room].append(b)
    return bins, offsets, [capacity - r for r in room_of]


def _round(items: DataFrame, number: int, capacity: int, chunk: int) -> DataFrame:
    """Adds bin, offset and fill to rows of (item, length, ...); each task packs its rows in chunks of bounded size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        free_model()
        base, held, count = (number << 56) + (TaskContext.get().partitionId() << 32), [], 0

        def packed() -> pd.DataFrame:
            nonlocal base
            part = pd.concat(held, ignore_index=True)
            part = part.sort_values([c for c in ("length", "item", "doc_id", "piece") if c in part], kind="stable", ignore_index=True)
            bins, offsets, fills = best_fit(part["length"].to_numpy(np.int64), capacity)
            part = part.assign(bin=bins + base, offset=offsets, fill=np.asarray(fills, np.int64)[bins])
            if "item" not in part:
                part["item"] = np.arange(len(part)) + base + (1 << 55)
            base += len(part)
            return part[names]

        for batch in batches:
            held.append(batch)
            count += len(batch)
            if count >= chunk:
                yield packed()
                held, count = [], 0
        if held:
            yield packed()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema)
    schema += ("" if "item" in items.columns else ", item long") + ", bin long, offset long, fill long"
    names = [x.split()[0] for x in schema.split(", ")]
    return items.mapInPandas(run, schema)


def pack(pieces: DataFrame, capacity: int = 2048, slack: int = 12, items_per_task: int = 50_000, gain: float = 0.01) -> DataFrame:
    """Adds sequence_id and offset to pieces.

    A bin with at most `slack` free places is final. Of the others, one at least half full is an item of the next round, and
    the pieces of an emptier one are items again by themselves.
    """
    pieces = write_table(pieces, "pieces")
    tasks = partitions_for(pieces.count(), items_per_task)
    spread = F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id())
    first = write_table(_round(pieces.withColumn("deal", spread).repartition(tasks, "deal").drop("deal"), 1, capacity, 4 * items_per_task), "bins-1")
    full, half = F.col("fill") >= capacity - slack, F.col("fill") * 2 >= capacity
    bins = first.filter(half & ~full).select(F.col("bin").alias("item"), F.col("fill").alias("length")).distinct()
    loose = first.filter(~half).select("item", "length", "bin", "offset")
    placed, moves, before, number = None, None, None, 1
    while tasks > 1 or number == 1:
        left = write_table(bins.withColumn("loose", F.lit(False)).unionByName(loose.select("item", "length", F.lit(True).alias("loose"))), f"left-{number}")
        count = left.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("b")).first()
        tasks = partitions_for(count["n"], items_per_task)
        if count["n"] < 2 or tasks > 1 and before is not None and before - count["n"] < gain * before:
            break
        before, number = count["n"], number + 1
        merged = write_table(_round(left.repartition(tasks, "item"), number, capacity, 4 * items_per_task), f"bins-{number}")
        settled = merged.filter(F.col("loose") & half).select("item", "bin", "offset")
        placed = settled if placed is None else placed.unionByName(settled)
        loose = merged.filter(~half & F.col("loose")).select("item", "length", "bin", "offset")
        step = merged.filter(~F.col("loose")).select("item", F.col("bin").alias("to"), F.col("offset").alias("by"))
        if moves is None:
            moves = step
        else:
            later = step.select(F.col("item").alias("to"), F.col("to").alias("to2"), F.col("by").alias("by2"))
            old = moves.join(later, "to", "left").select("item", F.coalesce("to2", "to").alias("to"), (F.col("by") + F.coalesce("by2", F.lit(0))).alias("by"))
            moves = write_table(old.unionByName(step), f"moves-{number}")
        bins = merged.filter(half & ~full).select(F.col("bin").alias("item"), F.col("fill").alias("length")).distinct()
    out = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if moves is None:
        return first.select(*out, F.col("bin").alias("sequence_id"), "offset")
    again = loose.select("item", F.col("bin").alias("bin2"), F.col("offset").alias("offset2")).unionByName(placed.toDF("item", "bin2", "offset2"))
    rows = first.join(again, "item", "left").select(*out, F.coalesce("bin2", "bin").alias("bin"), F.coalesce("offset2", "offset").alias("offset"))
    joined = rows.join(moves.withColumnRenamed("item", "bin"), "bin", "left")
    return joined.select(*out, F.coalesce("to", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("by", F.lit(0))).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048) -> DataFrame:
    """Packs all texts into sequences of at most `capacity` tokens."""
    return pack(token_pieces(docs, tokenizer_path, capacity), capacity)
