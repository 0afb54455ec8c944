"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_ID = -(2**63)
U64 = np.uint64
#: Bytes up to which a table is broadcast.
SMALL = 32_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession, most: str = "2m", rows: int = 1000) -> None:
    """Bounds the Arrow batches that Python workers get, unless the session does so itself: rows of text may be very long."""
    for key, value in (("maxBytesPerBatch", most), ("maxRecordsPerBatch", str(rows))):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}", None) is None:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", value)


def release() -> None:
    """Gives memory that a worker has freed back to the system; workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL(None).malloc_trim(0)


_model: list[Any] = [None, None]


def model(key: Any, make: Callable[[], Any]) -> Any:
    """make(), held for a worker's next task with this key. A worker holds one model at a time, and free_model() drops it."""
    if _model[0] != key:
        free_model()
        _model[:] = key, make()
    return _model[1]


def free_model() -> None:
    """Called at the start of tasks that need no model: what an earlier stage left in the worker goes."""
    if _model[0] is not None:
        _model[:] = None, None
        release()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. In a local session, where all is one machine, it may be
    unset and an own folder is taken; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes df to the shared folder and reads it back, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def place_in_file(scan: DataFrame) -> Column:
    """A row's id from its file and its place there, for a DataFrame read from Parquet files: the same in every pass, unique, and
    rising with the place in a file."""
    meta = scan.metadataColumn("_metadata")
    return F.xxhash64(meta["file_path"]).bitwiseAND(F.lit(2**62 - 1)) + meta["row_index"]


def identified(docs: DataFrame, uid: Column | None, *columns: Column) -> DataFrame:
    """doc (doc_id; null: NULL_ID), uid and the columns. Without a uid the rows are numbered once and written."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc")
    if uid is None:
        return write_table(docs.select(doc, F.monotonically_increasing_id().alias("uid"), *columns), "numbered")
    return docs.select(doc, uid.alias("uid"), *columns)


def _bytes(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value).cast("long") + 16
    elif isinstance(kind, T.StructType):
        size = F.lit(8).cast("long")
        for field in kind.fields:
            size = size + _bytes(value[field.name], field.dataType)
    elif isinstance(kind, T.ArrayType):
        size = F.aggregate(value, F.lit(24).cast("long"), lambda sum_, x: sum_ + _bytes(x, kind.elementType))
    elif isinstance(kind, T.MapType):
        size = _bytes(F.map_keys(value), T.ArrayType(kind.keyType)) + _bytes(F.map_values(value), T.ArrayType(kind.valueType))
    else:
        return F.lit(8).cast("long")
    return F.coalesce(size, F.lit(8).cast("long"))


def bytes_in_memory(table: DataFrame) -> Column:
    """A row's size as Spark holds it, lists, structs and texts by what they hold."""
    size = F.lit(16).cast("long")
    for field in table.schema.fields:
        size = size + _bytes(F.col(f"`{field.name}`"), field.dataType)
    return size


def if_small(table: DataFrame, rows: int = 500_000, size: int = SMALL) -> DataFrame:
    """A written table, marked for broadcast if it is counted to have at most `rows` rows and these to take at most `size` bytes; beyond,
    joins shuffle it. Only tables of so few rows are read for their size."""
    if table.count() > rows:
        return table
    return F.broadcast(table) if table.agg(F.coalesce(F.sum(bytes_in_memory(table)), F.lit(0)).alias("b")).first()["b"] <= size else table


def partitions_for(rows: int, rows_per_partition: int) -> int:
    """Partitions that hold about rows_per_partition each, never fewer than one."""
    return max(1, -(-rows // rows_per_partition))


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def to_bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


class WordHashes(dict):
    """word -> 64-bit hash; cleared at `cap` entries so that a worker's memory stays bounded."""

    cap = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.cap:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_words = WordHashes()


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, runs of characters other than space and \\x09-\\x0D."""
    return to_bytes(text).lower().split()


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, applied elementwise."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


_MULT = U64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """64-bit hashes of all runs of `width` words, in text order; with fewer words the whole sequence is one shingle."""
    words = words_of(text)
    if not words:
        return np.empty(0, U64)
    h = np.fromiter(map(_words.__getitem__, words), U64, len(words))
    width_used = min(width, len(h))
    n = len(h) - width_used + 1
    with np.errstate(over="ignore"):
        acc = np.full(n, width_used, U64)
        for i in range(width_used):
            acc = (acc ^ h[i : i + n]) * _MULT
            acc = acc ^ (acc >> U64(29))
        return mix64(acc)
