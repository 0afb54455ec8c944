"""Checks of a tree of raw files that read only what has changed since they last ran."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..streaming.log import Log

#: Beyond so many changed files a run reads the tree and keeps the changed files' lines, instead of naming each file to the reader.
MOST_NAMED = 50_000


def _plain(path) -> F.Column:
    return F.regexp_replace(path, r"^file:/+", "/")


def listed_files(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """(file_name, size, modified) of the files under a folder, by Spark's own listing; no file is opened. A scan gives no row of an
    empty file, so those are told by the names that it lists (size and time 0)."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    filled = found.select(_plain(F.col("path")).alias("file_name"), F.col("length").alias("size"), F.unix_micros("modificationTime").alias("modified"))
    names = spark.createDataFrame([(f,) for f in found.inputFiles()], "path string").select(_plain(F.col("path")).alias("file_name"))
    empty = names.join(filled.select("file_name"), "file_name", "left_anti")
    return filled.unionByName(empty.select("file_name", F.lit(0).cast("bigint").alias("size"), F.lit(0).cast("bigint").alias("modified")))


def _lines(spark: SparkSession, root: str, pattern: str, changed: DataFrame, n: int) -> DataFrame:
    """Lines (file_name, value) of the changed files; a file without lines has one NULL row."""
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    named = [r["file_name"] for r in changed.select("file_name").collect()] if n <= MOST_NAMED else root
    text = reader.text(named).select(_plain(F.col("_metadata.file_path")).alias("file_name"), "value")
    return changed.select("file_name").join(text, "file_name", "left")


def verify_changed(spark: SparkSession, root: str, headers: dict[str, list[str]], state: str, pattern: str = "*.csv") -> dict:
    """`issues` (datatype, file_name, issue, n) of every file under `root`/datatype, and how many files were `listed` and `read`.

    `state` is a folder that holds, of each file, its size, its time and what was found, under a log; files that are listed there
    with the same size and time are not read again, and those that are gone are forgotten. Two runs over one state at a time: the
    later to commit fails.
    """
    log = Log(spark, state)
    seen, folders = len(log.entries()), log.live().get("files", [])
    known = spark.read.parquet(f"{state}/files/{folders[-1]}") if folders else None
    out, listed, read = None, 0, 0
    for kind, header in headers.items():
        files = listed_files(spark, f"{root}/{kind}", pattern).withColumn("datatype", F.lit(kind)).persist()
        try:
            total = files.count()
            on = ["datatype", "file_name", "size", "modified"]
            changed = files if known is None else files.join(known.select(*on), on, "left_anti")
            changed = changed.persist()
            n = changed.count()
            listed, read = listed + total, read + n
            part = None if known is None else known.join(files, on, "left_semi")
            if n:
                found = quality.file_issues(_lines(spark, f"{root}/{kind}", pattern, changed, n), header)
                fresh = changed.join(found, "file_name", "left").select(*on, "issue", "n")
                part = fresh if part is None else part.select(*on, "issue", "n").unionByName(fresh)
            if part is not None:
                name = f"part-{uuid.uuid4().hex}"
                part.select(*on, "issue", "n").write.parquet(f"{state}/scratch/{name}")
                part = spark.read.parquet(f"{state}/scratch/{name}")
                out = part if out is None else out.unionByName(part)
            changed.unpersist()
        finally:
            files.unpersist()
    if out is None:
        out = spark.createDataFrame([], "datatype string, file_name string, size long, modified long, issue string, n long")
    name = f"run={uuid.uuid4().hex}"
    out.write.parquet(f"{state}/files/{name}")
    log.commit({"files": [name]}, {"files": folders}, at=seen)
    kept = spark.read.parquet(f"{state}/files/{name}")
    return {"issues": kept.filter("issue IS NOT NULL").select("datatype", "file_name", "issue", "n"), "listed": listed, "read": read}
