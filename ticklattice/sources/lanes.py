"""Readers of the CSV tree `<root>/<datatype>/<symbol>/<date>/<file>.csv` and of the files beside it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import norm_symbol
from ..schemas import DIRECTORY, schema


def path_part(path: Column, from_end: int) -> Column:
    """A part of a path, 1 being the file name."""
    return F.element_at(F.split(path, "/"), -from_end)


def _names(values: list[str] | None) -> str:
    return "*" if not values else "{" + ",".join(sorted(values)) + "}"


def tape_place(path: Column, start: Column, row: Column) -> Column:
    """Place in a symbol's tape, files by name and rows by place in the file, as one BIGINT.

    From the top: 15 bits of the day of the directory, 14 of the two characters after the day in the file name (the hour of an
    hourly file; none in a daily one), 34 of the place in the file: where the task's stretch starts, in bytes, plus the row's number
    in the task. A row takes at least a byte and a stretch that is followed by another fills its task, so places rise in a file.
    Files whose names differ only later on, like several initial snapshots of a day, share a place; update ids tell them apart.
    """
    day = F.coalesce(F.datediff(F.try_to_date(path_part(path, 2)), F.lit("1970-01-01").cast("date")), F.lit(0))
    ahead = F.regexp_extract(path_part(path, 1), r"\d{4}-\d{2}-\d{2}_(.{2})", 1)
    code = lambda i: F.when(F.length(ahead) == 0, 0).otherwise(F.least(F.ascii(F.substring(ahead, i, 1)), F.lit(127)))
    file = F.shiftleft((F.greatest(day, F.lit(0)).cast("bigint") * 128 + code(1)) * 128 + code(2), 34)
    return file + start + row.bitwiseAND(F.lit((1 << 33) - 1))


def read_lane(spark: SparkSession, root: str, lane: str, symbols: list[str] | None = None, dates: list[str] | None = None, pattern: str = "*.csv", as_text: bool = False) -> DataFrame:
    """Rows of a lane with date, file_name and seq, the place in the symbol's tape; see tape_place.

    Only directories of the named symbols and dates are listed.
    """
    paths = f"{root}/{DIRECTORY[lane]}/{_names(symbols)}/{_names(dates)}/"
    rows = spark.read.schema(schema(lane, as_text)).option("header", True).option("enforceSchema", False).option("escape", '"').option("pathGlobFilter", pattern).csv(paths)
    path = F.col("_metadata.file_path")
    return rows.select("*", path_part(path, 2).alias("date"), path_part(path, 1).alias("file_name"), tape_place(path, F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("seq"))


def read_diffs(spark: SparkSession, root: str, symbols: list[str] | None = None, dates: list[str] | None = None) -> DataFrame:
    return read_lane(spark, root, "depth_updates", symbols, dates, "*depth_updates*.csv")


def read_snaps(spark: SparkSession, root: str, symbols: list[str] | None = None, dates: list[str] | None = None) -> DataFrame:
    return read_lane(spark, root, "depth_snapshot", symbols, dates, "*depth_snapshot*.csv")


def read_lines(spark: SparkSession, root: str, datatype: str, pattern: str = "*.csv") -> DataFrame:
    """Raw lines (file_name, value) of a datatype's files, for checks on the text itself; a file without lines has one NULL row.

    Spark reads nothing of empty files, so these are told by its own listing of the tree.
    """
    name = lambda c: F.regexp_replace(c, r"^file:/+", "/")
    text = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).text(f"{root}/{datatype}")
    lines = text.select(name(F.col("_metadata.file_path")).alias("file_name"), "value")
    listed = spark.createDataFrame([(f,) for f in text.inputFiles()], "path string").select(name(F.col("path")).alias("file_name"))
    empty = listed.join(lines.select("file_name").distinct(), "file_name", "left_anti")
    return lines.unionByName(empty.withColumn("value", F.lit(None).cast("string")))


#: Fields of the heartbeat, gap, request and resource files that the reports use.
HEARTBEAT = "timestamp DOUBLE, uptime_seconds BIGINT, messages_total BIGINT, messages_per_second DOUBLE, errors BIGINT, memory_mb DOUBLE, cpu_percent DOUBLE, active_symbols BIGINT, orderbooks_live BIGINT, _corrupt_record STRING"
GAP_EVENT = "type STRING, reason STRING, datetime_utc STRING, timestamp DOUBLE"
REQUEST = "timestamp DOUBLE, symbol STRING, endpoint_type STRING, proxy_name STRING, success BOOLEAN, latency_ms BIGINT"
SOAK = "ts_utc STRING, epoch BIGINT, uptime_s BIGINT, cpu_pct DOUBLE, cpu_cores DOUBLE, rss_mb DOUBLE, vmhwm_mb DOUBLE, fd BIGINT, conns BIGINT, reconnects BIGINT, msgs_total BIGINT, msg_per_s DOUBLE, errors BIGINT, ob_live BIGINT"
CONTRACTS = "symbols ARRAY<STRUCT<symbol: STRING, status: STRING, baseAsset: STRING, quoteAsset: STRING, underlyingType: STRING, contractType: STRING>>"


def read_heartbeats(spark: SparkSession, path: str) -> DataFrame:
    """Heartbeats; broken JSON is a row without a timestamp."""
    return spark.read.schema(HEARTBEAT).option("mode", "PERMISSIVE").option("multiLine", True).json(path)


def is_live(heartbeats: DataFrame, now_s: float, most_s: float = 15) -> DataFrame:
    """Adds age_s and live; a heartbeat without a timestamp is not live."""
    age = now_s - F.col("timestamp")
    return heartbeats.withColumns({"age_s": age, "live": F.coalesce(age < most_s, F.lit(False))})


def health(heartbeats: DataFrame, lane_health: DataFrame, now_s: float, most_s: float = 15) -> DataFrame:
    """One row: age and liveness of the newest heartbeat, its counts, and how many lanes are (all) healthy."""
    beat = is_live(heartbeats, now_s, most_s).agg(F.max_by(F.struct("age_s", "live", "messages_total", "errors", "active_symbols", "orderbooks_live"), "timestamp").alias("b"))
    lanes = lane_health.agg(F.count("*").alias("lanes"), F.count_if(F.col("healthy") >= F.col("seen")).alias("healthy_lanes"))
    return beat.join(lanes).select("b.age_s", F.coalesce("b.live", F.lit(False)).alias("live"), "b.messages_total", "b.errors", "b.active_symbols", "b.orderbooks_live", "lanes", "healthy_lanes")


def read_gap_events(spark: SparkSession, path: str, one_a_line: bool = False, symbol_of: int = 1) -> DataFrame:
    """Gap events, a JSON array or one_a_line, with the symbol that the file is named after, or the part of its path that symbol_of
    counts from the end (`symbol=x` or x)."""
    rows = spark.read.schema(GAP_EVENT).option("multiLine", not one_a_line).json(path)
    return rows.select(norm_symbol(F.regexp_extract(path_part(F.col("_metadata.file_path"), symbol_of), r"^(?:symbol=)?([A-Za-z0-9_]+)" if symbol_of > 1 else r"^([A-Za-z0-9]+)", 1)).alias("symbol"), *[c for c in rows.columns])


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(CONTRACTS).option("multiLine", True).json(path).select(F.explode("symbols").alias("c"))
    return rows.select(F.col("c.symbol").alias("symbol"), F.col("c.status").alias("status"), F.col("c.contractType").alias("contract_type"), F.col("c.underlyingType").alias("underlying_type"), F.col("c.baseAsset").alias("base_asset"), F.col("c.quoteAsset").alias("quote_asset"))


def read_exclusions(spark: SparkSession, lists: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Exclusion lists as (name) tables."""
    return {k: spark.createDataFrame([(x,) for x in names], "name string") for k, names in lists.items()}


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Log lines (file_name, modified_ms, seq, level, line); seq is the order in the file, level is NULL on continuation lines."""
    rows = spark.read.text(path).select(
        path_part(F.col("_metadata.file_path"), 1).alias("file_name"), F.unix_millis("_metadata.file_modification_time").alias("modified_ms"),
        (F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).alias("seq"), F.col("value").alias("line"),
    )
    return rows.withColumn("level", F.nullif(F.regexp_extract("line", r"\b(TRACE|DEBUG|INFO|WARN|ERROR)\b", 1), F.lit("")))


def read_soak(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SOAK).option("header", True).csv(path).withColumn("timestamp_ms", F.col("epoch") * 1000)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(REQUEST).json(path)
    return rows.select((F.col("timestamp") * 1000).cast("bigint").alias("timestamp_ms"), F.col("proxy_name").alias("route"), F.col("endpoint_type").alias("endpoint"), norm_symbol(F.col("symbol")).alias("symbol"), "success", "latency_ms")
