"""Continuous ingest: text messages to lanes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.filters import drop_unpersisted
from ..schemas import schema
from ..sources import messages as wire
from ..sources.sinks import write_diffs, write_lane
from .log import Log

#: The lanes that a stream of messages fills.
LANES_OF_STREAM = ("depth_updates", "trades", "klines", "liquidations")


def lanes_of(batch: DataFrame, universe: DataFrame | None = None) -> dict[str, DataFrame]:
    """Lane rows of a batch of raw messages, and the messages that no lane takes."""
    routed = wire.route(wire.parse_messages(batch))
    return {
        "depth_updates": wire.to_diffs(routed["depthUpdate"]), "trades": wire.to_trades(routed["aggTrade"]).dropDuplicates(["symbol", "trade_id"]), "klines": wire.to_klines(routed["kline"]),
        "liquidations": wire.to_liquidations(routed["forceOrder"], universe), "dropped": routed["dropped"],
    }


def start_ingest(source: DataFrame, lake: str, checkpoint: str, universe: DataFrame | None = None, unpersisted: DataFrame | None = None, once: bool = False, interval: str = "5 seconds") -> StreamingQuery:
    """Appends the lanes of a stream of raw messages (value) under `lake`; each micro-batch is parsed once and fanned out, diffs
    sorted by update id. A batch's files land in folders of its own number, and an entry of the lake's log makes them rows when
    all are there: a batch that is tried again writes the same folders, and adds no entry if it has one."""

    def put(batch: DataFrame, number: int) -> None:
        log = Log(batch.sparkSession, lake)
        if number in log.batches():
            return
        seen = batch.observe("messages", F.count("*").alias("n")).persist()
        try:
            for lane, rows in lanes_of(seen, universe).items():
                if lane == "dropped":
                    rows.write.mode("overwrite").parquet(f"{lake}/dropped/batch={number}")
                    continue
                if unpersisted is not None and lane in ("trades", "depth_updates"):
                    rows = drop_unpersisted(rows, unpersisted)
                if lane == "depth_updates":
                    write_diffs(rows, lake, "overwrite", f"{lane}/batch={number}")
                else:
                    write_lane(rows, lake, f"{lane}/batch={number}", "overwrite")
            log.commit({lane: [f"batch={number}"] for lane in (*LANES_OF_STREAM, "dropped")}, batch=number)
        finally:
            seen.unpersist()

    stream = source.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if once else stream.trigger(processingTime=interval)).start()


def read_lake(spark: SparkSession, lake: str, lane: str) -> DataFrame:
    """A lane of all committed batches, or of the whole folder where the lake has no log; repeats of a trade across batches are dropped."""
    folders = Log(spark, lake).live()
    if not folders:
        rows = spark.read.parquet(f"{lake}/{lane}")
    else:
        held = [f"{lake}/{lane}/{name}" for name in folders.get(lane, [])]
        rows = read_folders(spark, held) if held else spark.createDataFrame([], schema(lane))
    return rows.dropDuplicates(["symbol", "trade_id"]) if lane == "trades" else rows


def read_folders(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Folders of one lane, each with its own directories. Folders without a row have no columns and are left out."""
    parts = [df for df in (spark.read.parquet(f) for f in folders if _has_rows(spark, f)) if df.columns]
    if not parts:
        raise ValueError("no rows in the lake")
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def _has_rows(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return any(not s.getPath().getName().startswith(("_", ".")) for s in files.listStatus(path))


def compact(spark: SparkSession, lake: str, lane: str, least: int = 2) -> str | None:
    """Merges a lane's folders, if there are at least so many, into one of sorted files by date (and hour, of diffs); repeats of a trade go.

    The new folder is written whole under a name of its own, then one entry of the log adds it and removes the old ones: readers
    see either these or that. A job that is cut short before leaves a folder that no entry names; one that finds that others have
    changed the log since it started fails, and is run again.
    """
    log = Log(spark, lake)
    seen, folders = len(log.entries()), log.live().get(lane, [])
    if len(folders) < least:
        return None
    held = [f"{lake}/{lane}/{name}" for name in folders if _has_rows(spark, f"{lake}/{lane}/{name}")]
    name = f"merged={uuid.uuid4().hex}"
    if held:
        rows = read_folders(spark, held)
        rows = rows.drop(*[c for c in ("date", "hour") if c in rows.columns])
        if lane == "depth_updates":
            write_diffs(rows, lake, "overwrite", f"{lane}/{name}")
        else:
            write_lane(rows.dropDuplicates(["symbol", "trade_id"]) if lane == "trades" else rows, lake, f"{lane}/{name}", "overwrite")
    log.commit({lane: [name] if held else []}, {lane: folders}, at=seen)
    return name


def stream_metrics(messages: DataFrame) -> DataFrame:
    """Running counts per event type, for output mode `complete` or `update`; rates come from counter_rate over the history."""
    return messages.groupBy("event_type").agg(F.count("*").alias("messages"))


def pending_listings(changes: DataFrame, table: DataFrame | None, now_ms: int) -> DataFrame:
    """The small table of new listings (symbol, since_ms) after a batch of lifecycle changes; removed symbols leave it."""
    last = changes.groupBy("symbol").agg(F.max_by("change", "cycle").alias("change"))
    added = last.filter("change = 'added'").select("symbol", F.lit(now_ms).cast("bigint").alias("since_ms"))
    if table is None:
        return added
    kept = table.join(last.filter("change = 'removed'"), "symbol", "left_anti")
    return kept.unionByName(added.join(kept.select("symbol"), "symbol", "left_anti"))
