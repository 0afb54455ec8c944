"""Writers of lanes and reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import partition_parts
from ..operators.filters import check_selection, time_slice
from ..operators.windows import signed_price


def _with_parts(df: DataFrame, *names: str) -> DataFrame:
    parts = partition_parts(F.col("timestamp_ms"))
    return df.withColumns({n: parts[n] for n in names if n not in df.columns})


def write_lane(df: DataFrame, root: str, lane: str, mode: str = "append") -> None:
    """Parquet by date, clustered by symbol and time; a replay overwrites only the dates it holds. Rows of a date are dealt by
    symbol and hour, so that a busy day is not one task's."""
    rows = _with_parts(df, "date", "hour").repartition("date", "hour", "symbol").drop(*([] if "hour" in df.columns else ["hour"]))
    order = [c for c in ("symbol", "timestamp_ms", "seq") if c in df.columns]
    rows.sortWithinPartitions("date", *order).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(f"{root}/{lane}")


def write_diffs(df: DataFrame, root: str, mode: str = "append", lane: str = "depth_updates") -> None:
    """Diffs by date and hour, in update-id order within each file."""
    rows = _with_parts(df, "date", "hour").repartition("date", "hour", "symbol").sortWithinPartitions("date", "hour", "symbol", "last_update_id")
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("date", "hour").parquet(f"{root}/{lane}")


def write_snaps(df: DataFrame, root: str, mode: str = "append") -> None:
    """One row per level, of each snapshot the bids from high to low, then the asks from low to high."""
    rows = _with_parts(df, "date").repartition("date", "symbol", "last_update_id").sortWithinPartitions("date", "symbol", "last_update_id", F.col("side").desc(), signed_price())
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(f"{root}/depth_snapshot")


def export_bundle(lanes: dict[str, DataFrame], symbols: list[str], types: list[str], from_ms: int, to_ms: int, path: str | None = None) -> dict[str, DataFrame]:
    """Native rows of the selection, by part; `orderbooks` is two parts. With a path, each part is written as CSV by symbol.
    Raises ValueError if nothing is selected."""
    check_selection(from_ms, to_ms, symbols, types)
    names = [p for t in types for p in (("depth_updates", "depth_snapshot") if t == "orderbooks" else (t,)) if p in lanes]
    wanted = [s.lower() for s in symbols]
    parts = {p: time_slice(lanes[p].filter(F.lower("symbol").isin(wanted)), from_ms, to_ms) for p in names}
    if all(df.isEmpty() for df in parts.values()):
        raise ValueError("no data in the selection")
    if path:
        for p, df in parts.items():
            df.repartition("symbol").sortWithinPartitions("symbol", "timestamp_ms").write.mode("overwrite").partitionBy("symbol").option("header", True).csv(f"{path}/{p}")
    return parts


def write_matrix(df: DataFrame, path: str) -> None:
    """A feature matrix as one CSV in time order (31 days of minutes at most); missing cells are empty."""
    df.orderBy("timestamp_ms").coalesce(1).write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def export_book(book: DataFrame, path: str | None = None) -> DataFrame:
    """A book in export order: bids from high to low, asks from low to high."""
    out = book.orderBy("symbol", F.col("side").desc(), signed_price())
    if path:
        out.write.mode("overwrite").option("header", True).csv(path)
    return out


def heartbeat(spark, report: Callable[[dict], None]):
    """Attaches a listener that reports each micro-batch's counts, rates and observed metrics; returns it."""
    from pyspark.sql.streaming import StreamingQueryListener

    class Heartbeat(StreamingQueryListener):
        def onQueryStarted(self, event):
            report({"kind": "started", "id": str(event.id), "name": event.name})

        def onQueryProgress(self, event):
            p = event.progress
            seen = {name: row.asDict() for name, row in p.observedMetrics.items()}
            report({"kind": "progress", "name": p.name, "batch": p.batchId, "rows": p.numInputRows, "rows_per_s": p.processedRowsPerSecond, "observed": seen})

        def onQueryIdle(self, event):
            report({"kind": "idle", "id": str(event.id)})

        def onQueryTerminated(self, event):
            report({"kind": "terminated", "id": str(event.id), "error": event.exception})

    listener = Heartbeat()
    spark.streams.addListener(listener)
    return listener
