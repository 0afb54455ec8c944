"""Which directories of a lake (`date=`, `hour=`) a book needs, told to the scan before it lists their files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DAY, HOUR


def _date(hours: Column) -> Column:
    """The day of a number of hours since 1970, in UTC whatever the session's zone."""
    return F.date_from_unix_date(F.floor(hours / 24).cast("int"))


def in_days_to(rows: DataFrame, t: int | None) -> DataFrame:
    """Rows of t's day and the day before, by their directories; all rows where t is None or there are no directories."""
    if t is None or "date" not in rows.columns:
        return rows
    return rows.filter(F.col("date").cast("date").between(F.date_from_unix_date(F.lit((t - DAY) // DAY)), F.date_from_unix_date(F.lit(t // DAY))))


def since_anchors(rows: DataFrame, anchors: DataFrame, t: int | None) -> DataFrame:
    """Rows of the directories from the first anchor's hour (anchors: anchor_ms) on.

    With a t, each hour that some symbol's anchor leads to is named, at most 48 of them as anchors are of t's day or the day before:
    a table of proven size that is broadcast, and by which Spark prunes directories as it runs. Without one, the oldest anchor's hour
    is a subquery that Spark answers before it lists files.
    """
    if "date" not in rows.columns:
        return rows
    first = F.floor(F.col("anchor_ms") / HOUR)
    if t is None:
        day = anchors.agg(F.min(_date(first))).scalar()
        rows = rows.filter(F.col("date").cast("date") >= day)
        return rows.filter(F.unix_date(F.col("date").cast("date")) * 24 + F.col("hour") >= anchors.agg(F.min(first)).scalar()) if "hour" in rows.columns else rows
    # one key of both directory columns: of two keys Spark would prune each by itself, and read every pairing
    of = (lambda h: F.floor(h / 24)) if "hour" not in rows.columns else lambda h: h
    hours = anchors.filter(F.col("anchor_ms") <= t).select(F.explode(F.sequence(first, F.lit(t // HOUR))).alias("_h")).select(of(F.col("_h")).alias("_h")).distinct()
    own = F.unix_date(F.col("date").cast("date")).cast("bigint")
    return rows.join(F.broadcast(hours), (own * 24 + F.col("hour") if "hour" in rows.columns else own) == F.col("_h"), "left_semi")
