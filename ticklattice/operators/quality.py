"""Data-quality checks: row predicates and windows, reported as failure counts per symbol, day and lane.

A check is a registered CheckSpec; all row checks of a lane are counted in one pass, and only the checks that need order or
distinct values add a window or a distinct count. NaN and infinities count as numbers that don't parse.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import close_to, num, parse_iso
from ..schemas import DAY, MINUTE, RATIO_TYPES

KEY = ("symbol", "day_ms")
BARS = ("klines", "mark_price_klines", "index_price_klines", "premium_index_klines")


@dataclass(frozen=True)
class CheckSpec:
    """failed: a Column that is true on rows that fail; judged: rows the check looks at."""

    lane: str
    name: str
    failed: Column
    judged: Column | None = None

    def count(self) -> Column:
        bad = F.coalesce(self.failed, F.lit(True))
        return F.count_if(bad if self.judged is None else bad & F.coalesce(self.judged, F.lit(False)))


def _bounds() -> Column:
    o, h, l, c = (num(F.col(x)) for x in ("open", "high", "low", "close"))  # noqa: E741
    return ~((h >= l) & (h >= o) & (h >= c) & (l <= o) & (l <= c))


def row_checks() -> list[CheckSpec]:
    """The registered row checks."""
    n = lambda c: num(F.col(c))
    liq_ok = (n("price") > 0) & (n("quantity") > 0)
    taker_ok = (n("buy_volume") >= 0) & (n("sell_volume") >= 0)
    found = [CheckSpec(lane, "ohlc_bounds", _bounds()) for lane in BARS]
    return found + [
        CheckSpec("klines", "volume", ~(n("volume") >= 0)),
        CheckSpec("trades", "price_qty", ~((n("price") > 0) & (n("quantity") > 0))),
        CheckSpec("trades", "side", ~F.col("side").isin("buy", "sell")),
        CheckSpec("liquidations", "price_qty", ~liq_ok),
        CheckSpec("liquidations", "value", ~close_to(n("value"), n("price") * n("quantity"), 1e-6, 1e-4), liq_ok),
        CheckSpec("open_interest", "oi", ~(n("open_interest") >= 0)),
        CheckSpec("open_interest", "oi_value", ~close_to(n("oi_value"), n("open_interest") * n("mark_price"), 1.0, 1e-3), n("open_interest") >= 0),
        CheckSpec("funding_rates", "rate", ~(F.abs(n("funding_rate")) <= 0.03)),
        CheckSpec("long_short_ratio", "shares", F.abs(n("long_ratio") + n("short_ratio") - 1) > 0.02, n("long_ratio").isNotNull() & n("short_ratio").isNotNull()),
        CheckSpec("long_short_ratio", "ratio", ~close_to(n("long_ratio") / F.nullif(n("short_ratio"), F.lit(0.0)), n("long_short_ratio"), 1e-3, 1e-2), n("long_ratio").isNotNull() & (n("short_ratio") > 0)),
        CheckSpec("taker_buy_sell_ratio", "volumes", ~taker_ok),
        CheckSpec("taker_buy_sell_ratio", "ratio", ~close_to(n("buy_volume") / F.nullif(n("sell_volume"), F.lit(0.0)), n("buy_sell_ratio"), 1e-3, 1e-2), taker_ok & (n("sell_volume") > 0)),
    ]


def datetime_check(lane: str) -> CheckSpec:
    off = F.abs(parse_iso(F.col("datetime_utc")) - F.col("timestamp_ms")) > 1
    return CheckSpec(lane, "datetime", off)


def with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("day_ms", F.col("timestamp_ms") - F.pmod("timestamp_ms", F.lit(DAY)))


def long_form(counts: DataFrame, lane: str, checks: list[str]) -> DataFrame:
    """(symbol, day_ms, lane, check, failures) from one count column per check."""
    pairs = F.array(*[F.struct(F.lit(c).alias("check"), F.col(f"`{c}`").cast("bigint").alias("failures")) for c in checks])
    return counts.select(*KEY, F.lit(lane).alias("lane"), F.explode(pairs).alias("x")).select(*KEY, "lane", "x.check", "x.failures")


def row_failures(df: DataFrame, lane: str, checks: list[CheckSpec] | None = None) -> DataFrame:
    """All row checks of a lane in one aggregate."""
    checks = [c for c in (row_checks() if checks is None else checks) if c.lane == lane]
    if "datetime_utc" in df.columns:
        checks = [*checks, datetime_check(lane)]
    return long_form(with_day(df).groupBy(*KEY).agg(*[c.count().alias(c.name) for c in checks]), lane, [c.name for c in checks])


def missing_minutes(bars: DataFrame, step: int = MINUTE, by: tuple[str, ...] = KEY) -> DataFrame:
    """Per key: missing bars (not gaps), summed over the steps between different bars."""
    days = with_day(bars).select(*by, "timestamp_ms").distinct()
    after = F.lead("timestamp_ms").over(Window.partitionBy(*by).orderBy("timestamp_ms")) - F.col("timestamp_ms")
    return days.withColumn("s", after).groupBy(*by).agg(F.coalesce(F.sum(F.when(F.col("s") > step, F.floor(F.col("s") / step) - 1)), F.lit(0)).cast("bigint").alias("missing"), F.count("*").alias("bars"))


def gap_events(bars: DataFrame, step: int = MINUTE) -> DataFrame:
    """Per symbol: gap events and distinct bars."""
    once = bars.select("symbol", "timestamp_ms").distinct()
    after = F.lead("timestamp_ms").over(Window.partitionBy("symbol").orderBy("timestamp_ms")) - F.col("timestamp_ms")
    return once.withColumn("s", after).groupBy("symbol").agg(F.count_if(F.col("s") != step).alias("gaps"), F.count("*").alias("bars"))


def repeated_timestamps(bars: DataFrame) -> DataFrame:
    """Per key: rows beyond the first of their timestamp."""
    return with_day(bars).groupBy(*KEY, "timestamp_ms").agg(F.count("*").alias("n")).groupBy(*KEY).agg(F.sum(F.col("n") - 1).alias("failures"))


def repeated_ids(trades: DataFrame) -> DataFrame:
    """Per key: trades beyond the first of their id, compared as text; a missing id is ''."""
    ids = with_day(trades).withColumn("id", F.coalesce(F.col("trade_id").cast("string"), F.lit("")))
    return ids.groupBy(*KEY, "id").agg(F.count("*").alias("n")).groupBy(*KEY).agg(F.sum(F.col("n") - 1).alias("failures"))


def falling_ids(trades: DataFrame, order: str = "seq") -> DataFrame:
    """Per key: trades whose id is below the last parsed one before them in the tape."""
    ids = with_day(trades).withColumn("id", F.col("trade_id").try_cast("bigint"))
    before = F.last("id", ignorenulls=True).over(Window.partitionBy(*KEY).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return ids.withColumn("b", before).groupBy(*KEY).agg(F.count_if(F.col("id") < F.col("b")).alias("failures"))


def missing_ratio_types(df: DataFrame) -> DataFrame:
    """Per key: ratio types that never occur."""
    kind = F.when(F.col("ratio_type").isin(*RATIO_TYPES), F.col("ratio_type"))
    return with_day(df).groupBy(*KEY).agg((F.lit(len(RATIO_TYPES)) - F.countDistinct(kind)).cast("bigint").alias("failures"))


def run_checks(df: DataFrame, lane: str, step: int = MINUTE, checks: list[CheckSpec] | None = None) -> DataFrame:
    """All checks of a lane: (symbol, day_ms, lane, check, failures)."""
    named = lambda counts, check: counts.select(*KEY, F.lit(lane).alias("lane"), F.lit(check).alias("check"), "failures")
    out = row_failures(df, lane, checks)
    if lane in BARS:
        out = out.unionByName(named(missing_minutes(df, step).withColumnRenamed("missing", "failures"), "missing_minutes"))
        out = out.unionByName(named(repeated_timestamps(df), "unique_timestamps"))
    if lane == "trades":
        out = out.unionByName(named(repeated_ids(df), "unique_ids")).unionByName(named(falling_ids(df), "monotone_ids"))
    if lane == "long_short_ratio":
        out = out.unionByName(named(missing_ratio_types(df), "ratio_types"))
    return out


def lane_reports(df: DataFrame, checks: DataFrame) -> DataFrame:
    """(symbol, day_ms, lane, rows, failures, ok) of a lane's checks."""
    rows = with_day(df).groupBy(*KEY).agg(F.count("*").alias("rows"))
    total = checks.groupBy(*KEY, "lane").agg(F.sum("failures").alias("failures"), F.bool_and(F.col("failures") == 0).alias("ok"))
    return total.join(rows, list(KEY)).select(*KEY, "lane", "rows", "failures", "ok")


def book_verdict(continuity: DataFrame, rebuilt: DataFrame, seed_crossed: DataFrame, handoff: DataFrame | None = None) -> DataFrame:
    """(symbol, ok): no breaks, diffs applied, never crossed, seed not crossed, no broken handoff."""
    met = continuity.join(rebuilt, "symbol").join(seed_crossed.select("symbol", "seed_crossed"), "symbol", "left")
    ok = (F.col("breaks") == 0) & (F.col("applied") > 0) & (F.col("crossed") == 0) & ~F.coalesce("seed_crossed", F.lit(False))
    if handoff is not None:
        broken = handoff.groupBy("symbol").agg(F.bool_or(F.coalesce(F.col("handoff") == "break", F.lit(False))).alias("handoff_break"))
        met = met.join(broken, "symbol", "left")
        ok = ok & ~F.coalesce("handoff_break", F.lit(False))
    return met.select("symbol", "breaks", "applied", "crossed", ok.alias("ok"))


def verdicts(reports: DataFrame, books: DataFrame | None = None) -> DataFrame:
    """(symbol, day_ms, lanes, rows, failures, verdict): `clean` or `issues` over all lanes, and the symbol's book."""
    out = reports.groupBy(*KEY).agg(F.count("*").alias("lanes"), F.sum("rows").alias("rows"), F.sum("failures").alias("failures"), F.bool_and("ok").alias("ok"))
    if books is not None:
        out = out.join(books.select("symbol", F.col("ok").alias("book_ok")), "symbol", "left").withColumn("ok", F.col("ok") & F.coalesce("book_ok", F.lit(True))).drop("book_ok")
    return out.withColumn("verdict", F.when(F.col("ok"), "clean").otherwise("issues")).drop("ok")


def require_rows(df: DataFrame, what: str = "no data") -> DataFrame:
    """df, or ValueError if it has no rows."""
    if df.isEmpty():
        raise ValueError(what)
    return df


def file_issues(lines: DataFrame, header: Callable[[str], list[str]] | list[str], separator: str = ",") -> DataFrame:
    """(file_name, issue, n) of raw CSV lines (file_name, value): empty files, rows of another width, repeated headers."""
    head = separator.join(header)
    fields = F.size(F.split(F.regexp_replace("value", r'"([^"]|"")*"', "q"), separator))
    counts = lines.groupBy("file_name").agg(
        F.count_if(F.length("value") > 0).alias("n"), F.count_if(F.col("value") == head).alias("heads"),
        F.count_if((F.length("value") > 0) & (F.col("value") != head) & (fields != len(header))).alias("ragged"),
    )
    found = F.array(
        F.struct(F.lit("empty").alias("issue"), F.when(F.col("n") <= F.least(F.col("heads"), F.lit(1)), 1).otherwise(0).cast("bigint").alias("n")),
        F.struct(F.lit("row_width").alias("issue"), F.col("ragged").alias("n")),
        F.struct(F.lit("repeated_header").alias("issue"), F.greatest(F.col("heads") - 1, F.lit(0)).cast("bigint").alias("n")),
    )
    return counts.select("file_name", F.explode(found).alias("x")).select("file_name", "x.issue", "x.n").filter("n > 0")


def issue_list(issues: DataFrame, most: int = 100) -> DataFrame:
    """The first issues by file, for a report."""
    return issues.orderBy("file_name", "issue").limit(most)
