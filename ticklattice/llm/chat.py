"""Chat formatting by quotation linking, with DataFrame functions.

A message's lines are parsed for nested quote marks (`>`); a run of lines of one level is a passage. Quoted passages and
the lines of every message's own text are hashed in normalised form (case, white space and marks folded), and each quoted
passage is joined by itself to the latest earlier message of its conversation whose own text holds it. A message replies to
the source of its outermost linked passages, the latest where these have several; without one it replies to the turn before. Conversations are returned in reply order:
a reply follows its parent and the parent's earlier replies, quotes removed.

The join is keyed by conversation and line hash, so a text that opens many conversations is no hot key, and a match is
confirmed by the share of the passage's lines found. Quotes that follow each other at one level without a line between them
are one passage.

Defined results: null text has no passages and stays null; an empty text stays empty; text that is all quotes becomes empty;
a null conv_id or turn keeps its row, replies to nothing and has position 0; rows of one turn share its position and its
parent; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import write_table

QUOTE = r"^\s*((?:>\s?)+)"


def normalised(line: Column) -> Column:
    """Form in which quoted and original lines are compared."""
    return F.trim(F.regexp_replace(F.lower(line), r"[\s\p{Punct}]+", " "))


def quote_level(line: Column) -> Column:
    marks = F.regexp_extract(line, QUOTE, 1)
    return F.length(F.regexp_replace(marks, r"[^>]", ""))


def line_key(line: Column) -> Column:
    """Hash of a line's normalised form without quote marks; null where nothing is left to compare."""
    form = normalised(F.regexp_replace(line, QUOTE, ""))
    return F.when(F.length(form) > 0, F.xxhash64(form))


def quoted_passages(turns: DataFrame) -> DataFrame:
    """Each run of lines of one level above 0: uid, conv_id, turn, passage (place of its first line), level, keys (distinct)."""
    lines = F.split("text", "\r?\n")
    rows = turns.filter(F.col("text").rlike(r"(?m)^\s*>")).select("uid", "conv_id", "turn", lines.alias("lines"), F.transform(lines, quote_level).alias("levels"))
    starts = F.filter(F.sequence(F.lit(0), F.size("levels") - 1), lambda i: (i == 0) | (F.get("levels", i) != F.get("levels", i - 1)))
    rows = rows.withColumn("starts", starts)

    def passage(first: Column, n: Column) -> Column:
        end = F.coalesce(F.get("starts", n + 1), F.size("lines"))
        keys = F.transform(F.slice("lines", first + 1, end - first), line_key)
        return F.struct(first.alias("passage"), F.get("levels", first).alias("level"), F.array_distinct(F.array_compact(keys)).alias("keys"))

    return rows.select("uid", "conv_id", "turn", F.inline(F.transform("starts", passage))).filter("level > 0")


def own_lines(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, key) of the different lines that are no quotes."""
    lines = turns.select("conv_id", "turn", F.explode(F.split("text", "\r?\n")).alias("line")).filter(quote_level(F.col("line")) == 0)
    return lines.select("conv_id", "turn", line_key(F.col("line")).alias("key")).filter("key is not null").distinct()


def quote_links(turns: DataFrame, least: float = 0.5) -> DataFrame:
    """(uid, conv_id, turn, passage, level, source_turn, found, of): per quoted passage, the latest of the earlier turns that
    hold most of its lines, and at least `least` of them."""
    of = ["uid", "conv_id", "at", "passage", "level", "of"]
    quoted = quoted_passages(turns).withColumnRenamed("turn", "at").withColumn("of", F.size("keys"))
    wanted, held = quoted.select(*of, F.explode("keys").alias("key")).distinct(), own_lines(turns)
    met = wanted.filter("of > 1").join(held, ["conv_id", "key"]).filter("turn < at").groupBy(*of, "turn").agg(F.count("*").alias("found"))
    met = met.filter(F.col("found") >= F.lit(least) * F.col("of"))
    best = met.groupBy(*of).agg(F.max(F.struct("found", F.col("turn").alias("source_turn"))).alias("b")).select(*of, "b.found", "b.source_turn")
    # one line: the last turn before that holds it, by a look back, however many turns quote or hold it
    asked = wanted.filter("of = 1").select("conv_id", "key", F.col("at").alias("when"), F.struct(*of).alias("q"), F.lit(None).cast("long").alias("holder"))
    there = held.select("conv_id", "key", F.col("turn").alias("when"), F.lit(None).cast(asked.schema["q"].dataType).alias("q"), F.col("turn").alias("holder"))
    back = Window.partitionBy("conv_id", "key").orderBy("when", F.col("holder").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    lone = asked.unionByName(there.join(asked.select("conv_id", "key").distinct(), ["conv_id", "key"], "left_semi")).withColumn("source_turn", F.last("holder", ignorenulls=True).over(back))
    lone = lone.filter("q is not null and source_turn is not null").select("q.*", F.lit(1).cast("long").alias("found"), "source_turn").filter(F.lit(least) <= 1)
    return best.unionByName(lone).select("uid", "conv_id", F.col("at").alias("turn"), "passage", "level", "source_turn", "found", "of")


def _next(rows: DataFrame, by: list[str], col: str, name: str, step: int = 1) -> DataFrame:
    """(by, col, name): the next larger value of col (the next smaller with step -1) within its group of distinct rows. Groups
    are cut in stretches of 1024 values, so that a large one is no single task's."""
    stretch = F.floor(F.col(col) / 1024)
    order = F.col(col) * step
    rows = rows.select(*by, col).distinct().withColumn("stretch", stretch)
    near = rows.withColumn(name, F.lead(col).over(Window.partitionBy(*by, "stretch").orderBy(order)))
    ends = rows.groupBy(*by, "stretch").agg((F.min(col) if step > 0 else F.max(col)).alias("end"))
    ends = ends.select(*by, "stretch", F.lead("end").over(Window.partitionBy(*by).orderBy(F.col("stretch") * step)).alias("far"))
    return near.join(ends, [*by, "stretch"]).select(*by, col, F.coalesce(name, "far").alias(name))


def _preorder(nodes: DataFrame) -> DataFrame:
    """(conv_id, turn, position, depth) of forests given as (conv_id, turn, reply_to): the Euler tour's ranks, by pointer
    doubling; each round is one join on a unique key."""
    children = nodes.filter("reply_to is not null")
    first = children.groupBy("conv_id", F.col("reply_to").alias("turn")).agg(F.min("turn").alias("child"))
    later = _next(children, ["conv_id", "reply_to"], "turn", "sibling")
    full = nodes.join(first, ["conv_id", "turn"], "left").join(later.drop("reply_to"), ["conv_id", "turn"], "left")
    into, out = F.col("turn") * 2, F.col("turn") * 2 + 1
    tour = full.select("conv_id", F.explode(F.array(
        F.struct(into.alias("e"), F.coalesce(F.col("child") * 2, out).alias("to"), F.lit(1).cast("long").alias("rank"), F.lit(1).cast("long").alias("deep")),
        F.struct(out.alias("e"), F.coalesce(F.col("sibling") * 2, F.col("reply_to") * 2 + 1).alias("to"), F.lit(0).cast("long").alias("rank"), F.lit(-1).cast("long").alias("deep")),
    )).alias("s")).select("conv_id", "s.*")
    tour = write_table(tour, "tour")
    done, active = tour.filter("to is null"), tour.filter("to is not null")
    while not active.isEmpty():  # only what has not come to its end goes on
        ahead = done.unionByName(active).select("conv_id", F.col("e").alias("to"), F.col("to").alias("to2"), F.col("rank").alias("rank2"), F.col("deep").alias("deep2"))
        moved = active.join(ahead, ["conv_id", "to"]).select("conv_id", "e", F.col("to2").alias("to"), (F.col("rank") + F.col("rank2")).alias("rank"), (F.col("deep") + F.col("deep2")).alias("deep"))
        moved = write_table(moved, "tour")
        done, active = done.unionByName(moved.filter("to is null")), moved.filter("to is not null")
    tour = done
    heads = tour.filter(F.pmod("e", F.lit(2)) == 0)
    size = heads.groupBy("conv_id").agg(F.max("rank").alias("size"))
    return heads.join(size, "conv_id").select("conv_id", (F.col("e") / 2).cast("long").alias("turn"), (F.col("size") - F.col("rank")).alias("position"), (-F.col("deep")).alias("depth"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (without quotes), n_quoted (lines), max_level, reply_to, depth, position (from 0, in reply order)."""
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    lines = F.split("text", "\r?\n")
    levels = F.transform(lines, quote_level)
    own = F.array_join(F.filter(lines, lambda x: quote_level(x) == 0), "\n")
    known = turns.filter("conv_id is not null and turn is not null")
    links = quote_links(known.filter("text is not null").withColumn("uid", F.xxhash64("conv_id", "turn", "role", "text")))
    parents = links.groupBy("conv_id", "turn").agg(F.max(F.struct(-F.col("level"), "source_turn"))["source_turn"].alias("source"))
    previous = _next(known, ["conv_id"], "turn", "previous", -1)
    nodes = write_table(previous.join(parents, ["conv_id", "turn"], "left").select("conv_id", "turn", F.coalesce("source", "previous").alias("reply_to")), "replies")
    placed = nodes.join(_preorder(nodes), ["conv_id", "turn"])
    return turns.join(placed, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role",
        F.when(F.exists(levels, lambda x: x > 0), F.trim(own)).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.size(F.filter(levels, lambda x: x > 0)), F.lit(0)).alias("n_quoted"),
        F.coalesce(F.array_max(levels), F.lit(0)).alias("max_level"),
        "reply_to", F.coalesce("depth", F.lit(0)).alias("depth"), F.coalesce("position", F.lit(0)).alias("position"),
    )
