"""Folds over a key's whole history, by stretches.

A fold that can be merged (the last value, the largest) is run inside stretches of the order, each a group of its own, and over the
stretches' results; a row gets what came before it in its stretch, and before its stretch. So a key with a long history is many
tasks', and only one row for each of its stretches meets in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def carried(rows: DataFrame, by: list[str], at: str, order: list[str], width: int, **values: tuple[Column, str]) -> DataFrame:
    """Adds a column for each of the values, (value, `last` or `max`): of the rows of its key that come before it in the order, the last value
    that isn't null, or the largest. `at`, a whole number, comes first in the order; `width` of its values are a stretch."""
    held = rows.withColumns({"_stretch": F.floor(F.col(at) / width), **{f"_of_{n}": v for n, (v, _) in values.items()}})
    near = Window.partitionBy(*by, "_stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    far = Window.partitionBy(*by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    fold = lambda c, how, window: (F.max(c) if how == "max" else F.last(c, ignorenulls=True)).over(window)
    end = lambda c, how: F.max(c) if how == "max" else F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order)))
    ends = held.groupBy(*by, "_stretch").agg(*[end(f"_of_{n}", how).alias(f"_end_{n}") for n, (_, how) in values.items()])
    before = ends.select(*by, "_stretch", *[fold(f"_end_{n}", how, far).alias(f"_far_{n}") for n, (_, how) in values.items()])
    inside = held.withColumns({n: fold(f"_of_{n}", how, near) for n, (_, how) in values.items()})
    out = inside.join(before, [*by, "_stretch"], "left")
    both = {n: F.greatest(n, f"_far_{n}") if how == "max" else F.coalesce(n, f"_far_{n}") for n, (_, how) in values.items()}
    return out.withColumns(both).select(*rows.columns, *[n for n in values if n not in rows.columns])
