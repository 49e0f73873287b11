"""Tables that take in records again and again."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .running import numbered


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row of each key in the order given; rows with null keys are keys like others."""
    by = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in order])
    return rows.withColumn("__n", F.row_number().over(by)).filter("__n = 1").drop("__n")


def upsert(table: DataFrame, incoming: DataFrame, keys: Sequence[str], content: str) -> DataFrame:
    """The table after taking in rows, with a column ``change``: inserted, updated, unchanged (the incoming row counts) or kept.

    Both sides hold the same columns; a key that comes in twice must be settled before (``latest``).  ``content`` is the
    hash that tells whether a row changed.
    """
    old = table.select(*[F.col(k) for k in keys], F.struct(*table.columns).alias("old"))
    new = incoming.select(*[F.col(k) for k in keys], F.struct(*table.columns).alias("new"))
    both = old.join(new, list(keys), "full_outer")
    change = F.when(F.col("old").isNull(), "inserted").when(F.col("new").isNull(), "kept").when(F.col(f"old.{content}").eqNullSafe(F.col(f"new.{content}")), "unchanged").otherwise("updated")
    row = F.when(change.isin("inserted", "updated"), F.col("new")).otherwise(F.col("old"))
    return both.select(row.alias("row"), change.alias("change")).select("row.*", "change")


def delivery_changes(rows: DataFrame, keys: Sequence[str], content: str, order: Sequence[str]) -> DataFrame:
    """Each row with what it did on arrival, in order: inserted, updated or unchanged against the row of its key before it."""
    by = Window.partitionBy(*keys).orderBy(*order)
    before = F.lag(content).over(by)
    first = F.row_number().over(by) == 1
    return rows.withColumn("change", F.when(first, "inserted").when(before.eqNullSafe(F.col(content)), "unchanged").otherwise("updated"))


def nearest_rank(rows: DataFrame, group: Sequence[str], value: str, shares: dict[str, float], median: str | None = None) -> DataFrame:
    """Percentiles without interpolation: element floor(share * n) of the sorted values of a group, n - 1 at most; ``median`` names element n // 2."""
    there = rows.filter(F.col(value).isNotNull()).select(*group, F.col(value).alias("__v"))
    placed = settle(numbered(there, [*[F.col(g) for g in group], F.col("__v")], "__place"))
    bounds = placed.groupBy(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)]).agg((F.min("__place") - 1).alias("__first"), F.count("*").alias("__n"))
    same = reduce(lambda x, y: x & y, (F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group)))
    at = placed.join(bounds, same).withColumn("__i", F.col("__place") - 1 - F.col("__first"))
    picks = [F.max(F.when(F.col("__i") == F.least(F.floor(F.col("__n") * s), F.col("__n") - 1), F.col("__v"))).alias(name) for name, s in shares.items()]
    if median:
        picks.append(F.max(F.when(F.col("__i") == F.floor(F.col("__n") / 2), F.col("__v"))).alias(median))
    return at.groupBy(*group).agg(*picks)
