"""Market statistics: rows by size class turned into one row, and what of them concerns an area."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import naics_overlap


def pivot_classes(rows: DataFrame, keys: Sequence[str], code: str, label: str, count: str, total_code: str = "001") -> DataFrame:
    """One row a key: the count of the total's code as ``total``, the others as a map from code to (label, count).

    Repeated codes of a key keep the greatest count; null codes count for nothing.
    """
    each = rows.filter(F.col(code).isNotNull()).groupBy(*keys, code).agg(F.max(F.struct(F.col(count).alias("n"), F.col(label).alias("label"))).alias("x"))
    others = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col(code) != total_code, F.struct(F.col(code).alias("code"), F.struct("x.label", "x.n").alias("value"))))))
    return each.groupBy(*keys).agg(F.max(F.when(F.col(code) == total_code, F.col("x.n"))).alias("total"), others.alias("classes"))


def concerns_area(level: Column, name: Column, states: Sequence[str]) -> Column:
    """Whether a statistic is of the country, of one of the states (by name) or of a part of one ("..., State")."""
    parts = [name == s for s in states] + [name.endswith(f", {s}") for s in states]
    inside = F.lit(False)
    for p in parts:
        inside = inside | F.coalesce(p, F.lit(False))
    return (level == "us") | inside


def concerns_sector(code: Column, prefixes: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | naics_overlap(code, F.lit(p))
    return out


def recipients(rows: DataFrame, key: str, amount: str, prefix: str, order: str) -> DataFrame:
    """One row a recipient: the sum of its amounts and its distinct prefixes in the order they first came."""
    firsts = rows.filter(F.col(key).isNotNull()).groupBy(key, prefix).agg(F.sum(amount).alias("__a"), F.min(order).alias("__o"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("__o", prefix))), lambda x: x[prefix])
    return firsts.groupBy(key).agg(F.sum("__a").alias("total_amount"), listed.alias("prefixes"))
