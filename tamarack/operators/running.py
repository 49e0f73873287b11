"""Ranks and running totals of large groups without one task per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

_BUCKETS = 4096


def uniform(*parts: Column | str, seed: str = "") -> Column:
    """A number in [0, 1) that depends on the parts and the seed alone."""
    h = F.xxhash64(*[F.col(p) if isinstance(p, str) else p for p in parts], F.lit(seed))
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def running_total(df: DataFrame, groups: Sequence[str], order: str, ties: Sequence[str], size: Column, out: str, buckets: int = _BUCKETS) -> DataFrame:
    """Adds ``out``: the sum of ``size`` over the rows of the same group up to and with this one, in order of ``order`` and then ``ties``.

    ``order`` must hold numbers spread evenly over [0, 1), as ``uniform`` gives.  A group is cut into buckets of that order;
    totals of the buckets are summed up on a small table (groups x buckets rows) and joined back, so no task gets more
    than one bucket of a group, however large the group is.  Nulls of ``size`` count as 0.  Empty in, empty out.
    """
    keyed = df.withColumn("__bucket", F.floor(F.col(order) * buckets).cast("int")).withColumn("__size", F.coalesce(size, F.lit(0)))
    sums = keyed.groupBy(*groups, "__bucket").agg(F.sum("__size").alias("__sum"))
    before = Window.partitionBy(*[F.col(g) for g in groups]).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(g).alias(f"__{g}") for g in groups], F.col("__bucket").alias("__b"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy(*groups, "__bucket").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, 0)
    keyed = keyed.withColumn("__within", F.sum("__size").over(within))
    same = F.col("__bucket") == F.col("__b")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"__{g}"))
    return keyed.join(sums, same, "left").withColumn(out, F.col("__before") + F.col("__within")).drop("__bucket", "__size", "__within", "__before", "__b", *[f"__{g}" for g in groups])


def numbered(rows: DataFrame, order: Sequence[Column], out: str, sums: Mapping[str, Column] | None = None) -> DataFrame:
    """Adds ``out``, each row's place from 1 on in an order of all rows, and for each of ``sums`` the total of a column up to and with the row.

    Rows are sorted by ranges; a range's rows and totals are summed up on one row a partition, so no task sees all rows.
    The order should tell rows apart; equal ones stand in one range in any order.  Empty in, empty out.
    """
    sums = dict(sums or {})
    spark = rows.sparkSession
    ranged = settle(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    whole = ranged.groupBy("__part").agg(F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(f"s{i}") for i, c in enumerate(sums.values())]).orderBy("__part").collect()  # one row a partition
    before, starts = [0] * (1 + len(sums)), []
    for r in whole:
        starts.append((r["__part"], *before))
        before = [x + y for x, y in zip(before, (r.n, *(r[f"s{i}"] for i in range(len(sums)))))]
    names = ["__before", *(f"__before{i}" for i in range(len(sums)))]
    offsets = F.broadcast(spark.createDataFrame(starts, "__part int, " + ", ".join(f"{n} bigint" for n in names)))
    by = Window.partitionBy("__part").orderBy(*order)
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.join(offsets, "__part").withColumn(out, F.col("__before") + F.row_number().over(by))
    for i, (name, c) in enumerate(sums.items()):
        placed = placed.withColumn(name, F.col(f"__before{i}") + F.coalesce(F.sum(c).over(upto), F.lit(0)))
    return placed.drop("__part", *names)
