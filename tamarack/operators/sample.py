"""Seeded samples and splits: the order of rows is that of a hash of the seed and the row's key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .running import running_total


def seeded(seed: int | str, key: Column) -> Column:
    """A row's place in the seeded order: SHA-256 of seed and key, so other engines agree."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def take(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows in the seeded order."""
    return rows.orderBy(seeded(seed, F.col(key)), key).limit(n)


def spread(rows: DataFrame, key: str, group: str, n: int, seed: int, most: int | None = None) -> DataFrame:
    """n rows taken from the groups in turn, at most ``most`` of a group (by default half more than an even share)."""
    if most is None:
        groups = max(1, rows.select(group).distinct().count())
        most = -(-3 * n // (2 * groups))
    by = Window.partitionBy(group).orderBy(seeded(seed, F.col(key)), key)
    return rows.withColumn("turn", F.row_number().over(by)).filter(F.col("turn") <= most).orderBy("turn", group).limit(n)


def _hash_place(rows: DataFrame, key: str, groups: Sequence[str], seed: int) -> DataFrame:
    """Adds __place, a row's number in the seeded order of its group, and __size, the group's rows; large groups are cut into buckets of the hash."""
    number = F.conv(F.substring("__s", 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
    hashed = rows.withColumn("__s", seeded(seed, F.col(key))).withColumn("__u", number)
    placed = running_total(hashed, groups, "__u", ["__s", key], F.lit(1), "__place")
    sizes = rows.groupBy(*[F.col(g).alias(f"__z{i}") for i, g in enumerate(groups)]).agg(F.count("*").alias("__size"))
    same = reduce(lambda x, y: x & y, (F.col(g).eqNullSafe(F.col(f"__z{i}")) for i, g in enumerate(groups)))
    return placed.join(sizes, same).drop("__s", "__u", *[f"__z{i}" for i in range(len(groups))])


def interleaved(rows: DataFrame, key: str, group: str, seed: int) -> DataFrame:
    """Rows with a position in [0, 1) such that any stretch of positions has the groups in proportion: (place - 1 + offset) / size of the group.

    The offset of a group is a number in [0, 1) out of its own hash.
    """
    offset = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(group)), 256), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
    placed = _hash_place(rows, key, [group], seed)
    return placed.withColumn("position", (F.col("__place") - 1 + offset) / F.col("__size")).drop("__place", "__size")


def test_size(n: Column, share: float) -> Column:
    """How many of a stratum's n members are for testing: n * share rounded half up, one at least and one less than all at most; 0 of one or none."""
    return F.when(n < 2, 0).otherwise(F.greatest(F.lit(1), F.least(n - 1, F.floor(n * share + 0.5)))).cast("int")


def stratified_split(rows: DataFrame, key: str, strata: Sequence[str], share: float, seed: int) -> DataFrame:
    """Rows with ``split``, dev or test: of each stratum the first ``test_size`` in the seeded order are for testing."""
    placed = _hash_place(rows, key, strata, seed)
    return placed.withColumn("split", F.when(F.col("__place") <= test_size(F.col("__size"), share), "test").otherwise("dev")).drop("__place", "__size")


def hash_split(rows: DataFrame, key: str, share: float, seed: int) -> DataFrame:
    """Rows with ``split`` by their own hash alone, so that new rows never move old ones; the hash's first 48 bits decide."""
    number = F.conv(F.substring(seeded(seed, F.col(key)), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
    return rows.withColumn("split", F.when(number < share, "test").otherwise("dev"))
