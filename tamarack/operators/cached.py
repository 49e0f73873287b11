"""Work that was done before: answers kept in a table, and what is still to be done."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import fresh
from ..session import settle


def cacheable(status: Column) -> Column:
    """Answers worth keeping of an interface: success, and that there is nothing."""
    return status.between(200, 299) | (status == 404)


def cacheable_page(status: Column) -> Column:
    """Answers worth keeping of a web page: success, moved, and lasting refusals."""
    return status.between(200, 399) | status.isin(401, 403, 404, 410)


def pending(requests: DataFrame, kept: DataFrame, keys: Sequence[str], now: Column, most: timedelta | None = None) -> DataFrame:
    """Requests without a kept answer that is young enough (``kept``: keys and fetched_at); equal requests once."""
    good = kept.filter(fresh(F.col("fetched_at"), now, most)).select(*keys).distinct()
    return requests.dropDuplicates(list(keys)).join(good, list(keys), "left_anti")


def replay(requests: DataFrame, kept: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Requests with their kept answers, whatever their age, and ``replayable``; nothing is fetched."""
    last = kept.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in kept.columns if c not in keys]), F.col("fetched_at")).alias("answer"))
    return requests.join(last, list(keys), "left").withColumn("replayable", F.col("answer").isNotNull())


def fetch_status(row: dict[str, Column]) -> Column:
    """What came of fetching a page, by the first rule that holds: columns allowed, delay, on_site, status, is_html, size."""
    return (
        F.when(~row["allowed"], "blocked_by_robots").when(row["delay"] > 30, "crawl_delay_too_long").when(~row["on_site"], "offsite_redirect").when(row["status"].isNull(), "connection_error")
        .when(~row["status"].between(200, 299), "http_error").when(~row["is_html"], "not_html").when(row["size"] > 2_000_000, "too_large").otherwise("ok")
    )


def refresh_sample(sample: DataFrame, results: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A hand-checked sample (domain, name, ...) with fresh ``columns`` of results: by domain and name, else by domain where it is unique."""
    exact = results.groupBy("domain", "name").agg(F.first(F.struct(*columns)).alias("__x"))
    alone = results.groupBy("domain").agg(F.count("*").alias("__n"), F.first(F.struct(*columns)).alias("__y")).filter("__n = 1").drop("__n")
    kept = [c for c in sample.columns if c not in columns]
    return sample.select(*kept).join(exact, ["domain", "name"], "left").join(alone, "domain", "left").select(*kept, F.coalesce("__x", "__y").alias("__z")).select(*kept, "__z.*")


def not_sampled(rows: DataFrame, earlier: DataFrame) -> DataFrame:
    """Rows (domain, name, state, ...) that no earlier sample has by domain, nor by name and state."""
    sites = earlier.select("domain").filter("domain is not null").distinct()
    names = earlier.select("name", "state").filter("name is not null and state is not null").distinct()
    return rows.join(sites, "domain", "left_anti").join(names, ["name", "state"], "left_anti")


def spaced(requests: DataFrame, host: str, at: str, order: str, delay: float) -> DataFrame:
    """Requests with ``starts``, the seconds at which each may go out: not before it is asked for, and ``delay`` seconds after the one before it to its host.

    Request i of a host starts at the greatest of at(j) - j * delay over all j up to i, plus i * delay.  Places and greatest
    values are worked out by ranges of the order (``at``, ``order``) and summed up a host and range, so no task holds a host.
    """
    ranged = settle(requests.repartitionByRange(host, at, order).withColumn("__part", F.spark_partition_id()))
    inside = Window.partitionBy(host, "__part").orderBy(at, order)
    placed = ranged.withColumn("__i", F.row_number().over(inside))
    slack = F.col(at) - F.col("__i") * delay
    parts = placed.groupBy(host, "__part").agg(F.count("*").alias("__n"), F.max(slack).alias("__top"))
    before = Window.partitionBy(host).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a host and partition
    offsets = parts.withColumn("__skip", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    offsets = offsets.withColumn("__high", F.max(F.col("__top") - F.col("__skip") * delay).over(before)).select(F.col(host).alias("__h"), F.col("__part").alias("__p"), "__skip", "__high")
    joined = placed.join(offsets, F.col(host).eqNullSafe(F.col("__h")) & (F.col("__part") == F.col("__p")))
    upto = F.max(slack - F.col("__skip") * delay).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return joined.withColumn("starts", F.greatest(upto, F.col("__high")) + (F.col("__i") + F.col("__skip")) * delay).drop("__part", "__i", "__h", "__p", "__skip", "__high")
