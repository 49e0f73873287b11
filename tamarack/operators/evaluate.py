"""How well a ranking agrees with labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .match import similar_names
from .running import numbered

# Cut-offs, resamples and the least class size of the evaluation.
CUTS, RESAMPLES, LEAST_CLASS = (10, 25, 50), 2000, 5


def wilson(k: Column, n: Column, z: float = 1.959963984540054) -> Column:
    """(low, high) of a share k of n; null for n = 0."""
    p = k / n
    mid, half = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    scale = 1 + z * z / n
    return F.when(n > 0, F.struct(F.greatest(F.lit(0.0), (mid - half) / scale).alias("low"), F.least(F.lit(1.0), (mid + half) / scale).alias("high")))


def confusion(items: DataFrame, threshold: float) -> DataFrame:
    """tp, fp, fn, tn, precision, recall and f1 of items (score, positive, excluded) shortlisted from a threshold on."""
    took = ~F.col("excluded") & (F.col("score") >= threshold)
    count = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
    pos = F.col("positive")
    out = items.agg(count(took & pos).alias("tp"), count(took & ~pos).alias("fp"), count(~took & pos).alias("fn"), count(~took & ~pos).alias("tn"))
    share = lambda a, b: F.when(b > 0, a / b)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return out.withColumns({"precision": share(tp, tp + fp), "recall": share(tp, tp + fn), "f1": share(2 * tp, 2 * tp + fp + fn)})


def _placed(items: DataFrame) -> DataFrame:
    """Items in the order of their scores, excluded ones last, with their place and the positives so far."""
    return numbered(items, [F.col("excluded"), F.desc("score"), F.col("id")], "__n", {"__hits": F.col("positive").cast("bigint")})


def average_precision(items: DataFrame) -> DataFrame:
    """average_precision of items (id, score, positive, excluded): the mean, over the positives, of the share of positives so far; null without positives."""
    return _placed(items).agg(F.avg(F.when(F.col("positive"), F.col("__hits") / F.col("__n"))).alias("average_precision"))


def roc_auc(items: DataFrame) -> DataFrame:
    """roc_auc: the chance that a positive outscores a negative, ties for half, excluded items as 0; null without both.

    Worked out on distinct scores (counts above each), so the sort is over scores and not over rows.
    """
    value = F.when(F.col("excluded"), 0.0).otherwise(F.col("score"))
    steps = items.groupBy(value.alias("v")).agg(F.sum(F.col("positive").cast("bigint")).alias("p"), F.sum((~F.col("positive")).cast("bigint")).alias("n"))
    below = F.coalesce(F.sum("n").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    won = steps.withColumn("w", F.col("p") * (below + F.col("n") / 2))
    return won.agg(F.when((F.sum("p") > 0) & (F.sum("n") > 0), F.sum("w") / (F.sum("p") * F.sum("n"))).alias("roc_auc"))


def precision_at(items: DataFrame, cuts=CUTS) -> DataFrame:
    """(k, hits, precision, recall) of the first k items, k clipped to their number and listed once."""
    placed = _placed(items)
    total = items.agg(F.count("*").alias("items"), F.sum(F.col("positive").cast("bigint")).alias("positives"))
    spark = items.sparkSession
    ks = spark.createDataFrame([(k,) for k in cuts], "k int").crossJoin(total).select(F.least("k", F.col("items").cast("int")).alias("k"), "positives").distinct().filter("k > 0")  # a few rows
    hits = placed.join(F.broadcast(ks), F.col("__n") <= F.col("k")).groupBy("k", "positives").agg(F.sum(F.col("positive").cast("bigint")).alias("hits"))
    return hits.select("k", "hits", (F.col("hits") / F.col("k")).alias("precision"), F.when(F.col("positives") > 0, F.col("hits") / F.col("positives")).alias("recall"))


def bootstrap(items: DataFrame, seed: int, resamples: int = RESAMPLES) -> DataFrame:
    """(low, high) of the mean score difference of positives over negatives, from stratified resamples with replacement.

    Draw j of a resample of a class picks the member whose number is a hash of (seed, resample, class, j) modulo the
    class's size; the bounds are the 2.5 and 97.5 percentiles by linear interpolation, null if a class is below LEAST_CLASS.
    """
    by = Window.partitionBy("positive").orderBy("id")
    numbered = items.withColumn("i", F.row_number().over(by) - 1).withColumn("n", F.count("*").over(Window.partitionBy("positive")))
    rounds = items.sparkSession.range(resamples).select(F.col("id").alias("r"))
    draws = numbered.select("positive", F.col("i").alias("j"), "n").crossJoin(rounds)  # resamples x labels: what the method asks for
    picked = draws.withColumn("i", F.pmod(F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(seed), "r", F.col("positive").cast("int"), "j"), 256), 1, 12), 16, 10).cast("bigint"), F.col("n")))
    joined = picked.join(numbered.select("positive", "i", "score"), ["positive", "i"])
    means = joined.groupBy("r").agg((F.avg(F.when(F.col("positive"), F.col("score"))) - F.avg(F.when(~F.col("positive"), F.col("score")))).alias("gap"))
    classes = items.agg(F.sum(F.col("positive").cast("int")).alias("p"), F.sum((~F.col("positive")).cast("int")).alias("q"))
    bounds = means.agg(F.percentile("gap", F.array(F.lit(0.025), F.lit(0.975))).alias("b"))
    enough = (F.col("p") >= LEAST_CLASS) & (F.col("q") >= LEAST_CLASS)
    return bounds.crossJoin(classes).select(F.when(enough, F.col("b")[0]).alias("low"), F.when(enough, F.col("b")[1]).alias("high"))


def match_labels(labels: DataFrame, companies: DataFrame, similarity) -> DataFrame:
    """(label, company_id, how) of labels (label, domain, key, state) among companies (company_id, domain, key, state).

    By domain first, the smallest company id of it; else the one most similar name of the same state, from 93 on, if no
    other is as similar.  ``similarity`` makes a column of two key columns.
    """
    sites = companies.filter("domain is not null").groupBy("domain").agg(F.min("company_id").alias("company_id"))
    by_site = labels.join(sites, "domain").select("label", "company_id", F.lit("domain").alias("how"))
    left = labels.join(by_site.select("label"), "label", "left_anti").filter("state is not null and key <> ''")
    near = similar_names(left, companies, "state", 93.0)
    alike = settle(near.withColumn("s", similarity(F.col("k1"), F.col("k2"))).filter("s >= 93"))
    named = left.select("label", "state", F.col("key").alias("k1")).join(alike, ["state", "k1"])
    scored = named.join(companies.select("company_id", "state", F.col("key").alias("k2")), ["state", "k2"])
    best = Window.partitionBy("label")
    top = scored.withColumn("top", F.max("s").over(best)).filter("s = top").withColumn("n", F.count("*").over(best)).filter("n = 1")
    return by_site.unionByName(top.select("label", "company_id", F.lit("name").alias("how")))
