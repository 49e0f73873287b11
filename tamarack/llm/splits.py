"""Splits that keep related records together."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import state_code
from ..functions.web import own_domain
from ..operators.running import running_total, uniform
from ..session import few_rows, settle
from .components import links, propagate
from .names import learn_words, name_struct
from .tables import platforms, table
from .variants import entity_links

#: Groups above this share of all records are dealt out one by one, largest first; there are at most its inverse of them.
LARGE = 0.002


def frontier_components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(record_id, group_id) of every record that a pair joins to another; group_id is the group's smallest record id.

    Adjacency lists are partitioned by a hash of the vertex.  Seeds are the vertices whose hash is least among their
    neighbours', so every group has one; all seeds' breadth-first frontiers grow at once, a vertex keeping the first (of
    one round the least) seed that reaches it.  Where two seeds meet, they are linked in a small graph of seeds, whose
    components merge their labels.  Nulls and self-pairs join nothing; repeated pairs count once; empty gives empty.
    """
    edges = links(pairs, a, b)
    both = edges.select(F.explode(F.array(F.struct(F.col("u").alias("src"), F.col("v").alias("dst")), F.struct(F.col("v").alias("src"), F.col("u").alias("dst")))).alias("e")).select("e.src", "e.dst")
    near = settle(both.repartition("src"))
    rank = lambda c: F.struct(F.xxhash64(c), c)
    nearest = near.groupBy("src").agg(F.min_by("dst", rank(F.col("dst"))).alias("m"))
    seeds = nearest.filter(rank(F.col("src")) < rank(F.col("m")))
    front = labels = settle(seeds.select(F.col("src").alias("node"), F.col("src").alias("seed")))
    met: list[DataFrame] = []
    while front.take(1):
        reached = settle(near.join(front, near.src == front.node).select(F.col("dst").alias("node"), F.col("seed").alias("by")).distinct().join(labels, "node", "left"))
        fresh = settle(reached.filter("seed is null").groupBy("node").agg(F.min("by").alias("seed")))  # a round writes its own frontier only
        met.append(reached.filter("seed <> by").select("seed", "by"))
        met.append(reached.filter("seed is null").drop("seed").join(fresh, "node").filter("seed <> by").select("seed", "by"))
        front, labels = fresh, labels.unionByName(fresh)
    out = labels.select("node", "seed")
    if met:
        small = met[0]
        for part in met[1:]:
            small = small.unionByName(part)
        roots = propagate(settle(links(small, "seed", "by")))
        out = out.join(roots.withColumnRenamed("node", "seed"), "seed", "left").select("node", F.coalesce("root", "seed").alias("seed"))
    out = settle(out)
    return out.join(out.groupBy("seed").agg(F.min("node").alias("group_id")), "seed").select(F.col("node").alias("record_id"), "group_id")


def assign_splits(groups: DataFrame, shares: Mapping[str, float], seed: str = "split") -> DataFrame:
    """(group_id, split_name) for groups (group_id, stratum, records): each group is in one split, each stratum has the shares.

    Groups above LARGE of all records are dealt out first, each to the split that lacks most of its stratum.  The others
    follow in order of a hash: running totals of their records in their stratum are cut where the splits' open quotas end,
    a group going where its middle lies.  A split with no share gets nothing; null strata are a stratum.  An empty table gives none.
    """
    spark = groups.sparkSession
    total = sum(shares.values()) or 1.0
    names = [n for n, s in shares.items() if s > 0]
    rows = settle(groups.withColumn("stratum", F.coalesce("stratum", F.lit("(none)"))))
    sizes = {r.stratum: r.n for r in rows.groupBy("stratum").agg(F.sum("records").alias("n")).collect()}  # bounded: one row a stratum
    everything = sum(sizes.values())
    large = rows.filter(F.col("records") > LARGE * everything).orderBy(F.desc("records"), "group_id").collect()  # bounded: at most 1/LARGE rows
    open_ = {t: {s: shares[s] / total * n for s in names} for t, n in sizes.items()}
    dealt = []
    for r in large:
        slack = {s: sum(o[s] for o in open_.values()) for s in names}
        best = max(names, key=lambda s: (min(slack[s], open_[r.stratum][s] + slack[s] / 2), s))
        open_[r.stratum][best] -= r.records
        dealt.append((r.group_id, best))
    cuts = []
    for t, o in open_.items():
        quota = {s: max(0.0, q) for s, q in o.items()}
        small = sum(quota.values()) or 1.0
        at = 0.0
        for s in names:
            cuts.append((t, s, at / small, (at + quota[s]) / small if s != names[-1] else 2.0))
            at += quota[s]
    first = spark.createDataFrame(dealt, "group_id bigint, split_name string")
    rest = rows.join(F.broadcast(first.select("group_id")), "group_id", "left_anti").withColumn("__u", uniform("group_id", seed=seed))  # bounded as above
    sums = rest.groupBy("stratum").agg(F.sum("records").alias("__all"))
    placed = running_total(rest, ["stratum"], "__u", ["group_id"], F.col("records"), "__upto").join(F.broadcast(sums), "stratum")  # one row a stratum
    middle = (F.col("__upto") - F.col("records") / 2) / F.col("__all")
    table_ = F.broadcast(spark.createDataFrame(cuts, "__t string, split_name string, low double, high double"))  # strata x splits
    cut = placed.withColumn("__m", middle).join(table_, (F.col("stratum") == F.col("__t")) & (F.col("__m") >= F.col("low")) & (F.col("__m") < F.col("high")))
    return first.unionByName(cut.select("group_id", "split_name"))


# What labels say for each decision.
DECISIONS = {"pursue": "pursue yes y 1 true target".split(), "pass": "pass no n 0 false".split()}


def decision(c: Column) -> Column:
    """pursue, pass, or null for what is no decision."""
    text = F.lower(F.trim(c))
    return F.when(text.isin(*DECISIONS["pursue"]), "pursue").when(text.isin(*DECISIONS["pass"]), "pass")


def _label_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Names, states and domains that a label row gives itself and in its key."""
    hosts = platforms(spark, folder)
    rows = table(spark, folder, "label_rows").select("row_number", "company_name", "website", "state", F.trim("key").alias("key"))
    kind, rest = F.lower(F.substring("key", 1, 2)), F.expr("substring(key, 3)")
    named = kind == "n:"
    key_state = state_code(F.regexp_extract(F.when(named, rest), "\\|([^|]*)$", 1))
    own_state = state_code(F.col("state"))
    base = rows.select("row_number", F.explode(F.array(
        F.struct(F.col("company_name").alias("name"), own_domain(F.col("website"), hosts).alias("domain")),
        F.struct(F.regexp_extract(F.when(named, rest), "^([^|]*)", 1).alias("name"), own_domain(F.when(kind == "d:", rest), hosts).alias("domain")),
    )).alias("x"), F.coalesce(own_state, key_state).alias("state"))
    words = learn_words(rows.select(F.col("company_name").alias("name")).unionByName(table(spark, folder, "companies").select(F.col("canonical_name").alias("name"))), "name")
    parsed = base.select("row_number", name_struct(words)("x.name").alias("p"), "state", F.col("x.domain").alias("domain"))
    return parsed.select("row_number", "p.core", "p.sound", "p.modifier", "p.trade", "state", F.lit(None).cast("string").alias("city"), "domain").distinct()


def p3_groups(spark: SparkSession, folder: str) -> DataFrame:
    """(row_number, first_row) of every label row, alone or not."""
    rows = table(spark, folder, "label_rows").select("row_number").filter("row_number is not null").distinct()
    found = frontier_components(entity_links(_label_rows(spark, folder), "row_number"), "row_number", "hub")
    return rows.join(found, rows.row_number == found.record_id, "left").select("row_number", F.coalesce("group_id", "row_number").alias("first_row"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return p3_groups(spark, folder).filter("first_row < row_number").select("first_row", "row_number")


def _shares(spark: SparkSession, folder: str) -> dict[str, float]:
    return {r.split_name: r.target_share for r in few_rows(table(spark, folder, "split_targets"))}


def p3_splits(spark: SparkSession, folder: str) -> DataFrame:
    """(row_number, first_row, decision, split_name) of every label row."""
    labels = table(spark, folder, "label_rows").select("row_number", decision(F.col("decision")).alias("decision"))
    rows = settle(p3_groups(spark, folder).join(labels, "row_number", "left"))
    counts = rows.groupBy(F.col("first_row").alias("group_id")).agg(F.count("*").alias("records"), F.sum((F.col("decision") == "pursue").cast("int")).alias("yes"), F.sum((F.col("decision") == "pass").cast("int")).alias("no"))
    stratum = F.when(F.col("yes") > F.coalesce("no", F.lit(0)), "pursue").when(F.col("no") > 0, "pass").when(F.col("yes") > 0, "pass").otherwise("(none)")
    splits = assign_splits(counts.select("group_id", stratum.alias("stratum"), "records"), _shares(spark, folder))
    return rows.join(splits, rows.first_row == splits.group_id).select("row_number", "first_row", "decision", "split_name")


def p3_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and shares of each split, in all and by decision."""
    rows = settle(p3_splits(spark, folder))
    counts = rows.groupBy("split_name", F.coalesce("decision", F.lit("(none)")).alias("decision")).agg(F.count("*").alias("records"), F.count_distinct("first_row").alias("companies"))
    sums = counts.groupBy("decision").agg(F.sum("records").alias("of_decision"))
    return counts.join(sums, "decision").withColumn("share", F.col("records") / F.col("of_decision")).select("split_name", "decision", "records", "companies", "share")
