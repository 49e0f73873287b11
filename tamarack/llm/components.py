"""Groups of everything that is linked directly or through others."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import release, settle
from .tables import table

#: Breadth-first rounds from the highest-degree vertex; what they leave of its component is finished by propagation.
BFS_ROUNDS = 12


def links(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct links (u < v) of pairs; nulls and pairs of a thing with itself are none."""
    u, v = F.least(a, b), F.greatest(a, b)
    return pairs.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(u.alias("u"), v.alias("v")).distinct()


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct(F.col("u").alias("src"), F.col("v").alias("dst")), F.struct(F.col("v").alias("src"), F.col("u").alias("dst")))).alias("e")).select("e.src", "e.dst")


def peel_giant(edges: DataFrame, rounds: int = BFS_ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Vertices reached from the highest-degree vertex, as (node, hub), and the links that are left, the reached vertices drawn together in the hub.

    Each round joins the frontier with the links and drops what was reached before.  ``edges`` must not be empty.
    """
    near = settle(_both(edges))
    top = near.groupBy("src").count().agg(F.max_by("src", F.struct(F.col("count"), -F.col("src"))).alias("hub")).first().hub
    last = edges.sparkSession.range(top, top + 1).withColumnRenamed("id", "node")
    reached, rings = last, []
    for _ in range(rounds):
        new = near.join(last, near.src == last.node, "left_semi").select(F.col("dst").alias("node")).distinct()
        last = settle(new.join(reached, "node", "left_anti"))  # a round writes its own ring only
        if not last.take(1):
            release(last)
            break
        rings.append(last)
        reached = reached.unionByName(last)
    hub = F.lit(top).cast("bigint")
    inside = reached.select(F.col("node").alias("n"))
    out_u = edges.join(inside.withColumnRenamed("n", "u").withColumn("iu", F.lit(True)), "u", "left")
    both = out_u.join(inside.withColumnRenamed("n", "v").withColumn("iv", F.lit(True)), "v", "left")
    rest = both.filter("iu is null or iv is null").select(F.when(F.col("iu"), hub).otherwise(F.col("u")).alias("u"), F.when(F.col("iv"), hub).otherwise(F.col("v")).alias("v"))
    rest = settle(links(rest, "u", "v"))
    release(near)
    return reached.select("node", hub.alias("hub")), rest


def propagate(edges: DataFrame) -> DataFrame:
    """(node, root) of every vertex of the links: minimum propagation in rounds that draw each vertex to the least of its neighbourhood.

    The least is taken in an order hashed anew each round, so that chains in order of their ids shrink by a constant factor
    a round too; links inside a drawn-together vertex vanish, and the rounds end when none is left.
    """
    spark = edges.sparkSession
    steps: list[DataFrame] = []
    left, turn = edges, 0
    while left.take(1):
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)), c)  # noqa: B023, E731
        near = _both(left)
        nearest = near.groupBy("src").agg(F.min_by("dst", rank(F.col("dst"))).alias("m"))
        least = settle(nearest.select(F.col("src").alias("node"), F.when(rank(F.col("m")) < rank(F.col("src")), F.col("m")).otherwise(F.col("src")).alias("to")))
        steps.append(least)
        at = least.select(F.col("node").alias("u"), F.col("to").alias("tu"))
        bt = least.select(F.col("node").alias("v"), F.col("to").alias("tv"))
        drawn = settle(links(left.join(at, "u").join(bt, "v"), "tu", "tv"))
        if turn:
            release(left)
        left, turn = drawn, turn + 1
    if not steps:
        return spark.createDataFrame([], "node bigint, root bigint")
    roots = steps[0].select("node", F.col("to").alias("root"))
    for step in steps[1:]:
        roots = roots.join(step.select(F.col("node").alias("root"), F.col("to")), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return roots


def components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(record_id, group_id) of every record that some pair joins to another; group_id is the group's smallest record id.

    The component of the highest-degree vertex is peeled off by frontier joins, the others are labelled by minimum
    propagation.  Nulls and pairs of a record with itself join nothing; repeated and turned pairs count once; ids are
    bigint.  An empty table gives no row.
    """
    edges = settle(links(pairs, a, b).select(F.col("u").cast("bigint").alias("u"), F.col("v").cast("bigint").alias("v")))
    if not edges.take(1):
        return edges.sparkSession.createDataFrame([], "record_id bigint, group_id bigint")
    giant, rest = peel_giant(edges)
    small = settle(propagate(rest))
    roots = small.join(giant.select("node"), "node", "left_anti")
    hub = giant.select("hub").first().hub  # the same for all of them
    root = small.filter(F.col("node") == hub).select("root").first()
    every = settle(roots.unionByName(giant.select("node", F.lit(root.root if root else hub).cast("bigint").alias("root"))))
    least = every.groupBy("root").agg(F.min("node").alias("group_id"))
    return every.join(least, "root").select(F.col("node").alias("record_id"), "group_id")


def small_components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """As ``components``, by minimum propagation alone: for links whose groups are no giants."""
    every = settle(propagate(settle(links(pairs, a, b))))
    return every.join(every.groupBy("root").agg(F.min("node").alias("group_id")), "root").select(F.col("node").alias("record_id"), "group_id")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of the records, anchor records included, that merge decisions join."""
    rows = table(spark, folder, "pair_decisions")
    return components(rows.filter(F.lower(F.trim("decision")) == "merge"), "a", "b")


def p5_against_companies(spark: SparkSession, folder: str) -> DataFrame:
    """For each group: its records, how many have a company, how many companies they had; and for the companies, into how many groups they fell."""
    groups = p5_found(spark, folder)
    old = table(spark, folder, "company_records").select(F.col("raw_record_id").alias("record_id"), "company_id")
    both = groups.join(old, "record_id", "left")
    split = both.filter("company_id is not null").groupBy("company_id").agg(F.count_distinct("group_id").alias("n")).filter("n > 1").select("company_id", F.lit(1).alias("is_split"))
    pairs = both.groupBy("group_id", "company_id").agg(F.count("*").alias("records")).join(split, "company_id", "left")
    return pairs.groupBy("group_id").agg(F.sum("records").alias("records"), F.sum(F.when(F.col("company_id").isNotNull(), F.col("records")).otherwise(0)).alias("with_company"),
                                         F.count("company_id").alias("companies"), F.count("is_split").alias("split_companies"))
