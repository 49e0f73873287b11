import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tamarack.llm.components import components, propagate, small_components
from tamarack.llm.representative import best_record, survivors
from tamarack.llm.splits import assign_splits, decision, frontier_components


def find_groups(pairs):
    home = {}
    for a, b in pairs:
        if a is None or b is None or a == b:
            continue
        x, y = home.setdefault(a, {a}), home.setdefault(b, {b})
        if x is not y:
            x |= y
            for i in y:
                home[i] = x
    return {i: min(g) for i, g in home.items()}


def graph(seed, chain=30):
    r = random.Random(seed)
    pairs = [(1, r.randrange(2, 60)) for _ in range(40)] + [(r.randrange(100, 160), r.randrange(100, 160)) for _ in range(35)] + [(200 + i, 201 + i) for i in range(chain)]
    pairs += [(b, a) for a, b in pairs[:20]] + pairs[:5] + [(7, 7), (None, 3), (3, None), (900, 900)]
    r.shuffle(pairs)
    return pairs


@pytest.mark.parametrize("group", [components, small_components, frontier_components])
def test_groups_brute_force(spark, group):
    pairs = graph(1)
    d = spark.createDataFrame([(*p, "x", 0) for p in pairs], "a bigint, b bigint, group_id string, src int")
    assert {r.record_id: r.group_id for r in group(d, "a", "b").collect()} == find_groups(pairs)
    assert group(d.limit(0), "a", "b").count() == 0
    assert group(d.filter("a = b"), "a", "b").count() == 0


def test_peeling_stops_early_and_still_joins(spark):
    from tamarack.llm import components as c

    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(5, 100 + i) for i in range(6)], "u bigint, v bigint")
    reached, rest = c.peel_giant(edges, rounds=2)
    assert {r.node for r in reached.collect()} == {3, 4, 5, 6, 7, *range(100, 106)} and rest.filter("u = 5 or v = 5").count() == 2
    assert {r.root for r in propagate(rest).collect()} and propagate(rest).select("root").distinct().count() == 1


def test_survivors(spark):
    rows = [
        (1, 10, "a", 1, "2025-01-01", "n10", None), (1, 11, "a", 1, "2025-01-02", "n11", "d11"), (1, 12, "b", None, "2026-01-01", "n12", "d12"), (1, 13, "a", 1, "2025-01-02", "n13", None),
        (2, 20, "b", None, None, None, None), (2, 21, "b", None, None, "n21", None), (2, 21, "b", None, None, "n21", None), (None, 30, "a", 1, None, "x", None), (3, None, "a", 1, None, "x", None),
    ]
    d = spark.createDataFrame([(*r, "clash", 5) for r in rows], "g bigint, r bigint, source string, t int, w string, n string, d string, field_name string, __n int")
    got = {(x.g, x.field_name): (x.r, x.source, x.value) for x in survivors(d, "g", "r", {"n": F.col("n"), "d": F.col("d")}, F.col("t"), F.col("w")).collect()}
    assert got == {(1, "n"): (11, "a", "n11"), (1, "d"): (11, "a", "d11"), (2, "n"): (21, "b", "n21")}
    best = {x.g: (x.r, x.completeness) for x in best_record(d, "g", "r", ["n", "d"], F.col("t"), F.col("w")).collect()}
    assert best == {1: (11, 2), 2: (21, 1)}
    assert survivors(d.limit(0), "g", "r", {"n": F.col("n")}, F.col("t"), F.col("w")).count() == 0


def test_hot_groups_are_cut_before_the_shuffle(spark):
    d = spark.range(1000).selectExpr("1L g", "id r", "'s' source", "1 t", "id w", "'v' n")
    plan = survivors(d, "g", "r", {"n": F.col("n")}, F.col("t"), F.col("w"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_splits(spark):
    r = random.Random(2)
    rows = [(i, r.choice(["pursue", "pass", None]), r.choice([1, 1, 2, 3])) for i in range(3000)] + [(9000, "pass", 700), (9001, "pursue", 100)]
    shares = {"train": 0.7, "validation": 0.15, "test": 0.15}
    d = spark.createDataFrame(rows, "group_id bigint, stratum string, records bigint")
    got = {x.group_id: x.split_name for x in assign_splits(d, shares).collect()}
    assert set(got) == {i for i, _, _ in rows}
    for stratum in ("pursue", "pass", None):
        n = Counter()
        for i, s, k in rows:
            n[got[i]] += k * (s == stratum)
        for name, share in shares.items():
            assert abs(n[name] / sum(n.values()) - share) < 0.03
    assert assign_splits(d.limit(0), shares).count() == 0
    assert assign_splits(d.filter("group_id = 9000"), shares).count() == 1


def test_decisions(spark):
    d = spark.createDataFrame([(" Yes",), ("PASS",), ("0",), ("maybe",), (None,), ("",)], "x string")
    assert [r.y for r in d.select(decision(F.col("x")).alias("y")).collect()] == ["pursue", "pass", "pass", None, None, None]
