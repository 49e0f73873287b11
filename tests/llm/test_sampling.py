import random
from collections import Counter

from pyspark.sql import functions as F

from tamarack.llm.mixture import Share, mix, mixture_report
from tamarack.operators.running import uniform
from tamarack.llm.sampling import OTHER, Margin, first_naics3, half_up, last_drawn, proportional_sample, rake, shortfalls


def test_first_naics3(spark):
    rows = [["000000", "332710"], ["TBD", " 311-210"], ["NAICS 327999"], ["naics:313110"], ["3111"], ["325110.0"], ["332210N~"], [None, "n/a"], [], None, ["31"]]
    d = spark.createDataFrame([(r,) for r in rows], "x array<string>")
    assert [r.y for r in d.select(first_naics3(F.col("x")).alias("y")).collect()] == ["332", "311", "327", "313", "311", "325", "332", None, None, None, None]


def test_rake_meets_both_margins():
    cells = {(a, b): n for a, b, n in (("x", "u", 60), ("x", "v", 20), ("y", "u", 10), ("y", "v", 110))}
    w = rake(cells, [{"x": 0.7, "y": 0.3}, {"u": 0.5, "v": 0.5}])
    share = lambda i, k: sum(w[c] * n for c, n in cells.items() if c[i] == k) / 200
    assert abs(share(0, "x") - 0.7) < 1e-6 and abs(share(1, "u") - 0.5) < 1e-6


def test_proportional_sample(spark):
    d = spark.range(2000).selectExpr("id", "case when id % 10 = 0 then 'a' when id % 10 < 4 then 'b' when id = 1999 then 'rare' when id % 10 < 9 then 'c' end g", "'clash' __rank", "1 __u")
    m = Margin("g", {"a": 0.3, "b": 0.3, "rare": 0.0, "never": 0.1, "c": 0.2}, {"rare": 1, "never": 5, "a": 2, "b": 2, "c": 2})
    got = proportional_sample(d, "id", [m], 500)
    n = Counter(r.g for r in got.collect())
    assert sum(n.values()) == 500 and n["a"] >= 150 and n["b"] >= 150 and n["c"] >= 100 and n["rare"] == 1
    assert got.select("id").distinct().count() == 500
    report = {r.category: (r.needed, r.available, r.drawn, r.gap) for r in shortfalls(d, m, 500, got).collect()}
    assert report["never"] == (50, 0, 0, 50) and report["a"][3] == 0 and report["rare"] == (1, 1, 1, 0)
    assert {r.id for r in got.collect()} == {r.id for r in proportional_sample(d.repartition(5), "id", [m], 500).collect()}
    assert proportional_sample(d.limit(0), "id", [m], 10).count() == 0
    assert proportional_sample(d, "id", [m], 5000).count() == 2000


def test_two_margins(spark):
    d = spark.range(4000).selectExpr("id", "case when id % 4 = 0 then 'x' else 'y' end a", "case when id % 3 = 0 then 'u' else 'v' end b")
    got = proportional_sample(d, "id", [Margin("a", {"x": 0.5, "y": 0.5}, {}), Margin("b", {"u": 0.5}, {})], 600).collect()
    assert len(got) == 600 and abs(sum(r.a == "x" for r in got) - 300) <= 6 and abs(sum(r.b == "u" for r in got) - 300) <= 6 and {r.b for r in got} == {"u", OTHER}


def test_guiding_margin_keeps_the_population(spark):
    d = spark.range(6000).selectExpr("id", "case when id % 4 = 0 then 'x' else 'y' end a", "case when id % 12 < 5 then 'u' else 'v' end b")
    got = proportional_sample(d, "id", [Margin("a", {"x": 0.5, "y": 0.5}, {}), Margin("b", {"u": 0.9}, {"u": 600}, strict=False)], 1200).collect()
    assert len(got) == 1200 and abs(sum(r.a == "x" for r in got) - 600) <= 3 and abs(sum(r.b == "u" for r in got) - 500) < 60


def test_needs_beyond_the_size_are_met(spark):
    d = spark.range(100).selectExpr("id", "case when id < 50 then 'x' else 'y' end a")
    assert Counter(r.a for r in proportional_sample(d, "id", [Margin("a", {"x": 0.5, "y": 0.5}, {"x": 9, "y": 30})], 20).collect()) == {"x": 10, "y": 30}


def test_last_drawn_brute_force(spark):
    r = random.Random(3)
    values = [r.choice([r.random(), r.random() * 1e-9, 0.25, 0.0, 1.0]) for _ in range(500)]
    d = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 7, 250, 499, 500):
        assert last_drawn(d, "v", k) == sorted(values)[k - 1]
    assert last_drawn(d, "v", 501) == float("inf") == last_drawn(d.limit(0), "v", 1)


def test_the_smallest_keys_are_drawn(spark):
    d = spark.range(3000).selectExpr("id", "'g' g")
    got = {r.id for r in proportional_sample(d, "id", [Margin("g", {"g": 1.0}, {})], 100).collect()}
    assert got == {r.id for r in d.withColumn("u", uniform("id", seed="sample")).orderBy(F.desc("u")).limit(100).collect()}


def test_half_up():
    assert [half_up(x) for x in (0.5, 1.5, 2.4999, 0.12 * 2500)] == [1, 2, 2, 300]


def test_mix(spark):
    rows = [(i, "big", 100 + i % 7, i) for i in range(900)] + [(5000 + i, "small", 50, 5000 + i % 10) for i in range(40)] + [(7000, "tiny", 10, 1), (8000, None, 99, 2), (8001, "big", 0, 3), (8002, "unlisted", 40, 4)]
    d = spark.createDataFrame([(*r, "c", 1) for r in rows], "id bigint, source string, size bigint, h bigint, copies string, mult int")
    total = sum(r[2] for r in rows)
    shares = {"big": Share(0.5, 3), "small": Share(0.05, 3), "tiny": Share(0.4, 4), "none": Share(0.05, 2)}
    got = mix(d, "id", "source", "size", "h", shares, total)
    report = {r.source: r for r in mixture_report(got, d, "source", "size", shares, total).collect()}
    drawn = sum(r.actual_tokens for r in report.values())
    assert abs(sum(r.actual_share for r in report.values()) - 1) < 1e-9 and all(abs(r.actual_share - r.actual_tokens / drawn) < 1e-9 for r in report.values())
    assert all(abs(r.shortfall_tokens - max(0, r.target_tokens - r.actual_tokens)) < 1e-6 for r in report.values())
    assert abs(report["big"].actual_tokens - 0.5 * total) < 0.002 * total and abs(report["small"].actual_tokens - 0.05 * total) <= 50 and report["small"].most_copies <= 3
    assert report["tiny"].actual_tokens == 40 and report["tiny"].most_copies == 4 and report["tiny"].shortfall_tokens > 0 and report["none"].actual_tokens == 0
    assert got.select("id").distinct().count() == got.count() and {r.source for r in got.collect()} == {"big", "small", "tiny"}
    assert mix(d.limit(0), "id", "source", "size", "h", shares, 0).count() == 0
