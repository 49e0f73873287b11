import math
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tamarack.operators import canon, cluster, evaluate, market, match, sample, score, upsert, running
from tamarack.operators.graph import component_labels
from tamarack.operators.running import running_total, uniform
from tamarack.plans.thesis import Range, ThesisError, thesis_from

RECORD = "id bigint, key string, domain string, state string, city string, country string, uei string"


def records(spark, rows):
    return spark.createDataFrame(rows, RECORD)


def test_decisions(spark):
    r = records(spark, [
        (1, "acme tool", "a.test", "GA", "macon", "US", None), (2, "acme tools", "a.test", "GA", None, "US", None), (3, "acme tool", "b.test", "GA", "macon", "US", None), (4, "acme tool", None, "GA", "macon", "US", None),
        (5, "acme tool", None, "NC", None, "US", None), (6, "zenith", "a.test", None, None, None, "U"), (7, "other", None, None, None, None, "U"), (8, None, None, None, None, None, None),
    ])
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (1, 5), (1, 6), (6, 7), (4, 5), (4, 8)], "a bigint, b bigint")
    got = {(x.a, x.b): (x.decision, x.method, x.reason) for x in match.decide(pairs, r).collect()}
    assert got[1, 2] == ("merge", "domain", "same domain") and got[1, 3][:2] == ("review", "domain_conflict") and got[1, 4][:2] == ("merge", "name_location")
    assert got[4, 5] == ("review", "name", "similar name, different state") and got[1, 6][2] == "same domain, names differ" and got[6, 7][:2] == ("merge", "uei") and got[4, 8][0] == "distinct"


def test_candidate_pairs_brute_force(spark):
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(["acme", "apex", "ajax", "zen"]) for _ in range(r.randrange(0, 3))), r.choice([None, "a", "b"]), None, None, None, None) for i in range(60)]
    got = {(x.a, x.b) for x in match.candidate_pairs(records(spark, rows))[0].collect()}
    keys = lambda x: ({("d", x[2])} if x[2] else set()) | ({("f", x[1].split()[0]), ("p", x[1].replace(" ", "")[:4])} if x[1] else set())
    assert got == {(a[0], b[0]) for a, b in combinations(rows, 2) if keys(a) & keys(b)}


def test_oversized_blocks_are_split_not_dropped(spark):
    rows = [(i, f"acme tool{i % 3}", None, None, None, None, None) for i in range(12)]
    pairs, over = match.candidate_pairs(records(spark, rows), max_block=5)
    assert over.count() == 2 and {(x.a, x.b) for x in pairs.collect()} == {(a, b) for a, b in combinations(range(12), 2)}


def test_oversized_blocks_are_compared_whole(spark):
    names = ["saint pirran tool", "saint pirrans tool", "saimt pirran tool", "sain tpirran tool", "saint prran tool", "saint xirran tool"]
    rows = [(i, names[i % 6] + (f" {i // 6}" if i >= 12 else ""), None, "GA", "macon", "US", None) for i in range(36)]
    pairs, over = match.candidate_pairs(records(spark, rows), max_block=5)
    assert over.count() == 5 and {(x.a, x.b) for x in pairs.collect()} == {(a, b) for a, b in combinations(range(36), 2) if names[a % 6][:5] == names[b % 6][:5] or names[a % 6].replace(" ", "")[:4] == names[b % 6].replace(" ", "")[:4]}


def test_similar_names_lose_none(spark):
    r = random.Random(4)
    words = ["saint", "pirran", "tool", "toolworks", "castings", "precision", "a", "42"]
    typo = lambda x: x[: (i := r.randrange(len(x) + 1))] + r.choice(["", "x", " "]) + x[i + r.randrange(2) :]
    names = sorted({" ".join(typo(" ".join(r.choice(words) for _ in range(r.randrange(1, 5)))).split()) for _ in range(160)} - {""})
    d = spark.createDataFrame([(r.choice(["GA", "NC", None]), n) for n in [*names, *names[:20], "", None]], "state string, key string")
    got = [tuple(x) for x in match.similar_names(d, d, "state", 93.0).collect()]
    rows = {tuple(x) for x in d.collect() if x.state and x.key}
    want = {(s, a, b) for s, a in rows for t, b in rows if s == t and match.token_sort_similarity(a, b) >= 93}
    assert want <= set(got) and len(got) == len(set(got)) < len(rows) ** 2 / 8


def test_labels_meet_names_of_like_length_only(spark):
    labels = spark.createDataFrame([(1, "a.test", "acme tool", "GA"), (2, None, "acme tools", "GA"), (3, None, "zen castings", "GA"), (4, None, "zen castings", None), (5, None, "zencastings", "GA")], "label bigint, domain string, key string, state string")
    companies = spark.createDataFrame([(1, "a.test", "acme toolz", "GA"), (2, None, "acme tool", "GA"), (3, None, "zen castings", "GA"), (4, None, "zen castings", "GA")], "company_id bigint, domain string, key string, state string")
    out = evaluate.match_labels(labels, companies, match.name_similarity)
    assert {tuple(x) for x in out.collect()} == {(1, 1, "domain"), (2, 2, "name")}  # names that two companies have are nobody's
    near = match.similar_names(labels, companies, "state", 93.0)._jdf.queryExecution().executedPlan().toString()
    assert "size#" in next(x for x in near.splitlines() if "SortMergeJoin" in x)


def test_names_that_are_left_out_are_distinct(spark):
    r = random.Random(8)
    words = ["saint", "st", "a", "pirran", "tool", "toolworks", "42", "é"]
    typo = lambda x: x[: (i := r.randrange(len(x) + 1))] + r.choice(["", "x", " ", "tt"]) + x[i + r.randrange(2) :]
    rows = [(i, " ".join(typo(" ".join(r.choice(words) for _ in range(r.randrange(0, 5)))).split()), r.choice([None, None, "a", "b"]), r.choice(["GA", None]), None, "US", r.choice([None, None, "U"])) for i in range(150)]
    d = records(spark, rows)
    whole, near = match.candidate_pairs(d, max_block=7)[0], match.candidate_pairs(d, max_block=7, least=match.MAYBE)[0]
    told = lambda p: {tuple(x) for x in match.decide(p, d).filter("decision <> 'distinct'").collect()}
    assert told(whole) == told(near) and near.count() < whole.count()


def test_constrained_clusters(spark):
    rows = records(spark, [(1, "x", "a", None, None, None, None), (2, "x", None, None, None, None, None), (3, "x", "b", None, None, None, None), (4, "y", None, None, None, None, None), (5, "y", None, None, None, None, None), (6, "z", None, None, None, None, None)])
    d = "a bigint, b bigint, decision string, method string, score double, reason string, strength double"
    merges = spark.createDataFrame([(1, 2, "merge", "name_location", 95.0, "r", 95.0), (2, 3, "merge", "name_location", 94.0, "r", 94.0), (4, 5, "merge", "name_location", 99.0, "r", 99.0)], d)
    assignments, links = cluster.cluster(rows, merges)
    assert {(x.id, x.cluster) for x in assignments.collect()} == {(1, 1), (2, 1), (3, 3), (4, 4), (5, 4), (6, 6)}
    assert [(x.a, x.b, x.refused) for x in links.filter("refused is not null").collect()] == [(2, 3, "would join different domains")]
    apart = spark.createDataFrame([(4, 5)], "a bigint, b bigint")
    assert {(x.id, x.cluster) for x in cluster.cluster(rows, merges, apart)[0].collect()} >= {(4, 4), (5, 5)}
    forced = spark.createDataFrame([(4, 5, "merge", "override", 0.0, "r", 1000.0)], d)
    with pytest.raises(cluster.ContradictoryOverrides):
        cluster.cluster(rows, forced, apart)
    shown = {x.id: (x.match_method, x.match_score) for x in cluster.evidence(assignments, links).collect()}
    assert shown[6] == ("singleton", None) and shown[1] == ("name_location", 95.0)
    assert {x.kind for x in cluster.review_pairs(merges, links, assignments).collect()} == {"merge_blocked"}


def test_clusters_are_those_of_the_plain_rule(spark):
    r = random.Random(5)
    sites = {i: r.choice([None, None, "a", "b"]) for i in range(30)}
    edges = sorted({tuple(sorted(r.sample(range(30), 2))) for _ in range(45)})
    rows = [(a, b, "merge", r.choice(["uei", "name_location"]), float(r.randrange(80, 100)), "r") for a, b in edges]
    rows = [(*x, x[4] + (500 if x[3] == "uei" else 0)) for x in rows]
    home = {i: {i} for i in range(30)}
    for a, b, _, method, _, _, _ in sorted(rows, key=lambda x: (-x[6], x[0], x[1])):
        if home[a] is not home[b]:
            da, db = ({sites[i] for i in home[x]} - {None} for x in (a, b))
            if method == "uei" or not (da and db and da != db):
                both = home[a] | home[b]
                for i in both:
                    home[i] = both
    df = spark.createDataFrame(rows, "a bigint, b bigint, decision string, method string, score double, reason string, strength double")
    got = cluster.cluster(records(spark, [(i, "k", s, None, None, None, None) for i, s in sites.items()]), df)[0].collect()
    assert {x.id: x.cluster for x in got} == {i: min(home[i]) for i in range(30)}


def test_stable_ids(spark):
    a = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 4), (5, 5)], "id bigint, cluster bigint")
    f = spark.createDataFrame([(1, 12), (2, 10), (3, 10), (4, 30)], "id bigint, company_id bigint")
    assert {x.cluster: x.company_id for x in cluster.stable_ids(a, f, 100).collect()} == {1: 10, 4: 30, 3: 100, 5: 101}


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)], "a bigint, b bigint")
    got = {x.node: x.component for x in component_labels(e, "a", "b").collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert component_labels(e.limit(0), "a", "b").count() == 0


def test_canonical_record(spark):
    rows = spark.createDataFrame([(1, "A Inc", None, None, None, "US", "332", None, None, "csv", 9), (2, "A", "a.test", "rome", "GA", None, "333", 5, 2.0, "sam", 9), (3, "B", "b.test", None, None, None, "332", None, None, "csv", 8)],
                                 "id bigint, name string, domain string, city string, state string, country string, naics string, employees bigint, revenue_usd_m double, source string, g bigint")
    order = F.when(F.col("source") == "csv", 1)
    got = {x.g: x for x in canon.canonical_record(rows, "g", order).collect()}
    assert got[9].canonical_name == "A Inc" and got[9].domain == "a.test" and got[9].state == "GA" and got[9].naics_codes == ["332", "333"] and got[9].employee_count_source == "sam"


def test_upsert(spark):
    s = "k string, h string, v int"
    old, new = spark.createDataFrame([("a", "1", 1), ("b", "1", 1), ("c", None, 1)], s), spark.createDataFrame([("b", "2", 2), ("c", None, 2), ("d", "1", 1)], s)
    assert {x.k: (x.v, x.change) for x in upsert.upsert(old, new, ["k"], "h").collect()} == {"a": (1, "kept"), "b": (2, "updated"), "c": (1, "unchanged"), "d": (1, "inserted")}


def test_nearest_rank(spark):
    d = spark.createDataFrame([("x", float(i)) for i in range(1, 21)] + [("y", None)], "g string, v double")
    assert [tuple(r) for r in upsert.nearest_rank(d, ["g"], "v", {"p95": 0.95}, "p50").collect()] == [("x", 20.0, 11.0)]


THESIS = {"name": "t", "sectors": {"naics_prefixes": [332], "include_keywords": ["castings"]}, "geography": {"states": ["Georgia"]}, "size": {"employees": {"min": 20, "max": 250}}, "ownership": {"prefer": ["family_owned"]}, "exclusions": {"keywords": ["paint"], "ownership": ["publicly_traded"]}}


def test_thesis_rules():
    t = thesis_from(THESIS)
    assert t.states == ("GA",) and t.naics_prefixes == ("332",) and math.isclose(sum(t.weights.values()), 1)
    for broken in ({"sectors": {"naics_prefixes": ["x"]}}, {"geography": {"states": ["Atlantis"]}}, {"weights": {"luck": 1}}, {"weights": {"size": -1}}, {"shortlist_threshold": 101}, {"extra": 1}, {"ownership": {"prefer": ["x"]}}):
        with pytest.raises(ThesisError):
            thesis_from(THESIS | broken)


@pytest.mark.parametrize("x,want", [(15, 0.5), (10, 0.0), (312.5, 0.5), (375, 0.0), (100, 1.0)])
def test_range_fit(spark, x, want):
    assert spark.range(1).select(score.range_fit(F.lit(float(x)), Range(20, 250)).alias("y")).first().y == want


def facts(spark, **given):
    base = dict(company_id=1, name="Acme", domain=None, state="GA", country="US", naics_codes=["332710"], employee_count=100, employee_count_source="csv", revenue_usd_m=None, enrichment_status="ok", extraction=None) | given
    kind = f"company_id bigint, name string, domain string, state string, country string, naics_codes array<string>, employee_count bigint, employee_count_source string, revenue_usd_m double, enrichment_status string, extraction struct<{score.EXTRACTION.replace(' struct<', ':struct<').replace(' array<', ':array<').replace(' string', ':string')}>"
    return spark.createDataFrame([tuple(base.values())], kind)


def test_score(spark):
    t = thesis_from(THESIS)
    site = ("Makes castings.", ["castings"], [], None, (None, None, None, None, None), (None, "yes", 3, None, "no"), [("family_owned", "/about", "owned by our family")])
    got = score.score(facts(spark, extraction=site), t).first()
    assert (got.sector, got.size, got.geography, got.ownership) == (0.8, 1.0, 1.0, 1.0) and got.total == 92.0 and got.confidence == "high"
    assert got.reason == "Sector fit: NAICS 332710; mentions castings. In-geography (GA). ~100 employees (csv), within 20-250. Family-owned (3rd generation) — 'owned by our family' (/about)."
    none = score.score(facts(spark, state=None, country=None, naics_codes=None, employee_count=None, enrichment_status=None), t).first()
    assert none.total == 30.0 and none.confidence == "low" and none.reason.endswith("Website not analyzed yet.")
    out = score.score(facts(spark, name="Best Paints"), t).first()
    assert out.excluded and out.exclusion_rule == "keyword:paint" and out.total == 0.0 and out.reason == "Excluded: keyword 'paint' (in company name)."
    assert score.score(facts(spark, state="VA"), t).first().geography == 0.25 and score.score(facts(spark, country="CA"), t).first().geography == 0.0


def items(spark, rows):
    return spark.createDataFrame([(i, float(s), p, e) for i, (s, p, e) in enumerate(rows)], "id bigint, score double, positive boolean, excluded boolean")


def test_metrics(spark):
    d = items(spark, [(4, True, False), (3, False, False), (2, True, False), (1, False, False)])
    assert math.isclose(evaluate.average_precision(d).first()[0], (1 + 2 / 3) / 2)
    assert evaluate.roc_auc(items(spark, [(1, True, False), (1, False, False)])).first()[0] == 0.5
    assert evaluate.roc_auc(items(spark, [(1, False, False)])).first()[0] is None
    r = random.Random(4)
    rows = [(r.randrange(6), r.random() < 0.4, r.random() < 0.2) for _ in range(60)]
    v = [(0 if e else s, p) for s, p, e in rows]
    pairs = [(a > b) + (a == b) / 2 for a, p in v for b, q in v if p and not q]
    assert math.isclose(evaluate.roc_auc(items(spark, rows)).first()[0], sum(pairs) / len(pairs))
    for k, n, low, high in ((5, 10, 0.2366, 0.7634), (0, 10, 0, 0.2775), (18, 29, 0.4400, 0.7731)):
        w = spark.range(1).select(evaluate.wilson(F.lit(float(k)), F.lit(float(n))).alias("w")).first().w
        assert (round(w.low, 4), round(w.high, 4)) == (low, high)
    assert {(x.k, x.hits) for x in evaluate.precision_at(d).collect()} == {(4, 2)}


def test_bootstrap(spark):
    r = random.Random(6)
    rows = [(r.randrange(100), i % 3 == 0, False) for i in range(30)]
    low, high = evaluate.bootstrap(items(spark, rows), 1, 200).first()
    gap = sum(s for s, p, _ in rows if p) / 10 - sum(s for s, p, _ in rows if not p) / 20
    assert low < gap < high
    assert tuple(evaluate.bootstrap(items(spark, rows[:4]), 1, 50).first()) == (None, None)


def test_split_sizes(spark):
    d = spark.createDataFrame([(n,) for n in (0, 1, 2, 3, 4, 5, 10, 14, 100)], "n bigint")
    assert [x.t for x in d.select(sample.test_size(F.col("n"), 0.3).alias("t")).collect()] == [0, 0, 1, 1, 1, 2, 3, 4, 30]


def test_samples(spark):
    d = spark.createDataFrame([(i, "ab"[i % 2] if i < 20 else "c") for i in range(23)], "id bigint, g string")
    got = sample.spread(d, "id", "g", 9, 1).collect()
    assert len(got) == 9 and {g: sum(x.g == g for x in got) for g in "abc"} == {"a": 3, "b": 3, "c": 3}
    assert sample.take(d, "id", 5, 1).collect() == sample.take(d.repartition(3), "id", 5, 1).collect()
    split = sample.stratified_split(d, "id", ["g"], 0.3, 2).groupBy("g", "split").count().collect()
    assert {(x.g, x.split): x["count"] for x in split} == {("a", "test"): 3, ("a", "dev"): 7, ("b", "test"): 3, ("b", "dev"): 7, ("c", "test"): 1, ("c", "dev"): 2}
    assert all(0 <= x.position < 1 for x in sample.interleaved(d, "id", "g", 1).collect())


def test_running_total_brute_force(spark):
    r = random.Random(8)
    rows = [(i, r.choice("xy"), r.randrange(1, 9)) for i in range(200)]
    d = spark.createDataFrame(rows, "id bigint, g string, n int").withColumn("u", uniform("id", seed="s"))
    got = running_total(d, ["g"], "u", ["id"], F.col("n"), "t", buckets=16).collect()
    for g in "xy":
        total = 0
        for x in sorted((x for x in got if x.g == g), key=lambda x: (x.u, x.id)):
            total += x.n
            assert x.t == total
    assert running_total(d.limit(0), ["g"], "u", ["id"], F.col("n"), "t").count() == 0


def test_market(spark):
    rows = spark.createDataFrame([("332", "001", "all", 10), ("332", "210", "small", 7), ("332", "220", None, 3), ("333", "210", "small", 1)], "naics string, code string, label string, n bigint")
    got = {x.naics: (x.total, {k: v.n for k, v in x.classes.items()}) for x in market.pivot_classes(rows, ["naics"], "code", "label", "n").collect()}
    assert got == {"332": (10, {"210": 7, "220": 3}), "333": (None, {"210": 1})}


def test_places_in_an_order_of_all_rows(spark):
    r = random.Random(6)
    values = [(i, r.choice([None, 1, 2, 3]), r.randrange(5)) for i in range(500)]
    d = spark.createDataFrame(values, "id bigint, g int, n int").repartition(7)
    got = {x.id: (x.place, x.total) for x in running.numbered(d, [F.col("g").asc_nulls_last(), F.desc("id")], "place", {"total": F.col("n")}).collect()}
    total = 0
    for place, (i, _, n) in enumerate(sorted(values, key=lambda x: (x[1] is None, x[1] or 0, -x[0])), 1):
        total += n
        assert got[i] == (place, total)
    assert running.numbered(d.limit(0), [F.col("id")], "place").count() == 0
