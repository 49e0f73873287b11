import pytest
from pyspark.sql import functions as F

from tamarack.plans import evaluation, reports
from tamarack.plans.thesis import thesis_from

T = thesis_from({"name": "t", "sectors": {"naics_prefixes": ["332"]}, "geography": {"states": ["GA", "NC"]}})
COMPANIES = "id bigint, name string, domain string, city string, state string, country string, naics_codes array<string>, what string"


def companies(spark):
    rows = [(1, "Acme Inc", "a.test", "rome", "GA", None, ["332710"]), (2, "Bolt", None, None, "GA", "US", ["332"]), (3, "Cog", "c.test", None, "NC", "US", None), (4, "Dye", "d.test", None, "NC", "US", ["311"]),
            (5, "Eel", "e.test", None, "TX", "US", ["332"]), (6, "Fin", "f.test", None, "NC", "CA", ["332"]), (7, None, None, None, "NC", None, ["332"]), (8, "Gum", "g.test", None, "NC", None, ["3327"]), (9, None, None, None, None, None, None)]
    return spark.createDataFrame([(*r, "clash") for r in rows], COMPANIES)


def test_label_eligibility(spark):
    labelled = spark.createDataFrame([("d:a.test",), (None,), ("d:a.test",)], "key string")
    found = reports.label_eligibility(companies(spark), T, labelled)
    assert {r.company_id: r.what for r in found.collect()} == {1: "labelled", 2: "no_website", 3: "naics_unknown", 4: "naics_outside", 7: "no_website", 8: "eligible"}
    assert [tuple(r) for r in reports.to_label(found, 5, 1).select(*reports.TO_LABEL).collect()] == [("Gum", "g.test", "NC", "")]
    assert reports.label_eligibility(companies(spark).limit(0), T, labelled).count() == 0


def test_finder_targets_and_saved_websites(spark):
    ueis = spark.createDataFrame([(2, "U2")], "company_id bigint, uei string")
    targets = reports.finder_targets(companies(spark), ueis, 3, T)
    assert {(r.company_id, r.search_key) for r in targets.collect()} == {(2, "uei:U2"), (7, None)}
    assert {r.company_id for r in reports.finder_targets(companies(spark), ueis, 3).collect()} == {2, 7}
    results = spark.createDataFrame([("uei:U2", 2, "none", None, None, 1), ("uei:U2", 2, "found", "b.test", 0.9, 2), ("n:zed|ga", 5, "none", None, None, 2)], "search_key string, company_id bigint, status string, domain string, confidence double, finished_at int")
    old = [("websites", "n:zed|ga", "{}", "h", 1), ("websites", "uei:U2", "{}", "h", 1), ("csv", "uei:U2", "{}", "h", 1)]
    raw = spark.createDataFrame(old, "source string, source_record_id string, payload_json string, payload_hash string, ingested_at int")
    got = {(r.source, r.source_record_id): r.payload_json for r in reports.website_records(raw, results, targets).collect()}
    assert set(got) == {("csv", "uei:U2"), ("websites", "uei:U2")} and '"website":"b.test"' in got["websites", "uei:U2"] and '"uei":"U2"' in got["websites", "uei:U2"]
    kept = reports.saved_results(results.limit(0), results)
    assert {(r.search_key, r.status) for r in kept.collect()} == {("uei:U2", "found"), ("n:zed|ga", "none")}
    again = reports.recheck_targets(kept, reports.website_records(raw, results, targets), companies(spark))
    assert [(r.search_key, r.name, r.state, r.uei) for r in again.collect()] == [("uei:U2", "Bolt", "GA", "U2")]


def test_market(spark):
    key = "source string, year int, naics string, naics_label string, geo_level string, geo_code string, geo_name string, establishments bigint, employees bigint, annual_payroll_usd_k bigint, fetched_at int"
    kept = spark.createDataFrame([("c", 2021, "332300", "x", "county", "1", "Polk County, Georgia", 5, None, None, 1), ("c", 2021, "311", "y", "us", "1", "United States", 9, 1, 1, 1), ("c", 2021, "332", "z", "state", "2", "Texas", 9, 1, 1, 1)], key)
    more = spark.createDataFrame([("c", 2021, "332300", "x", "county", "1", "Polk County, Georgia", 7, 3, 2, 2, {"b": 1, "a": 2})], key + ", size_classes map<string,int>")
    stats = reports.stored_stats(kept.withColumn("size_classes_json", F.lit("{}")), more)
    assert {(r.naics, r.establishments, r.size_classes_json) for r in stats.collect()} == {("332300", 7, '{"a":2,"b":1}'), ("311", 9, "{}"), ("332", 9, "{}")}
    assert [(r.naics, r.establishments) for r in reports.market_sidecar(stats, T).collect()] == [("332300", 7)]


def test_conflicts_and_review(spark):
    labels = spark.createDataFrame([("k", 1, "A", None, None, "pursue"), ("k", 2, "A", None, None, "pass"), ("k", 3, "A", None, None, None), ("l", 4, "B", None, None, "pass"), (None, 5, "C", None, None, "pass")], "key string, row_number bigint, company_name string, website string, state string, decision string")
    assert {r.row_number for r in reports.label_conflicts(labels).collect()} == {1, 2}
    records = spark.createDataFrame([(1, "r1", "A", None, "GA", None), (2, "r2", "B", "b.test", None, "rome")], "id bigint, ref string, name string, domain string, state string, city string")
    pairs = spark.createDataFrame([("possible_match", 1, 2, 91.26, "why")], "kind string, a bigint, b bigint, score double, reason string")
    got = reports.review_table(pairs, records)
    assert got.columns == reports.REVIEW and [tuple(r) for r in got.collect()] == [("possible_match", "why", 91.3, "r1", "A", None, "GA", None, "r2", "B", "b.test", None, "rome")]
    calls = spark.createDataFrame([(1, 10, None), (1, None, 5), (None, 5, 5)], "company_id bigint, tokens_in bigint, tokens_out bigint")
    assert tuple(reports.tokens_a_company(calls).first()) == (25, 1, 25.0) and tuple(reports.tokens_a_company(calls.limit(0)).first()) == (0, 0, 0.0)


SCORES = "company_id bigint, name string, domain string, total double, excluded boolean, exclusion_rule string, confidence string, reason string, sector double, size double, geography double, ownership double"


def scores(spark, n=30):
    rows = [(i, f"c{i}", f"{i}.test", float(100 - i), i % 10 == 9, "keyword:x" if i % 10 == 9 else None, "high", "because", 1.0, 1.0, 1.0, 0.5) for i in range(n)]
    return spark.createDataFrame(rows, SCORES)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "key string, company_name string, domain string, decision string")


def test_evaluation(spark):
    labels = labels_of(spark, [(f"d:{i}.test", f"c{i}", f"{i}.test", "pursue" if i < 10 else "pass") for i in range(30)] + [("d:none.test", "none", "none.test", "pass")])
    matches = labels.select(F.col("key").alias("label"), F.regexp_extract("domain", r"(\d+)", 1).try_cast("bigint").alias("company_id"), F.lit("domain").alias("how")).filter("company_id is not null")
    rows, lines = evaluation.evaluate(labels, matches, scores(spark), 92.0, 3)
    assert rows.columns == evaluation.REPORT
    got = {r.label_key: r for r in rows.collect()}
    assert got["d:0.test"].rank == 1 and got["d:0.test"].disagreement == "" and got["d:9.test"].disagreement == "excluded_positive" and got["d:none.test"].disagreement == "unmatched" and got["d:none.test"].matched == "no"
    first = [r.disagreement for r in rows.orderBy(*evaluation.report_order()).collect()]
    assert first == sorted(first, key=evaluation.ORDER.index)
    assert "labels: 31; matched: 30; unmatched: 1 (0 pursue)" == lines[0] and any(x.startswith("from 92 on: TP=9 FP=0 FN=1 TN=20") for x in lines) and any("keyword:x 1" in x for x in lines)
    assert not any("test" in x for x in lines)
    assert {r.rule: r.positives for r in evaluation.excluded_positives(evaluation.matched_items(rows)).collect()} == {"keyword:x": 1}
    with pytest.raises(evaluation.EvaluationRefused, match="10 of 31"):
        evaluation.evaluate(labels, matches.filter("company_id > 8"), scores(spark), 92.0, 3)
    with pytest.raises(evaluation.EvaluationRefused, match="no labels"):
        evaluation.evaluate(labels.limit(0), matches, scores(spark), 92.0, 3)
    with pytest.raises(evaluation.EvaluationRefused, match="disagree"):
        evaluation.evaluate(labels_of(spark, [("k", "a", None, "pass"), ("k", "a", None, "pursue")]), matches, scores(spark), 92.0, 3)


def test_split_labels(spark):
    labels = labels_of(spark, [(f"k{i}", None, None, "pass") for i in range(50)])
    assigned = spark.createDataFrame([("k0", "test"), ("k1", "dev")], "key string, split string")
    test, dev = ({r.key for r in evaluation.split_labels(labels, assigned, s, 0.3, 7).collect()} for s in ("test", "dev"))
    assert "k0" in test and "k1" in dev and test | dev == {f"k{i}" for i in range(50)} and not test & dev
    with pytest.raises(ValueError):
        evaluation.split_labels(labels, assigned, "train", 0.3, 7)
