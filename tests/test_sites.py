import json
import zipfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tamarack.functions import times
from tamarack.operators import cached, sites
from tamarack.plans.enrich import ask, documents_of, enrich
from tamarack.sources import files, sinks


def page(title, body):
    return f"<html><head><title>{title}</title></head><body><p>{body}</p></body></html>"


def test_find_sites(spark):
    targets = spark.createDataFrame([(1, "Northfield Castings Inc", "Macon", "GA"), (2, "Birchwood Tooling LLC", "Rome", "GA"), (3, "United Services Group", "Rome", "GA"), (4, "Oakvale Pumps Inc", "Rome", "GA"), (5, "Elmhurst Precision Valves", None, "NC")], "company_id bigint, name string, city string, state string")
    pages = spark.createDataFrame([
        ("northfieldcastings.com", page("Northfield Castings | Home", "Foundry in Macon")), ("birchwoodtooling.com", page("Birchwood Tooling", "nothing about a place")), ("oakvalepumps.com", page("Oakvale Pumps", "Buy this domain in Rome, GA")),
        ("elmhurstprecisionvalves.com", page("Elmhurst Precision Valves", "Charlotte, NC 28202")), ("elmhurst-precision-valves.com", page("Elmhurst Precision Valves", "North Carolina")),
    ], "domain string, html string")
    got = {r.company_id: (r.status, r.domain, r.confidence) for r in sites.find_sites(targets, pages).collect()}
    assert got == {1: ("found", "northfieldcastings.com", 0.95), 2: ("not_found", None, None), 3: ("too_generic", None, None), 4: ("not_found", None, None), 5: ("ambiguous", None, None)}
    before = spark.createDataFrame([(1, "found", "northfieldcastings.com"), (2, "found", "x.com"), (9, "found", "y.com")], "company_id bigint, status string, domain string")
    assert {r.outcome: r.companies for r in sites.recheck(before, targets, pages).collect()} == {"same": 1, "removed": 1, "not_replayable": 1}


def test_cache(spark):
    now = F.lit(datetime(2025, 1, 10))
    kept = spark.createDataFrame([("a", datetime(2025, 1, 9), "x"), ("b", datetime(2024, 1, 1), "y")], "url string, fetched_at timestamp, body string")
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "url string")
    assert sorted(r.url for r in cached.pending(asked, kept, ["url"], now, timedelta(days=30)).collect()) == ["b", "c"]
    assert sorted(r.url for r in cached.pending(asked, kept, ["url"], now).collect()) == ["c"]
    assert {r.url: r.replayable for r in cached.replay(asked, kept, ["url"]).collect()} == {"a": True, "b": True, "c": False}
    d = spark.createDataFrame([(s,) for s in (200, 301, 404, 500, 403)], "s int").select(cached.cacheable(F.col("s")).alias("a"), cached.cacheable_page(F.col("s")).alias("p")).collect()
    assert [(r.a, r.p) for r in d] == [(True, True), (False, True), (True, True), (False, False), (False, True)]


def test_samples_that_were_checked(spark):
    sample = spark.createDataFrame([("a.test", "A", "old"), ("b.test", "B2", "old"), ("c.test", "C", "old")], "domain string, name string, evidence string")
    fresh = spark.createDataFrame([("a.test", "A", "new"), ("b.test", "B", "one"), ("c.test", "X", "1"), ("c.test", "Y", "2")], "domain string, name string, evidence string")
    assert {r.domain: r.evidence for r in cached.refresh_sample(sample, fresh, ["evidence"]).collect()} == {"a.test": "new", "b.test": "one", "c.test": None}
    rows = spark.createDataFrame([("a.test", "Q", "GA"), (None, "A", "GA"), (None, "A", "NC")], "domain string, name string, state string")
    earlier = spark.createDataFrame([("a.test", "Z", None), (None, "A", "GA")], "domain string, name string, state string")
    assert [tuple(r) for r in cached.not_sampled(rows, earlier).select("name", "state").collect()] == [("A", "NC")]


def test_times(spark):
    assert times.parse_age("12h") == timedelta(hours=12)
    with pytest.raises(ValueError):
        times.parse_age("soon")
    d = spark.createDataFrame([("2025-10-01",), ("2025-09-30",), ("2025-11-01",)], "d string").select(F.to_date("d").alias("d"))
    got = d.select(times.fiscal_year(F.col("d")).alias("y"), times.fiscal_window(F.col("d")).alias("w"), times.latest_month(F.col("d")).cast("string").alias("m")).collect()
    assert [(r.y, str(r.w.first), str(r.w.last), r.m) for r in got] == [(2026, "2025-10-01", "2026-09-30", "2025-09-07"), (2025, "2024-10-01", "2025-09-30", "2025-09-07"), (2026, "2025-10-01", "2026-09-30", "2025-10-05")]


ANSWER = {"summary": "We cast. Founded by John Smith. More.", "product_lines": ["castings"], "end_markets": [], "business_model": None, "size_signals": {"employee_count": 50, "employee_count_quote": "50 people work here", "founded_year": 1999},
          "ownership": {"family_owned": "yes"}, "evidence": [{"claim": "family_owned", "page": "/", "quote": "our family"}]}


def test_enrich(spark):
    companies = spark.createDataFrame([(1, "Acme", "Rome", "a.test"), (2, "Nosite", None, None), (3, "Empty", None, "e.test"), (4, "Odd", None, "o.test"), (5, "Down", None, "d.test")], "company_id bigint, name string, city string, domain string")
    pages = spark.createDataFrame([(1, "/", page("Acme", "50 people work here for our family")), (1, "/about", page("About", "call 478-555-1234")), (4, "/", page("Odd", "odd")), (5, "/", page("Down", "down"))], "company_id bigint, path string, html string")
    answer = json.dumps(ANSWER)

    def model(document):
        if "Down" in document:
            raise ConnectionError
        return "not json" if "Odd" in document else answer

    got = {r.company_id: r for r in enrich(companies, pages, model, "stub").collect()}
    assert {i: r.status for i, r in got.items()} == {1: "ok", 2: "no_website", 3: "no_text", 4: "llm_invalid_output", 5: "llm_unavailable"}
    x = got[1].extraction
    assert x.summary == "We cast. Founded by [PERSON]." and x.size_signals.employee_count == 50 and x.size_signals.founded_year is None and got[1].dropped == ["founded_year"]
    docs = documents_of(pages)
    assert "[removed]" in docs.filter("company_id = 1").first().document
    kept = spark.createDataFrame([(got[1].key, got[1].answer)], "key string, answer string")
    assert {r.company_id: r.cache_hit for r in ask(docs, model, "stub", kept).collect()} == {1: True, 4: False, 5: False}


def test_quotes_are_masked(spark):
    companies = spark.createDataFrame([(1, "Acme", "Rome", "a.test"), (2, "John Smith Tool", None, "b.test")], "company_id bigint, name string, city string, domain string")
    said = "Founded by John Smith in 1950. President John Smith employs 50 people. We cast."
    pages = spark.createDataFrame([(i, "/", page("Acme", said)) for i in (1, 2)], "company_id bigint, path string, html string")
    evidence = [{"claim": "family_owned", "page": "/", "quote": q} for q in ("Founded by John Smith in 1950", "We cast")]
    answer = json.dumps(ANSWER | {"size_signals": {"employee_count": 50, "employee_count_quote": "President John Smith employs 50 people"}, "evidence": evidence})
    got = {r.company_id: r.extraction for r in enrich(companies, pages, lambda document: answer, "stub").collect()}
    assert got[1].size_signals.employee_count_quote == "President [PERSON] employs 50 people" and [e.quote for e in got[1].evidence] == ["Founded by [PERSON] in 1950", "We cast"]
    assert got[2].evidence[0].quote == "Founded by John Smith in 1950" and got[1].evidence[0].page == "/"
    bare = enrich(companies, pages, lambda document: json.dumps({"summary": "Led by John Smith."}), "stub").filter("company_id = 1").first().extraction
    assert bare.summary == "Led by [PERSON]." and bare.evidence is None


def test_archive_and_requests(spark, tmp_path):
    cells = [""] * 120
    cells[files.REGISTRY_FIELDS["uei"]], cells[files.REGISTRY_FIELDS["name"]] = "U1", "Ac\nme"
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("readme.txt", "no")
        z.writestr("x.dat", "BOF\n" + "|".join(cells) + "!end\nshort!end\nEOF\n")
    assert [(r.uei, r.name) for r in files.read_registry_archive(spark, str(tmp_path / "x.zip")).collect()] == [("U1", "Ac me")]
    ref = spark.createDataFrame([("3321",), ("3327",), ("33271",), ("332710",)], "code string")
    assert sorted(tuple(r) for r in files.expand_prefixes(spark, ["332", "3327", "33271"], ref).collect()) == [("332", "3321"), ("332", "3327"), ("3327", "3327"), ("33271", "332710")]
    assert files.request_grid(spark, ["332", "333"], ["us", "county:*/state:13"], 2022).count() == 4
    with pytest.raises(files.SourceError):
        files.request_grid(spark, ["332"], ["us"], 2016)
    (tmp_path / "o.yaml").write_text("merge:\n- [r1, r2]\nsplit:\n- [r2, nobody]\n")
    pairs, unknown = files.load_overrides(spark, str(tmp_path / "o.yaml"), spark.createDataFrame([("r1", 1), ("r2", 2)], "ref string, id bigint"))
    assert [tuple(r) for r in pairs.collect()] == [(1, 2, "merge")] and unknown == 1


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([(2, ["a", "b"]), (1, [])], "id bigint, x array<string>")
    sinks.write_csv(d, str(tmp_path / "out"), ["id", "x"], ["id"])
    assert [(r.id, r.x) for r in spark.read.option("header", True).csv(str(tmp_path / "out")).orderBy("id").collect()] == [("1", None), ("2", "a; b")]
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_csv(d, str(tmp_path / "out"), ["id"])
    sinks.write_once(tmp_path / "m.json", {"a": 1})
    with pytest.raises(sinks.Refused):
        sinks.write_once(tmp_path / "m.json", {})
    with pytest.raises(KeyError), sinks.recorded_run(tmp_path / "log", "score", {"k": 1}) as stats:
        stats["n"] = 3
        raise KeyError
    entry = json.loads((tmp_path / "log").read_text())
    assert entry["status"] == "failed" and entry["stats"] == {"n": 3}


def test_requests_are_spaced(spark):
    import random

    r = random.Random(2)
    rows = [(i, r.choice(["a", "b", None]), float(r.choice([0, 0, 5, 40, 41, r.randrange(200)]))) for i in range(300)]
    want, last = {}, {}
    for i, host, at in sorted(rows, key=lambda x: (x[2], x[0])):
        want[i] = last[host] = max(at, last.get(host, -1e9) + 2.5)
    d = spark.createDataFrame(rows, "id bigint, host string, at double")
    got = {x.id: x.starts for x in cached.spaced(d, "host", "at", "id", 2.5).collect()}
    assert got == pytest.approx(want) and cached.spaced(d.limit(0), "host", "at", "id", 2.5).count() == 0


def test_facts_and_counts(spark):
    from tamarack.plans.enrich import load_facts
    from tamarack.plans.resolve import Resolved, resolve_stats, stale_companies

    firms = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    kept = spark.createDataFrame([(1, "ok", '{"summary": "x", "product_lines": ["a"]}'), (2, "failed", '{"summary": "y"}')], "company_id bigint, status string, extraction_json string")
    got = {x.company_id: (x.enrichment_status, x.extraction and x.extraction.summary) for x in load_facts(firms, kept).collect()}
    assert got == {1: ("ok", "x"), 2: ("failed", None), 3: (None, None)}
    held = spark.createDataFrame([(1, 10), (2, 10), (3, 11)], "id bigint, company_id bigint")
    former = spark.createDataFrame([(1, 10), (2, 12), (9, None)], "id bigint, company_id bigint")
    review = spark.createDataFrame([("merge_blocked",), ("possible_match",)], "kind string")
    counts = resolve_stats(Resolved(firms, held, review, firms.limit(1)), former).first().asDict()
    assert counts == {"records": 3, "companies": 2, "multi_record": 1, "new": 1, "removed": 1, "review_items": 2, "merges_blocked": 1, "oversized_blocks": 1}
    assert [x.company_id for x in stale_companies(held, former).collect()] == [12]
