import json
import os

import pytest
from pyspark.sql import functions as F

from tamarack.functions.grounding import grounded, invalid, normalised
from tamarack.operators.score import EXTRACTION
from tamarack.plans.resolve import resolve
from tamarack.sources import files
from tamarack.streaming import ingest


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv(spark, tmp_path):
    path = write(tmp_path / "c.csv", "﻿Company Name;Website;ST;Employees;Revenue ($M);Contact Email;Misc;Notes\nNorth Pumps;north.test;GA;40-60;1,200.5;a@b.cd;x@y.zz;call 478-555-1234\n;;;;;;;\nOak Mill;;;12;;;q@r.st;\n")
    got = files.read_csv(spark, path).orderBy("name").collect()
    assert [(r.name, r.website, r.state, r.employees, r.revenue_usd_m, r.description) for r in got] == [("North Pumps", "north.test", "GA", 50, 1200.5, None), ("Oak Mill", None, None, 12, None, None)]
    assert got[0].extra == {"Notes": "call [removed]"}
    assert all("Misc" not in r.extra and "Contact Email" not in r.extra for r in got)
    with pytest.raises(files.SourceError):
        files.read_csv(spark, path, {"name": "No Such"})
    with pytest.raises(files.ContactColumnError):
        files.read_csv(spark, path, {"name": "Contact Email"})


def test_headers():
    assert files.is_contact_header("PrimaryContact") and files.is_contact_header("E-mail") and not files.is_contact_header("Company Name")


def test_labels(spark, tmp_path):
    path = write(tmp_path / "l.csv", "Company,Website,State,Decision\nA,a.test,GA,Yes\nB,,NC,pass\n,,,\n")
    assert [(r.company_name, r.decision) for r in files.read_labels(spark, path).orderBy("row_number").collect()] == [("A", "pursue"), ("B", "pass")]
    with pytest.raises(files.SourceError, match="rows 2"):
        files.read_labels(spark, write(tmp_path / "m.csv", "Company,Decision\nA,perhaps\n")).count()


def test_registry(spark, tmp_path):
    def row(**given):
        cells = [""] * 120
        for name, value in (dict(uei="U1", extract_code="A", name="Acme", state="GA", country="USA", naics="332710Y~111111N") | given).items():
            cells[files.REGISTRY_FIELDS[name]] = value
        return "|".join(cells) + "!end\n"

    text = "BOF PUBLIC\n" + row() + row(uei="U2", extract_code="E") + row(uei="U3", state="TX") + row(uei="U4", naics="111111Y").replace("Acme", "Ac\nme") + row(uei="U5", exclusion="D") + row(uei="U6", no_public_display="NPDY") + row(uei="U7", restricted="Y", updated="20210101") + row(uei="U8", naics="", primary_naics="332100") + "short|row!end\n" + "EOF 7\n"
    got = {r.uei: (r.name, r.why) for r in files.read_registry(spark, write(tmp_path / "x.dat", text)).withColumn("why", files.registry_reject(["GA"], ["332"])).collect()}
    assert got == {"U1": ("Acme", None), "U2": ("Acme", "inactive"), "U3": ("Acme", "place"), "U4": ("Ac me", "naics"), "U5": ("Acme", "excluded"), "U6": ("Acme", "not_public"), "U7": ("Acme", "restricted"), "U8": ("Acme", None)}


def test_map(spark, tmp_path):
    tags = lambda **k: "".join(f'<tag k="{a.replace("__", ":")}" v="{b}"/>' for a, b in k.items())
    text = f'<osm><node id="1" lat="0" lon="0">{tags(name="Saw", website="s.test", craft="sawmill", addr__city="Rome")}</node><node id="2">{tags(name="Chain", website="c.test", craft="sawmill", brand="B")}</node><way id="3">{tags(website="n.test", man_made="works", product="steel")}</way><node id="4">{tags(name="Off", craft="sawmill")}</node></osm>'
    got = {r.source_record_id: (r.naics, r.deciding_tag, r.reject_reason) for r in files.read_map(spark, write(tmp_path / "m.osm", text)).collect()}
    assert got == {"node/1": ("321113", "craft=sawmill", None), "node/2": ("321113", "craft=sawmill", "brand"), "way/3": ("3311", "man_made=works", "unnamed")}


def test_statistics_and_awards(spark, tmp_path):
    head = ["NAME", "NAICS2017", "EMPSZES", "EMPSZES_LABEL", "ESTAB", "EMP", "state"]
    data = [head, ["Georgia", "3323", "001", "All", "10", "200", "13"], ["Georgia", "3323", "210", "Small", "7", None, "13"]]
    r = files.read_statistics(spark, write(tmp_path / "s.json", json.dumps(data))).first()
    assert (r.naics, r.area, r.area_name, r.total, r.employees, r.classes["210"].n) == ("3323", "state:13", "Georgia", 10, 200, 7)
    page = {"prefix": "332", "state": "GA", "results": [{"amount": 1.5, "recipient_id": "R", "name": "A", "code": "c", "uei": None}, {"amount": 2.0, "recipient_id": None}]}
    assert [(x.recipient_id, x.amount) for x in files.read_awards(spark, write(tmp_path / "a.json", json.dumps(page))).collect()] == [("R", 1.5)]


def test_areas():
    assert files.parse_area("county:*/state:13") == {"level": "county", "codes": ("*",), "within": "13"}
    for bad in ("county:1", "state:x", "moon"):
        with pytest.raises(files.SourceError):
            files.parse_area(bad)
    assert set(files.REGISTRY) >= {"csv", "labels", "registry_extract", "map", "market_statistics", "awards"}


def test_grounding(spark):
    kind = EXTRACTION.replace(" struct<", ":struct<").replace(" array<", ":array<").replace(" string", ":string")
    site = ("One. Two. Three.", ["Castings", "castings ", "n/a"], ["x"], None, (50, "We employ 50 people", 1, 9000, 1990), ("yes", "maybe", 12, "no", "unknown"), [("founded_year", "/", "since 1990"), ("a", "/", "not  HERE"), ("b", "/", " ")])
    d = spark.createDataFrame([("We  employ 50 people since 1990 in a shop", site), ("nothing", site)], f"doc string, x struct<{kind}>").withColumn("x", normalised(F.col("x")))
    out, dropped = grounded(F.col("x"), F.col("doc"))
    a, b = d.select(out.alias("o"), dropped.alias("d"), invalid(F.col("x")).alias("i")).collect()
    assert a.o.summary == "One. Two." and a.o.product_lines == ["Castings"] and a.o.size_signals.employee_count == 50 and a.o.size_signals.founded_year == 1990
    assert a.d == ["evidence:1", "facility_sqft_total"] and [e.claim for e in a.o.evidence] == ["founded_year"] and a.i == ["family_owned", "generation"]
    assert b.d == ["evidence:2", "employee_count", "founded_year", "facility_sqft_total"] and b.o.evidence == []


def test_streams(spark, tmp_path):
    feed = tmp_path / "in"
    os.makedirs(feed)
    kind = "k string, h string, t timestamp, v int"

    def put(name, rows):
        spark.createDataFrame(rows, "k string, h string, t string, v int").selectExpr("k", "h", "cast(t as timestamp) t", "v").coalesce(1).write.parquet(str(feed / name))

    put("a", [("x", "1", "2025-01-01 00:00:00", 1), ("x", "2", "2025-01-02 00:00:00", 2), ("y", "1", "2025-01-01 00:00:00", 1)])
    stream = spark.readStream.schema(kind).parquet(str(feed) + "/*")
    keep = lambda: ingest.keep_table(stream, str(tmp_path / "out"), ["k"], "h", ["t"], str(tmp_path / "cp")).awaitTermination(60)
    assert keep()
    put("b", [("y", "1", "2025-01-03 00:00:00", 9), ("z", "1", "2025-01-03 00:00:00", 3)])
    assert keep()
    assert {(r.k, r.v) for r in ingest.current_table(spark, str(tmp_path / "out"), spark.read.parquet(str(feed / "a")).schema).collect()} == {("x", 2), ("y", 1), ("z", 3)}
    days = ingest.requests_by_day(stream, "t", "k").writeStream.format("memory").queryName("days").outputMode("complete").trigger(availableNow=True).start()
    assert days.awaitTermination(60) and spark.table("days").agg(F.sum("requests")).first()[0] == 5


def test_resolve(spark):
    def raw(i, source, name, **given):
        return (i, source, f"r{i}", json.dumps({"name": name, "extra": {}} | given), str(i), f"2025-01-{i:02d} 00:00:00")

    rows = spark.createDataFrame([
        raw(1, "csv", "Acme Tools Inc", state="GA", city="Macon"), raw(2, "sam", "ACME TOOL LLC", state="Georgia", city="MACON", website="www.acme.test", employees=40),
        raw(3, "osm", "Acme Tools", website="http://acme.test/x", state="GA"), raw(4, "osm", "Birch Mill", state="NC"), raw(5, "osm", "n/a"),
    ], "id bigint, source string, source_record_id string, payload_json string, payload_hash string, t string").selectExpr("*", "cast(t as timestamp) ingested_at")
    order = spark.createDataFrame([("csv", 1), ("sam", 2)], "source string, priority bigint")
    former = spark.createDataFrame([(3, 77), (4, 5)], "id bigint, company_id bigint")
    out = resolve(rows, [], order, former)
    got = {r.company_id: (r.canonical_name, r.domain, r.employee_count) for r in out.companies.collect()}
    assert got == {77: ("Acme Tools Inc", "acme.test", 40), 5: ("Birch Mill", None, None), 78: (None, None, None)}
    split = spark.createDataFrame([(2, 3, "split")], "a bigint, b bigint, kind string")
    assert resolve(rows, [], order, former, split).companies.count() == 4


def test_label_rows_are_numbered_over_all_files(spark, tmp_path):
    rows = [(f"c{i}" if i % 7 else "", None, "two\nlines" if i % 3 else "GA", "ja" if i % 2 else "nein") for i in range(60)]
    spark.createDataFrame(rows, "Firm string, website string, ST string, said string").repartition(5).write.option("header", True).option("escape", '"').csv(str(tmp_path / "l"))
    got = files.read_labels(spark, str(tmp_path / "l"), {"name": "Firm", "state": "ST", "decision": "said"}, {"Ja": "pursue", "nein ": "pass"}).collect()
    numbers = [r.row_number for r in got]
    assert len(set(numbers)) == len(numbers) == sum(1 for i in range(60) if i % 7) and min(numbers) >= 2 and max(numbers) <= 61
    assert {(r.company_name, r.decision) for r in got} == {(a, "pursue" if d == "ja" else "pass") for a, _, _, d in rows if a} and {r.state for r in got} == {"GA", "two\nlines"}
    with pytest.raises(files.SourceError, match="pursue or pass"):
        files.read_labels(spark, str(tmp_path / "l"), {"name": "Firm", "decision": "said"}, {"ja": "perhaps"})


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    kind = "k string, h string, t int"
    where = str(tmp_path / "out")
    ingest._point(spark, where, 4, 3)
    assert ingest._pointer(spark, where) == (4, 3)
    ingest._point(spark, where, 5, None)
    assert ingest._pointer(spark, where) == (5, None)
    feed = tmp_path / "feed2"
    spark.createDataFrame([("x", "1", 1)], kind).write.parquet(str(feed / "a"))
    for progress in ("p1", "p2"):  # the second stream has forgotten that batch 0 was done
        stream = spark.readStream.schema(kind).parquet(str(feed) + "/*")
        ingest.keep_table(stream, str(tmp_path / "kept"), ["k"], "h", ["t"], str(tmp_path / progress)).awaitTermination(60)
        assert [tuple(r) for r in ingest.current_table(spark, str(tmp_path / "kept"), spark.createDataFrame([], kind).schema).collect()] == [("x", "1", 1)]
    assert ingest.current_table(spark, str(tmp_path / "nothing"), spark.createDataFrame([], kind).schema).count() == 0
