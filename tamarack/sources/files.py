"""Sources that lie in files: CSV lists, labels, registry extracts, maps, market statistics and awards."""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import typed_int, typed_revenue
from ..functions.text import MAIL, NUMBER, scrub_contacts
from ..session import settle


class SourceError(ValueError):
    """What is wrong with a source; never its values."""


class ContactColumnError(SourceError):
    pass


#: Sources by name; a source is a function of the session and its own arguments that gives a DataFrame.
REGISTRY: dict[str, Callable[..., DataFrame]] = {}


def source(name: str) -> Callable:
    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        REGISTRY[name] = f
        return f

    return add


# Headers by field, squashed to letters, and words of headers that hold contact details.
HEADERS = {
    "name": "name company companyname businessname legalname accountname organization organisation".split(),
    "website": "website url domain web homepage site websiteurl companywebsite".split(),
    "city": "city town hqcity".split(),
    "state": "state st province stateprovince hqstate".split(),
    "country": "country hqcountry".split(),
    "naics": "naics naicscode primarynaics".split(),
    "employees": "employees employeecount headcount numemployees fte staffcount".split(),
    "revenue": "revenue annualrevenue sales revenueusd revenuem revenueusdm revenuemm".split(),
    "description": "description desc about businessdescription".split(),
    "source_record_id": "id recordid companyid sourceid".split(),
}
CONTACT_WORDS = set("email emails phone phones telephone tel mobile cell fax contact contacts linkedin person ceo president street address zip zipcode postal".split())
CONTACT_PAIRS = {("e", "mail"), ("first", "name"), ("last", "name"), ("full", "name"), ("owner", "name"), ("linked", "in")}
PERSON_URL = "(?i)linkedin\\.com/in/"


def squash(header: str) -> str:
    return re.sub("[^a-z]", "", header.lower())


def header_words(header: str) -> list[str]:
    return re.findall("[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", header).lower())


def is_contact_header(header: str) -> bool:
    words = header_words(header)
    return bool(CONTACT_WORDS & set(words) or CONTACT_PAIRS & set(zip(words, words[1:])))


def _head(spark: SparkSession, path: str | Path, size: int) -> str:
    """The first bytes of a file, or of the first file of a folder, wherever the session's file systems have it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((str(f.getPath()) for f in fs.listStatus(where) if f.isFile() and f.getLen() and not f.getPath().getName().startswith(("_", "."))))
    if not files:
        return ""
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(files[0]))
    try:
        return bytes(stream.readNBytes(size)).decode("utf-8-sig", "replace")
    finally:
        stream.close()


def sniff(spark: SparkSession, path: str | Path, size: int = 8192) -> str:
    """The delimiter of a CSV file among comma, semicolon, tab and bar; a comma if it can't be told."""
    try:
        return csv.Sniffer().sniff(_head(spark, path, size), delimiters=",;\t|").delimiter
    except csv.Error:
        return ","


def _table(spark: SparkSession, path: str | Path) -> DataFrame:
    """A CSV file as strings: quoted fields may hold line breaks."""
    rows = spark.read.option("header", True).option("sep", sniff(spark, path)).option("multiLine", True).option("quote", '"').option("escape", '"').csv(str(path))
    return rows.toDF(*[c.lstrip("\ufeff") for c in rows.columns])


def plan_columns(table: DataFrame, overrides: Mapping[str, str] | None = None) -> tuple[dict[str, str], list[str], list[str]]:
    """(field to header, dropped headers, further headers) of a table of strings.

    Headers are told by their squashed letters, or given by ``overrides`` (field to header).  Columns of contact details,
    by header or because half of their values are nothing else, are dropped; one pass over the table counts them all.
    """
    headers = table.columns
    overrides = dict(overrides or {})
    if bad := sorted(set(overrides) - set(HEADERS)):
        raise SourceError(f"unknown field {bad[0]}")
    if missing := [f for f, h in overrides.items() if h not in headers]:
        raise SourceError(f"no such column for {missing[0]}")
    if any(is_contact_header(h) for h in overrides.values()):
        raise ContactColumnError("a contact column can't be mapped")
    filled = lambda h: F.trim(F.col(f"`{h}`")) != ""
    whole = f"^\\s*(?:{MAIL}|{NUMBER})\\s*$|{PERSON_URL}"
    shares = table.agg(*[F.avg(F.when(filled(h), F.col(f"`{h}`").rlike(whole).cast("double"))).alias(f"c{i}") for i, h in enumerate(headers)]).first()
    dropped = [h for i, h in enumerate(headers) if h not in overrides.values() and (is_contact_header(h) or (shares[f"c{i}"] or 0) >= 0.5)]
    plan = dict(overrides)
    for field, names in HEADERS.items():
        if field not in plan:
            for h in headers:
                if squash(h) in names and h not in dropped and h not in plan.values():
                    plan[field] = h
                    break
    if "name" not in plan:
        raise SourceError("no column for the company's name")
    return plan, dropped, [h for h in headers if h not in dropped and h not in plan.values()]


@source("csv")
def read_csv(spark: SparkSession, path: str, overrides: Mapping[str, str] | None = None, revenue_unit: str = "usd_m") -> DataFrame:
    """Records of a CSV list in the shape of raw records; rows without a name are left out, contact details in texts are removed."""
    table = _table(spark, path)
    plan, _, extra = plan_columns(table, overrides)
    get = lambda f: F.nullif(F.trim(F.col(f"`{plan[f]}`")), F.lit("")) if f in plan else F.lit(None).cast("string")
    rest = [x for h in extra for x in (F.lit(h), scrub_contacts(F.col(f"`{h}`")))]
    extras = F.map_filter(F.create_map(*rest), lambda _, v: F.coalesce(v != "", F.lit(False))) if rest else F.create_map().cast("map<string,string>")
    rows = table.select(get("source_record_id").alias("source_record_id"), get("name").alias("name"), get("website").alias("website"), get("city").alias("city"), get("state").alias("state"), get("country").alias("country"),
                        get("naics").alias("naics"), typed_int(get("employees")).alias("employees"), typed_revenue(get("revenue"), revenue_unit).alias("revenue_usd_m"), scrub_contacts(get("description")).alias("description"), extras.alias("extra"))
    return rows.filter("name is not null").withColumn("source", F.lit("csv"))


# What labels may say.
LABELS = {"pursue": "pursue yes y 1 true target".split(), "pass": "pass no n 0 false".split()}


def _row_numbers(table: DataFrame, out: str, first: int) -> DataFrame:
    """Adds the number of each row in the order of the files; rows are counted by partitions, one row each at the driver."""
    place = F.monotonically_increasing_id()
    marked = settle(table.withColumn("__id", place).withColumn("__part", F.shiftright("__id", 33).cast("int")))
    starts, total = [], first
    for r in marked.groupBy("__part").agg(F.count("*").alias("n"), F.min("__id").alias("low")).orderBy("__part").collect():
        starts.append((r["__part"], total - r.low))
        total += r.n
    offsets = F.broadcast(table.sparkSession.createDataFrame(starts, "__part int, __start bigint"))
    return marked.join(offsets, "__part").withColumn(out, F.col("__id") + F.col("__start")).drop("__id", "__part", "__start")


@source("labels")
def read_labels(spark: SparkSession, path: str, columns: Mapping[str, str] | None = None, decisions: Mapping[str, str] | None = None) -> DataFrame:
    """(row_number, company_name, website, state, decision) of a labels file; SourceError with the numbers of rows whose decision means nothing.

    Row numbers are those of a table on a screen: the header is row 1.  ``columns`` gives headers by field (name, website,
    state, decision), ``decisions`` what further words mean (pursue or pass); both beside what is known anyway.
    """
    table = _table(spark, path)
    named = dict(columns or {})
    verdict = named.pop("decision", None) or next((h for h in table.columns if squash(h) in ("decision", "label", "verdict")), None)
    if verdict is None or verdict not in table.columns:
        raise SourceError("no column for the decision")
    if bad := sorted(set((decisions or {}).values()) - set(LABELS)):
        raise SourceError(f"a decision is pursue or pass, not {bad[0]}")
    plan, _, _ = plan_columns(table, named)
    text = lambda f: F.nullif(F.trim(F.col(f"`{plan[f]}`")), F.lit("")) if f in plan else F.lit(None).cast("string")
    said = F.lower(F.trim(F.col(f"`{verdict}`")))
    words = {d: [*LABELS[d], *(k.strip().lower() for k, v in (decisions or {}).items() if v == d)] for d in LABELS}
    means = F.when(said.isin(*words["pursue"]), "pursue").when(said.isin(*words["pass"]), "pass")
    rows = _row_numbers(table.select(text("name").alias("company_name"), text("website").alias("website"), text("state").alias("state"), means.alias("decision")), "row_number", 2)
    rows = rows.filter("company_name is not null").select("row_number", "company_name", "website", "state", "decision")
    bad = [r.row_number for r in rows.filter("decision is null").select("row_number").orderBy("row_number").limit(20).collect()]
    if bad:
        raise SourceError(f"no decision in rows {', '.join(map(str, bad))}")
    return rows


# Places (from 0) of the registry extract's columns that are read, and the day from which restricted data are free.
REGISTRY_FIELDS = {"uei": 0, "extract_code": 5, "updated": 9, "name": 11, "city": 17, "state": 18, "country": 21, "restricted": 23, "website": 26, "primary_naics": 32, "naics": 34, "exclusion": 115, "no_public_display": 118}
REJECTS = ["inactive", "not_public", "excluded", "place", "naics", "restricted"]
FREE_FROM = "20220404"


@source("registry_extract")
def read_registry(spark: SparkSession, path: str, fields: Mapping[str, int] = REGISTRY_FIELDS, least: int = 119) -> DataFrame:
    """Records of a bar-delimited extract that end in !end: BOF and EOF lines apart, inner line breaks as spaces, at least ``least`` columns."""
    lines = spark.read.option("lineSep", "!end\n").text(str(path)).select(F.regexp_replace("value", "^BOF[^\\n]*\\n", "").alias("v"))
    columns = F.split(F.regexp_replace("v", "\\n", " "), "\\|", -1)
    rows = lines.filter(~F.col("v").startswith("EOF")).select(columns.alias("c")).filter(F.size("c") >= least)
    return rows.select(*[F.nullif(F.trim(F.get("c", i)), F.lit("")).alias(n) for n, i in fields.items()])


def registry_reject(states: Sequence[str], prefixes: Sequence[str]) -> Column:
    """Why a registry record is left out, by the first rule it breaks in their order; null for those that stay."""
    from ..functions.keys import naics_codes_of, naics_matches

    codes = F.array_distinct(F.concat(F.array_compact(F.array("primary_naics")), F.transform(F.coalesce(naics_codes_of(F.col("naics")), F.array().cast("array<struct<code:string,flag:string>>")), lambda x: x["code"])))
    no = lambda c: ~F.coalesce(c, F.lit(False))
    tests = [
        no(F.col("extract_code") == "A"), F.upper("no_public_display").startswith("NPDY"), F.col("exclusion") == "D", no((F.col("country") == "USA") & F.col("state").isin(*states)),
        ~naics_matches(codes, prefixes), (F.col("restricted") == "Y") & (F.coalesce("updated", F.lit("")) < FREE_FROM),
    ]
    return F.coalesce(*[F.when(t, why) for t, why in zip(tests, REJECTS)])


# What map tags say of makers.
CRAFT = {
    "brewery": "312120", "winery": "312130", "distillery": "312140", "cider": "312130", "metal_construction": "332312", "welder": "332312", "blacksmith": "332111", "window_construction": "332321",
    "cabinet_maker": "337110", "joiner": "321911", "furniture": "337122", "upholsterer": "337121", "sawmill": "321113", "boatbuilder": "336612", "confectionery": "311340", "bakery": "311812",
    "signmaker": "339950", "printer": "323111", "electronics": "334", "toolmaker": "333514", "agricultural_engines": "333111", "steel": "3311",
}
INDUSTRIAL = {
    "brewery": "312120", "distillery": "312140", "winery": "312130", "bakery": "311812", "food_industry": "311", "food": "311", "machine_shop": "332710", "metal_processing": "332", "metal_working": "332",
    "metal": "332", "steel": "3311", "furniture": "337", "plastic": "3261", "plastics": "3261", "chemical": "325", "paper": "322", "sawmill": "321113", "concrete_plant": "327320", "printing": "323111",
    "textile": "313", "aerospace": "336413", "electronics": "334", "automotive": "3363", "factory": None, "manufacturing": None, "yes": None,
}
PRODUCT = {
    "beer": "312120", "wine": "312130", "spirits": "312140", "bread": "311812", "furniture": "337", "concrete": "327320", "steel": "3311", "plastic": "3261", "paper": "322", "chemicals": "325", "food": "311",
    "machinery": "333",
}


def tag(name: str) -> Column:
    return F.get(F.filter("tag", lambda t: t["_k"] == name), 0)["_v"]


@source("map")
def read_map(spark: SparkSession, path: str) -> DataFrame:
    """Named makers with a web site of a map in XML: (kind, source_record_id, name, website, city, naics, deciding_tag, reject_reason)."""
    schema = "_id string, tag array<struct<_k:string,_v:string>>"
    parts = [spark.read.format("xml").option("rowTag", k).schema(schema).load(str(path)).withColumn("kind", F.lit(k)) for k in ("node", "way", "relation")]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).filter("tag is not null")
    site = F.coalesce(tag("website"), tag("contact:website"))
    look = lambda table, c: F.try_element_at(F.create_map(*[F.lit(x) for k, v in table.items() for x in (k, v or "")]), c)
    craft, industrial, made, product = look(CRAFT, tag("craft")), look(INDUSTRIAL, tag("industrial")), tag("man_made") == "works", look(PRODUCT, tag("product"))
    maker = F.when(craft.isNotNull(), F.concat(F.lit("craft="), tag("craft"))).when(industrial.isNotNull(), F.concat(F.lit("industrial="), tag("industrial"))).when(made, "man_made=works")
    naics = F.nullif(F.when(craft.isNotNull(), craft).when(industrial.isNotNull(), F.coalesce(F.nullif(industrial, F.lit("")), product)).when(made, product), F.lit(""))
    reject = F.when(tag("name").isNull(), "unnamed").when(tag("brand").isNotNull(), "brand").when(maker.isNull(), "no maker")
    return rows.filter(site.isNotNull()).select("kind", F.concat("kind", F.lit("/"), "_id").alias("source_record_id"), tag("name").alias("name"), site.alias("website"), tag("addr:city").alias("city"), naics.alias("naics"), maker.alias("deciding_tag"), reject.alias("reject_reason"))


@source("market_statistics")
def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    """One row a sector and area out of arrays of arrays with a header row: totals of size class 001, the other classes as a map."""
    from ..operators.market import pivot_classes

    whole = spark.read.option("wholetext", True).text(str(path)).select(F.from_json("value", "array<array<string>>").alias("a"))
    rows = whole.select(F.get("a", 0).alias("h"), F.explode(F.slice("a", 2, 1 << 30)).alias("r"))
    at = lambda n: F.get("r", (F.array_position("h", n) - 1).cast("int"))
    area = F.coalesce(*[F.when(F.array_contains("h", g), F.concat(F.lit(f"{g}:"), F.coalesce(at("state"), F.lit("")) if g == "county" else F.lit(""), at(g))) for g in ("county", "state", "us")])
    flat = rows.filter(F.coalesce(at("LFO"), F.lit("001")) == "001").select(
        F.coalesce(at("NAICS2017"), F.lit("")).alias("naics"), area.alias("area"), at("NAME").alias("area_name"), F.coalesce(at("EMPSZES"), F.lit("001")).alias("code"), at("EMPSZES_LABEL").alias("label"),
        at("ESTAB").try_cast("bigint").alias("n"), at("EMP").try_cast("bigint").alias("employees"), at("EMP_N").alias("noise_flag"), at("PAYANN").try_cast("bigint").alias("payroll_usd_k"),
    )
    totals = flat.filter("code = '001'").groupBy("naics", "area").agg(*[F.max(c).alias(c) for c in ("area_name", "employees", "noise_flag", "payroll_usd_k")])
    return pivot_classes(flat, ["naics", "area"], "code", "label", "n").join(totals, ["naics", "area"], "left")


@source("awards")
def read_awards(spark: SparkSession, path: str) -> DataFrame:
    """Award rows of result pages in JSON, one object a line: (recipient_id, name, uei, amount, code)."""
    pages = spark.read.schema("results array<struct<amount:double,recipient_id:string,name:string,code:string,uei:string>>, prefix string, state string").json(str(path))
    return pages.select("prefix", "state", F.explode("results").alias("r")).select("r.*", "prefix", "state").filter("recipient_id is not null")


def parse_area(text: str) -> dict[str, object]:
    """An area out of "us", "state:13,37" or "county:*/state:13"."""
    if text == "us":
        return {"level": "us", "codes": (), "within": None}
    m = re.fullmatch(r"(state|county):(\*|\d+(?:,\d+)*)(?:/state:(\d+))?", text)
    if not m or (m[1] == "county") != bool(m[3]):
        raise SourceError("an area is us, state:<codes> or county:<codes>/state:<code>")
    return {"level": m[1], "codes": tuple(m[2].split(",")), "within": m[3]}


@source("registry_archive")
def read_registry_archive(spark: SparkSession, path: str, fields: Mapping[str, int] = REGISTRY_FIELDS, least: int = 119) -> DataFrame:
    """As read_registry, of ZIP archives: the first .dat member of each is read as a stream, one archive a task, since ZIP can't be split."""
    import io
    import zipfile
    from collections.abc import Iterator

    import pandas as pd

    names, places = list(fields), list(fields.values())

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for content in part["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    member = next((n for n in z.namelist() if n.lower().endswith(".dat")), None)
                    if member is None:
                        continue
                    out, held = [], ""
                    for line in io.TextIOWrapper(z.open(member), encoding="utf-8", errors="replace"):
                        line = line.rstrip("\r\n")
                        if line.startswith(("BOF", "EOF")):
                            continue
                        held = f"{held} {line}" if held else line
                        if not held.endswith("!end"):
                            continue
                        cells = held[:-4].split("|")
                        held = ""
                        if len(cells) >= least:
                            out.append([cells[i].strip() or None for i in places])
                        if len(out) >= 10_000:
                            yield pd.DataFrame(out, columns=names)
                            out = []
                    yield pd.DataFrame(out, columns=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(rows, ", ".join(f"{n} string" for n in names))


def expand_prefixes(spark: SparkSession, prefixes: Sequence[str], reference: DataFrame) -> DataFrame:
    """(prefix, code): prefixes of three or five digits with the codes one digit longer that the reference (code) has; others as they are."""
    asked = spark.createDataFrame([(p,) for p in dict.fromkeys(prefixes)], "prefix string")
    longer = F.length("prefix").isin(3, 5)
    child = asked.filter(longer).join(reference.select("code").distinct(), F.col("code").startswith(F.col("prefix")) & (F.length("code") == F.length("prefix") + 1))
    return asked.filter(~longer).select("prefix", F.col("prefix").alias("code")).unionByName(child.select("prefix", "code"))


def area_params(area: Mapping[str, object]) -> dict[str, str]:
    """Request parameters for an area of ``parse_area``."""
    if area["level"] == "us":
        return {"for": "us:1"}
    out = {"for": f"{area['level']}:{','.join(area['codes'])}"}
    return out | ({"in": f"state:{area['within']}"} if area["within"] else {})


def request_grid(spark: SparkSession, codes: Sequence[str], areas: Sequence[str], year: int) -> DataFrame:
    """Every request for codes and areas, one row each; years from 2017 to 2023."""
    if not 2017 <= year <= 2023:
        raise SourceError("years from 2017 to 2023")
    places = [(a, json_params(area_params(parse_area(a)))) for a in areas]
    return spark.createDataFrame([(c,) for c in codes], "code string").crossJoin(spark.createDataFrame(places, "area string, params string")).withColumn("year", F.lit(year))


def json_params(params: Mapping[str, str]) -> str:
    import json

    return json.dumps(dict(params), sort_keys=True)


def load_overrides(spark: SparkSession, path: str, refs: DataFrame) -> tuple[DataFrame, int]:
    """(pairs (a, b, kind) of ids, number of unknown references) out of a YAML file with lists merge and split of pairs of references (``refs``: ref, id)."""
    import yaml

    tree = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    rows = [(str(p[0]), str(p[1]), kind) for kind in ("merge", "split") for p in tree.get(kind) or ()]
    asked = spark.createDataFrame(rows, "ra string, rb string, kind string")
    known = asked.join(refs.select(F.col("ref").alias("ra"), F.col("id").alias("a")), "ra", "left").join(refs.select(F.col("ref").alias("rb"), F.col("id").alias("b")), "rb", "left")
    unknown = known.agg(F.coalesce(F.sum(F.col("a").isNull().cast("int") + F.col("b").isNull().cast("int")), F.lit(0)).alias("n")).first().n
    return known.filter("a is not null and b is not null").select("a", "b", "kind"), unknown
