"""Tables that people read: the ranked export, its market sidecar, rows to label, things to review, and saved website results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import STATES
from ..functions.keys import label_key, naics_matches, search_key
from ..operators.market import concerns_area, concerns_sector
from ..operators.sample import interleaved, spread
from ..operators.score import ranked
from ..operators.upsert import latest, upsert
from .thesis import Thesis

# The columns of the files.
RANKED = [
    "rank", "score", "confidence", "excluded", "company", "domain", "city", "state", "naics", "employees", "employees_source", "facilities", "revenue_usd_m", "business_model", "product_lines", "end_markets",
    "founder_led", "family_owned", "pe_backed", "reason", "sources", "company_id", "scored_at", "thesis_name",
]
MARKET = ["naics", "naics_label", "year", "geo_level", "geo_code", "geo_name", "establishments", "employees", "annual_payroll_usd_k"]
TO_LABEL = ["company_name", "website", "state", "decision"]
REVIEW = ["kind", "reason", "name_similarity", "ref_a", "name_a", "domain_a", "state_a", "city_a", "ref_b", "name_b", "domain_b", "state_b", "city_b"]
CONFLICTS = ["label_key", "row_number", "company_name", "website", "state", "decision"]
MARKET_KEY = ["source", "year", "naics", "geo_level", "geo_code"]


def company_sources(assigned: DataFrame, raw: DataFrame) -> DataFrame:
    """(company_id, sources): the distinct sources of each company's raw records in order, parted by semicolons."""
    rows = assigned.select("company_id", F.col("raw_record_id").alias("id")).join(raw.select("id", "source"), "id")
    return rows.select("company_id", "source").distinct().groupBy("company_id").agg(F.array_join(F.array_sort(F.collect_list("source")), "; ").alias("sources"))


def ranked_export(scores: DataFrame, cities: DataFrame, sources: DataFrame, thesis: str, scored_at: Column) -> DataFrame:
    """The 24 columns of the ranked file as text and numbers, a row a scored company (``scores`` as score() gives them).

    ``cities`` holds (company_id, city), ``sources`` (company_id, sources).  What is unknown is null; whose website was
    not analyzed has "unknown" as its signals of ownership.  Excluded companies have no rank.
    """
    x = F.col("extraction")
    staff = F.coalesce(F.col("employee_count"), x["size_signals"]["employee_count"])
    origin = F.when(F.col("employee_count").isNotNull(), F.coalesce("employee_count_source", F.lit("records"))).when(staff.isNotNull(), "website")
    told = lambda f: F.coalesce(F.nullif(x["ownership"][f], F.lit("")), F.lit("unknown"))
    listed = lambda c: F.coalesce(F.array_join(F.filter(c, lambda v: v != ""), "; "), F.lit(""))
    rows = ranked(scores).join(cities, "company_id", "left").join(sources, "company_id", "left")
    return rows.select(
        "rank", F.col("total").alias("score"), "confidence", F.when(F.col("excluded"), "yes").otherwise("no").alias("excluded"), F.col("name").alias("company"), "domain", "city", "state", listed(F.col("naics_codes")).alias("naics"),
        staff.alias("employees"), origin.alias("employees_source"), x["size_signals"]["facility_count"].alias("facilities"), "revenue_usd_m", x["business_model"].alias("business_model"), listed(x["product_lines"]).alias("product_lines"),
        listed(x["end_markets"]).alias("end_markets"), told("founder_led").alias("founder_led"), told("family_owned").alias("family_owned"), told("pe_or_strategic_backed").alias("pe_backed"), "reason", "sources", "company_id",
        scored_at.alias("scored_at"), F.lit(thesis).alias("thesis_name"),
    )


def market_sidecar(stats: DataFrame, t: Thesis) -> DataFrame:
    """The statistics of the thesis's sectors for the country, its states and parts of them; in order of sector, year and place when written."""
    inside = concerns_sector(F.col("naics"), t.naics_prefixes) & concerns_area(F.col("geo_level"), F.lower("geo_name"), [STATES[s].lower() for s in t.states])
    return stats.filter(inside).select(*MARKET)


def stored_stats(stats: DataFrame, incoming: DataFrame) -> DataFrame:
    """Market statistics after taking in more: the last fetched row of each key counts; size classes are kept as JSON with sorted keys."""
    flat = incoming.withColumn("size_classes_json", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("size_classes"))))).drop("size_classes")
    return latest(stats.unionByName(flat.select(*stats.columns)), MARKET_KEY, [F.col("fetched_at"), F.col("establishments")])


def label_eligibility(companies: DataFrame, t: Thesis, labelled: DataFrame) -> DataFrame:
    """(company_id, name, domain, state, what) of the companies (id, name, domain, state, country, naics_codes) in the thesis's states.

    what: the first rule that keeps a company from being labelled (no_website, naics_unknown, naics_outside, labelled), or
    eligible.  ``labelled`` holds the keys (key) that have a label.
    """
    inside = companies.filter(F.col("state").isin(*t.states) & (F.col("country").isNull() | (F.col("country") == "US")))
    keyed = inside.withColumn("__key", label_key(F.col("name"), F.col("domain"), F.col("state")))
    known = labelled.select(F.col("key").alias("__key")).filter("__key is not null").distinct().withColumn("__known", F.lit(True))
    what = (
        F.when(F.coalesce(F.col("domain"), F.lit("")) == "", "no_website").when(F.coalesce(F.size("naics_codes"), F.lit(0)) <= 0, "naics_unknown")
        .when(~naics_matches(F.col("naics_codes"), t.naics_prefixes), "naics_outside").when(F.col("__known"), "labelled").otherwise("eligible")
    )
    return keyed.join(known, "__key", "left").select(F.col("id").alias("company_id"), "name", "domain", "state", what.alias("what"))


def to_label(eligibility: DataFrame, n: int, seed: int, most: int | None = None) -> DataFrame:
    """The rows of the file to label: n eligible companies spread over the states, with an empty decision."""
    picked = spread(eligibility.filter("what = 'eligible'"), "company_id", "state", n, seed, most)
    return picked.select("company_id", F.col("name").alias("company_name"), F.col("domain").alias("website"), "state", F.lit("").alias("decision"))


def label_conflicts(labels: DataFrame) -> DataFrame:
    """All rows (key, row_number, company_name, website, state, decision) of the keys whose labels disagree."""
    torn = labels.filter("key is not null and decision is not null").groupBy("key").agg(F.count_distinct("decision").alias("n")).filter("n > 1").select("key")
    return labels.filter("decision is not null").join(torn, "key", "left_semi").select(F.col("key").alias("label_key"), *CONFLICTS[1:])


def review_table(review: DataFrame, records: DataFrame) -> DataFrame:
    """The 13 columns of the review file: pairs (kind, a, b, score, reason) with both records (id, ref, name, domain, state, city)."""
    side = lambda n: records.select(F.col("id").alias(n), *[F.col(c).alias(f"{c}_{n}") for c in ("ref", "name", "domain", "state", "city")])
    return review.join(side("a"), "a").join(side("b"), "b").withColumn("name_similarity", F.round("score", 1)).select(*REVIEW)


def finder_targets(companies: DataFrame, ueis: DataFrame, seed: int, t: Thesis | None = None) -> DataFrame:
    """(company_id, search_key, name, city, state, uei, position) of companies without a website whose state is known.

    With a thesis, those in its states and sectors.  In order of ``position`` any stretch has the states in proportion.
    """
    open_ = companies.filter(F.col("domain").isNull() & F.col("state").isNotNull() & (F.col("country").isNull() | (F.col("country") == "US")))
    if t is not None:
        open_ = open_.filter(F.col("state").isin(*t.states) & naics_matches(F.col("naics_codes"), t.naics_prefixes))
    rows = open_.select(F.col("id").alias("company_id"), "name", "city", "state").join(ueis.select("company_id", "uei"), "company_id", "left")
    keyed = rows.withColumn("search_key", search_key(F.col("uei"), F.col("name"), F.col("state")))
    return interleaved(keyed, "company_id", "state", seed).select("company_id", "search_key", "name", "city", "state", "uei", "position")


def saved_results(kept: DataFrame, results: DataFrame) -> DataFrame:
    """Website results (search_key, company_id, status, domain, confidence, finished_at) after taking in others: the last of each search counts."""
    return upsert(kept, latest(results, ["search_key"], [F.col("finished_at"), F.col("company_id")]), ["search_key"], "finished_at").drop("change")


def website_records(raw: DataFrame, results: DataFrame, targets: DataFrame) -> DataFrame:
    """Raw records (source, source_record_id, payload_json, payload_hash, ingested_at) after the results of searches.

    A found website becomes the record of source "websites" under its search key; a search that found none takes that
    record away.  Records of other sources and searches stay.
    """
    shape = ["source", "source_record_id", "payload_json", "payload_hash", "ingested_at"]
    last = latest(results, ["search_key"], [F.col("finished_at"), F.col("company_id")])
    gone = last.select(F.col("search_key").alias("source_record_id")).withColumn("source", F.lit("websites"))
    kept = raw.select(*shape).join(gone, ["source", "source_record_id"], "left_anti")
    text = lambda n: F.lit(None).cast("string").alias(n)
    extra = F.struct("uei", F.col("confidence").alias("website_confidence"), F.lit("guess_and_verify").alias("website_method"))
    payload = F.to_json(F.struct("city", F.lit("US").alias("country"), text("description"), text("employees"), extra.alias("extra"), text("naics"), "name", text("revenue_usd_m"), "state", F.col("domain").alias("website")), {"ignoreNullFields": "false"})
    found = last.filter("status = 'found'").join(targets.select("search_key", "name", "city", "state", "uei").dropDuplicates(["search_key"]), "search_key")
    new = found.select(F.lit("websites").alias("source"), F.col("search_key").alias("source_record_id"), payload.alias("payload_json"), F.col("finished_at").alias("ingested_at")).withColumn("payload_hash", F.sha2("payload_json", 256))
    return kept.unionByName(new.select(*shape))


def recheck_targets(results: DataFrame, raw: DataFrame, companies: DataFrame) -> DataFrame:
    """(search_key, company_id, status, name, city, state, uei) of found and ambiguous searches: by their own record, else by their company."""
    get = lambda p: F.get_json_object("payload_json", f"$.{p}")
    own = raw.filter("source = 'websites'").select(F.col("source_record_id").alias("search_key"), F.struct(get("name").alias("name"), get("city").alias("city"), get("state").alias("state"), get("extra.uei").alias("uei")).alias("x"))
    firm = companies.select(F.col("id").alias("company_id"), F.col("name").alias("c_name"), F.col("city").alias("c_city"), F.col("state").alias("c_state"))
    rows = results.filter("status in ('found', 'ambiguous')").join(own, "search_key", "left").join(firm, "company_id", "left")
    mine = F.col("x").isNotNull()
    pick = lambda n: F.when(mine, F.col(f"x.{n}")).otherwise(F.col(f"c_{n}")).alias(n)
    uei = F.when(mine, F.col("x.uei")).when(F.col("search_key").startswith("uei:"), F.expr("substring(search_key, 5)"))
    return rows.filter(mine | (F.col("c_name").isNotNull() & F.col("c_state").isNotNull())).select("search_key", "company_id", "status", pick("name"), pick("city"), pick("state"), uei.alias("uei"))


def tokens_a_company(calls: DataFrame) -> DataFrame:
    """(tokens, companies, tokens_per_company) of model calls (company_id, tokens_in, tokens_out); calls of no company count for one."""
    sums = calls.agg(F.coalesce(F.sum(F.coalesce("tokens_in", F.lit(0)) + F.coalesce("tokens_out", F.lit(0))), F.lit(0)).alias("tokens"), F.count_distinct("company_id").alias("companies"))
    return sums.withColumn("tokens_per_company", F.col("tokens") / F.greatest("companies", F.lit(1)))
