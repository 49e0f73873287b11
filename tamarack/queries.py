"""The named queries of the general operators, over whole tables, and the SQL that says the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geo, keys, persons, text, times, values, web
from .functions.grounding import grounded, invalid, normalised, quoted
from .functions.pages import best_links, page_links, read_page, site_names
from .operators import cached, canon, cluster, evaluate, market, match, sample, score, upsert
from .oracle import ORACLE
from .plans import evaluation, reports
from .plans.enrich import load_facts
from .plans.resolve import load_records, resolve, resolve_stats
from .plans.thesis import Range, Thesis
from .session import ensure_checkpoint_dir, few_rows, settle
from .sources import files
from .streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

THESIS = Thesis(
    name="makers", naics_prefixes=("332", "333", "3261"), states=("GA", "NC", "SC", "TN"), keywords=("castings", "precision", "machining"), end_markets=("aerospace", "medical device"),
    employees=Range(20, 250), revenue_usd_m=Range(2, 40), prefer=("family_owned",), exclude_keywords=("laminates", "cabinetry"), exclude_domains=(), countries=("US",),
)


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def hosts(spark: SparkSession, folder: str) -> list[str]:
    return sorted(r.host for r in few_rows(table(spark, folder, "platform_hosts").select("host")))


# ---- keys and normalisation ---------------------------------------------------------------------------------------------


@query
def name_key_companies(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "companies")
    name = F.col("canonical_name")
    return c.select("id", keys.name_key(name).alias("name_key"), F.array_join(keys.word_keys(name), " ").alias("word_keys"), F.array_join(keys.distinctive_tokens(name), " ").alias("distinctive"))


@query
def guessed_domains(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "companies")
    return c.select("id", F.array_join(keys.candidate_domains(F.col("canonical_name")), " ").alias("guesses"), F.array_join(keys.entity_words(F.col("canonical_name")), " ").alias("entity_words"))


@query
def own_domain_raw(spark: SparkSession, folder: str) -> DataFrame:
    r = table(spark, folder, "raw_records")
    site = values.payload_field(F.col("payload_json"), "website")
    return r.select("id", web.own_domain(site, hosts(spark, folder)).alias("domain"))


@query
def state_city_country(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "companies")
    return c.select("id", geo.state_code_or_text(F.col("state")).alias("state"), geo.city_plain(F.col("city")).alias("city"), geo.country_code(F.col("country")).alias("country"))


@query
def label_keys(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "label_rows")
    return rows.select("row_number", keys.label_key(F.col("company_name"), web.own_domain(F.col("website"), hosts(spark, folder)), geo.state_code_or_text(F.col("state"))).alias("label_key"))


@query
def search_keys(spark: SparkSession, folder: str) -> DataFrame:
    m = table(spark, folder, "match_records")
    return m.select("id", keys.search_key(F.nullif(F.trim("uei"), F.lit("")), F.col("name"), F.col("state")).alias("search_key"))


@query
def row_hashes(spark: SparkSession, folder: str) -> DataFrame:
    m = table(spark, folder, "match_records")
    return m.select("id", keys.row_hash({c: F.col(c) for c in ("name", "domain", "state", "city")}).alias("row_hash"))


@query
def typed_numbers(spark: SparkSession, folder: str) -> DataFrame:
    r = table(spark, folder, "raw_records")
    staff = values.payload_field(F.col("payload_json"), "employees")
    return r.select("id", keys.typed_int(staff).alias("typed_int"), values.head_count(staff).alias("head_count"), keys.typed_revenue(values.payload_field(F.col("payload_json"), "revenue_usd_m")).alias("revenue"))


@query
def naics_flags(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "companies")
    joined = F.array_join("naics_codes", "~")
    return c.select("id", F.explode(keys.naics_codes_of(joined)).alias("x")).select("id", "x.code", F.coalesce("x.flag", F.lit("")).alias("flag"))


# ---- scoring ------------------------------------------------------------------------------------------------------------


def facts(spark: SparkSession, folder: str) -> DataFrame:
    """Companies with what their pages say: products and markets named in their documents, and who owns them."""
    c = table(spark, folder, "companies")
    d = table(spark, folder, "documents").filter("company_id is not null and text is not null")
    low = F.lower("text")
    says = d.groupBy("company_id").agg(*[F.max(low.contains(w).cast("int")).alias(f"m{i}") for i, w in enumerate(THESIS.end_markets)], F.max(low.contains("family still owns").cast("int")).alias("family"))
    markets = F.filter(F.array(*[F.when(F.col(f"m{i}") == 1, w) for i, w in enumerate(THESIS.end_markets)]), lambda x: x.isNotNull())
    null = "cast(null as {0}) as {1}".format
    extraction = F.when(F.col("family").isNotNull(), F.struct(
        F.lit(None).cast("string").alias("summary"), F.array().cast("array<string>").alias("product_lines"), markets.alias("end_markets"), F.lit(None).cast("string").alias("business_model"),
        F.struct(*[F.expr(null("bigint", n)) if n != "employee_count_quote" else F.expr(null("string", n)) for n in ("employee_count", "employee_count_quote", "facility_count", "facility_sqft_total", "founded_year")]).alias("size_signals"),
        F.struct(F.expr(null("string", "founder_led")), F.when(F.col("family") == 1, "yes").otherwise("unknown").alias("family_owned"), F.expr(null("bigint", "generation")), F.expr(null("string", "pe_or_strategic_backed")), F.expr(null("string", "publicly_traded"))).alias("ownership"),
        F.array().cast("array<struct<claim:string,page:string,quote:string>>").alias("evidence"),
    ))
    joined = c.join(says, c.id == says.company_id, "left")
    return joined.select(F.col("id").alias("company_id"), F.coalesce("canonical_name", F.lit("")).alias("name"), F.lower("domain").alias("domain"), geo.state_code_or_text(F.col("state")).alias("state"), geo.country_code(F.col("country")).alias("country"),
                         "naics_codes", "employee_count", "employee_count_source", "revenue_usd_m", F.when(F.col("family").isNotNull(), "ok").alias("enrichment_status"), extraction.alias("extraction"))


@query
def thesis_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Companies ranked against the thesis, with the components, confidence and exclusion of each."""
    out = score.ranked(score.score(facts(spark, folder), THESIS))
    return out.select("company_id", "rank", "total", "sector", "size", "geography", "ownership", "confidence", "excluded", "exclusion_rule")


@query
def thesis_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """The written reason of each company's score (rows only)."""
    return score.score(facts(spark, folder), THESIS).select("company_id", "total", "reason", F.array_join("evidenced", ",").alias("evidenced"))


@query
def score_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return score.summary(score.score(facts(spark, folder), THESIS), THESIS.threshold)


@query
def naics_in_thesis(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "companies")
    return c.select("id", keys.naics_matches(F.col("naics_codes"), THESIS.naics_prefixes).alias("in_thesis"))


# ---- matching -----------------------------------------------------------------------------------------------------------


def match_input(spark: SparkSession, folder: str) -> DataFrame:
    m = table(spark, folder, "match_records")
    return m.select("id", F.coalesce(keys.name_key(F.col("name")), F.lit("")).alias("key"), web.own_domain(F.col("domain"), hosts(spark, folder)).alias("domain"), geo.state_code_or_text(F.col("state")).alias("state"),
                    geo.city_plain(F.col("city")).alias("city"), geo.country_code(F.col("country")).alias("country"), F.nullif(F.trim("uei"), F.lit("")).alias("uei"))


@query
def block_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return match.candidate_pairs(settle(match_input(spark, folder)))[0]


@query
def block_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return match.block_keys(match_input(spark, folder)).groupBy("kind", "block").agg(F.count("*").alias("records"))


@query
def match_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """Decision, method and reason of every blocked pair (rows only: the similarity is tested by brute force)."""
    records = settle(match_input(spark, folder))
    return match.decide(match.candidate_pairs(records)[0], records)


@query
def resolved_companies(spark: SparkSession, folder: str) -> DataFrame:
    """The whole way from raw records to companies that keep their former ids (rows only)."""
    raw = table(spark, folder, "raw_records")
    former = table(spark, folder, "company_records").select(F.col("raw_record_id").alias("id"), "company_id")
    out = resolve(raw, hosts(spark, folder), table(spark, folder, "source_priority"), former)
    return out.companies.withColumn("naics_codes", F.array_join("naics_codes", ","))


@query
def review_queue(spark: SparkSession, folder: str) -> DataFrame:
    """What of the matching of match_records is to be looked at (rows only)."""
    records = settle(match_input(spark, folder))
    decisions = settle(match.decide(match.candidate_pairs(records, least=match.MAYBE)[0], records))
    assignments, links = cluster.cluster(records, decisions)
    return cluster.review_pairs(decisions, settle(links), settle(assignments))


def _assigned(spark: SparkSession, folder: str) -> DataFrame:
    records = load_records(table(spark, folder, "raw_records"), hosts(spark, folder))
    held = table(spark, folder, "company_records").select(F.col("raw_record_id").alias("id"), "company_id")
    order = table(spark, folder, "source_priority").select(values.source_label(F.col("source")).alias("source"), "priority")
    return records.join(held, "id").join(order, "source", "left")


@query
def canonical_records(spark: SparkSession, folder: str) -> DataFrame:
    out = canon.canonical_record(_assigned(spark, folder), "company_id", F.col("priority"))
    return out.withColumn("naics_codes", F.array_join("naics_codes", ","))


def _decided(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """pair_decisions as decisions, its merges as links, and the clusters that company_records gives."""
    said = table(spark, folder, "pair_decisions").filter("a <> b").withColumn("decision", F.lower(F.trim("decision"))).withColumn("strength", match.strength("method", "score"))
    links = said.filter("decision = 'merge'").select("a", "b", "method", "score", "reason", "strength", F.lit(None).cast("string").alias("refused"))
    held = table(spark, folder, "company_records").select(F.col("raw_record_id").alias("id"), F.col("company_id").alias("cluster"))
    return said, links, held


@query
def best_evidence(spark: SparkSession, folder: str) -> DataFrame:
    """The strongest merge decision that touches each assigned record, and how many do."""
    _, links, held = _decided(spark, folder)
    return cluster.evidence(held, links).select("id", "cluster", "match_method", "match_score", F.coalesce(F.nullif(F.size("links"), F.lit(-1)), F.lit(0)).alias("links"))


@query
def review_between_companies(spark: SparkSession, folder: str) -> DataFrame:
    """What of pair_decisions is to be looked at, by the companies that records were assigned to."""
    said, links, held = _decided(spark, folder)
    return cluster.review_pairs(said, links, held).distinct()


@query
def review_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The review file's 13 columns of review_between_companies."""
    get = lambda f: values.payload_field(F.col("payload_json"), f).alias(f)
    raw = table(spark, folder, "raw_records").select("id", F.col("source_record_id").alias("ref"), get("name"), get("website"), get("state"), get("city")).withColumnRenamed("website", "domain")
    return reports.review_table(review_between_companies(spark, folder), raw)


# ---- joins, aggregates and windows --------------------------------------------------------------------------------------


@query
def delivery_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "raw_records")
    return upsert.delivery_changes(rows, ["source", "source_record_id"], "payload_hash", ["ingested_at", "id"]).groupBy("source", "change").agg(F.count("*").alias("records"))


@query
def latest_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "raw_records")
    return upsert.latest(rows, ["source", "source_record_id"], [F.col("ingested_at"), F.col("id")]).select("id", "source", "source_record_id", "payload_hash")


@query
def snapshot_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """What taking in the second half of the deliveries did to the table of the first half."""
    rows = table(spark, folder, "raw_records").select("source", "source_record_id", "id", "ingested_at", "payload_hash")
    cut = F.expr("timestamp '2025-08-01'")
    last = lambda r: upsert.latest(r, ["source", "source_record_id"], [F.col("ingested_at"), F.col("id")])
    merged = upsert.upsert(last(rows.filter(F.col("ingested_at") < cut)), last(rows.filter(F.col("ingested_at") >= cut)), ["source", "source_record_id"], "payload_hash")
    return merged.groupBy("source", "change").agg(F.count("*").alias("records"), F.max("id").alias("last_id"))


@query
def company_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Companies with or without documents: how many, and the longest."""
    c, d = table(spark, folder, "companies"), table(spark, folder, "documents")
    per = d.filter("company_id is not null").groupBy("company_id").agg(F.count("*").alias("documents"), F.max("n_chars").alias("longest"))
    return c.join(per, c.id == per.company_id, "left").select("id", F.coalesce("documents", F.lit(0)).alias("documents"), "longest")


@query
def company_sources(spark: SparkSession, folder: str) -> DataFrame:
    per = reports.company_sources(table(spark, folder, "company_records"), table(spark, folder, "raw_records"))
    return table(spark, folder, "companies").select(F.col("id").alias("company_id")).join(per, "company_id", "left")


@query
def company_uei(spark: SparkSession, folder: str) -> DataFrame:
    held, raw = table(spark, folder, "company_records"), table(spark, folder, "raw_records")
    uei = F.get_json_object("payload_json", "$.extra.uei")
    return held.join(raw, held.raw_record_id == raw.id).filter(uei.isNotNull()).groupBy("company_id").agg(F.min_by(uei, "raw_record_id").alias("uei"))


@query
def unlabelled_companies(spark: SparkSession, folder: str) -> DataFrame:
    """Companies whose domain and whose name with state no label has."""
    c = table(spark, folder, "companies").select("id", web.own_domain(F.col("domain"), hosts(spark, folder)).alias("domain"), keys.name_key(F.col("canonical_name")).alias("key"), geo.state_code_or_text(F.col("state")).alias("state"))
    rows = table(spark, folder, "label_rows")
    sites = rows.select(web.own_domain(F.col("website"), hosts(spark, folder)).alias("domain")).filter("domain is not null").distinct()
    names = rows.select(keys.name_key(F.col("company_name")).alias("key"), geo.state_code_or_text(F.col("state")).alias("state")).filter("key is not null and state is not null").distinct()
    return c.join(sites, "domain", "left_anti").join(names, ["key", "state"], "left_anti").select("id")


@query
def labelled_in_states(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "companies").select("id", geo.state_code_or_text(F.col("state")).alias("state"))
    states = spark.createDataFrame([(s,) for s in THESIS.states], "state string")
    return c.join(F.broadcast(states), "state", "left_semi")


@query
def latest_run(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    return e.groupBy("event_type").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"), F.max("ts").alias("ts"))


@query
def status_counts(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "pair_decisions")
    said = F.lower(F.trim("decision"))
    return p.groupBy("method").agg(F.count("*").alias("pairs"), F.sum((said == "merge").cast("bigint")).alias("merges"), F.sum((said == "review").cast("bigint")).alias("reviews"), F.count_distinct("a").alias("records"), F.sum(F.when(F.col("score") >= 93, 1).otherwise(0)).alias("similar"))


@query
def latency_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    return upsert.nearest_rank(e, ["event_type"], "value", {"p95": 0.95}, median="p50")


@query
def timing_summary(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    return e.groupBy("event_type").agg(F.percentile("value", F.lit(0.5)).alias("median_value"), F.max("value").alias("max_value"), F.count("*").alias("events"))


@query
def daily_requests(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    return e.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("requests"))


@query
def json_values(spark: SparkSession, folder: str) -> DataFrame:
    r = table(spark, folder, "raw_records")
    batch = F.get_json_object("payload_json", "$.extra.batch")
    return r.groupBy("source").agg(F.count(batch).alias("with_batch"), F.count_distinct(batch).alias("batches"), F.max(F.get_json_object("payload_json", "$.revenue_usd_m").try_cast("double")).alias("max_revenue"))


@query
def label_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Labels by key: how many, and whether they agree."""
    said = F.lower(F.trim("decision"))
    means = F.when(said.isin(*files.LABELS["pursue"]), "pursue").when(said.isin(*files.LABELS["pass"]), "pass")
    rows = table(spark, folder, "label_rows").withColumn("d", means).filter("d is not null and key is not null")
    return rows.groupBy("key").agg(F.count("*").alias("labels"), (F.count_distinct("d") == 1).alias("agree"), F.min("d").alias("first_decision"))


@query
def split_contingency(spark: SparkSession, folder: str) -> DataFrame:
    split = sample.stratified_split(_labels(spark, folder), "key", ["decision"], 0.3, 7)
    return split.rollup("split").agg(F.sum((F.col("decision") == "pursue").cast("bigint")).alias("pursue"), F.sum((F.col("decision") == "pass").cast("bigint")).alias("pass"), F.count("*").alias("labels"))


# ---- evaluation ---------------------------------------------------------------------------------------------------------


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    """(key, decision) of the keys whose labels agree."""
    return label_groups(spark, folder).filter("agree").select("key", F.col("first_decision").alias("decision"))


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Scored companies with a label, by domain or by name and state: (id, score, positive, excluded)."""
    return evaluation.matched_items(_report(spark, folder)).drop("exclusion_rule")


@query
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.confusion(items(spark, folder), 40.0)


@query
def precision_interval(spark: SparkSession, folder: str) -> DataFrame:
    c = evaluate.confusion(items(spark, folder), 40.0)
    w = evaluate.wilson(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))
    return c.select("tp", "fp", w.alias("w")).select("tp", "fp", F.col("w.low").alias("low"), F.col("w.high").alias("high"))


@query
def average_precision(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.average_precision(items(spark, folder))


@query
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.roc_auc(items(spark, folder))


@query
def precision_at_k(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.precision_at(items(spark, folder))


@query
def bootstrap_interval(spark: SparkSession, folder: str) -> DataFrame:
    """Percentile bounds of 2,000 stratified resamples (rows only: tested against a plain version)."""
    return evaluate.bootstrap(settle(items(spark, folder)), 11)


@query
def label_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Labels matched to companies by domain, or by the one most similar name of their state (rows only)."""
    at = hosts(spark, folder)
    labels = table(spark, folder, "label_rows").select(F.col("row_number").alias("label"), web.own_domain(F.col("website"), at).alias("domain"), keys.name_key(F.col("company_name")).alias("key"), geo.state_code(F.col("state")).alias("state"))
    companies = table(spark, folder, "companies").select(F.col("id").alias("company_id"), web.own_domain(F.col("domain"), at).alias("domain"), keys.name_key(F.col("canonical_name")).alias("key"), geo.state_code(F.col("state")).alias("state"))
    return evaluate.match_labels(labels, companies, match.name_similarity)


# ---- samples ------------------------------------------------------------------------------------------------------------


@query
def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    return sample.stratified_split(_labels(spark, folder), "key", ["decision"], 0.3, 7)


@query
def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    return sample.hash_split(table(spark, folder, "customer").select("c_custkey"), "c_custkey", 0.3, 7)


@query
def spread_sample(spark: SparkSession, folder: str) -> DataFrame:
    """120 companies spread over the states: a sampling operator."""
    c = table(spark, folder, "companies").select("id", geo.state_code_or_text(F.col("state")).alias("state")).filter("state is not null")
    return sample.spread(c, "id", "state", 120, 3, most=5).select("id", "state", "turn")


@query
def sample_order(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "companies").select("id", geo.state_code_or_text(F.col("state")).alias("state")).filter("state is not null")
    return sample.interleaved(c, "id", "state", 3)


@query
def hand_check_sample(spark: SparkSession, folder: str) -> DataFrame:
    """50 match records in the seeded order: a sampling operator."""
    return sample.take(table(spark, folder, "match_records").select("id", "ref"), "id", 50, 5)


# ---- market statistics --------------------------------------------------------------------------------------------------


@query
def size_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Line items by ship mode of quantity: totals and a map of classes, written as text."""
    li = table(spark, folder, "lineitem")
    code = F.when(F.col("l_quantity") < 10, "210").when(F.col("l_quantity") < 30, "220").otherwise("230")
    each = li.groupBy("l_returnflag", "l_linestatus", code.alias("code")).agg(F.count("*").alias("n"))
    total = li.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n")).withColumn("code", F.lit("001"))
    rows = each.unionByName(total).withColumn("label", F.concat(F.lit("class "), "code"))
    out = market.pivot_classes(rows, ["l_returnflag", "l_linestatus"], "code", "label", "n")
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("classes")), lambda e: F.concat(e["key"], F.lit("="), e["value"]["n"].cast("string"))), ",")
    return out.select("l_returnflag", "l_linestatus", "total", shown.alias("classes"))


@query
def market_sectors(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "companies").select("id", F.explode("naics_codes").alias("code")).filter("code rlike '^[0-9]{2,6}$' and code not rlike '^0+$'")
    return c.filter(market.concerns_sector(F.col("code"), ["332", "33320", "3110"])).groupBy("code").agg(F.count("*").alias("companies"))


@query
def market_areas(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = d.select("n_nationkey", F.when(F.col("n_nationkey") % 5 == 0, "us").otherwise("county").alias("level"), F.concat("n_name", F.lit(", "), "r_name").alias("name"))
    return rows.filter(market.concerns_area(F.col("level"), F.col("name"), ["ASIA", "EUROPE"])).select("n_nationkey", "level", "name")


@query
def recipient_rollup(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").select("o_custkey", F.col("o_totalprice").alias("amount"), F.substring("o_orderpriority", 1, 1).alias("prefix"), "o_orderkey")
    out = market.recipients(o.filter("o_custkey is not null"), "o_custkey", "amount", "prefix", "o_orderkey")
    return out.select("o_custkey", F.round("total_amount", 2).alias("total_amount"), F.array_join("prefixes", ",").alias("prefixes"))


@query
def reject_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Why raw records would be left out, by the first rule they break."""
    r = table(spark, folder, "raw_records")
    get = lambda f: values.payload_field(F.col("payload_json"), f)
    reason = (
        F.when(values.real_text(get("name")).isNull(), "unnamed").when(geo.country_code(get("country")).isNotNull() & (geo.country_code(get("country")) != "US"), "abroad")
        .when(~geo.state_code_or_text(get("state")).isin(*THESIS.states) | geo.state_code_or_text(get("state")).isNull(), "place").when(~F.coalesce(get("naics").rlike("^(332|333|3261)"), F.lit(False)), "sector").otherwise("kept")
    )
    return r.select(reason.alias("reject_reason")).groupBy("reject_reason").agg(F.count("*").alias("records"))


# ---- texts --------------------------------------------------------------------------------------------------------------


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").filter("text is not null")


@query
def scrubbed_contacts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without mail addresses and telephone numbers (rows only: RE2 has no lookbehind)."""
    return _docs(spark, folder).select("doc_id", text.scrub_contacts(F.col("text")).alias("text"))


@query
def scrubbed_mail(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", F.sha2(F.regexp_replace("text", text.MAIL, F.lit(text.REMOVED)), 256).alias("digest"))


@query
def phrase_hits(spark: SparkSession, folder: str) -> DataFrame:
    low = F.lower("text")
    return _docs(spark, folder).select("doc_id", *[text.phrase_in(p, low).alias(p.replace(" ", "_")) for p in ("medical device", "aerospace", "heat exchanger", "family")])


@query
def document_numbers(spark: SparkSession, folder: str) -> DataFrame:
    n = text.numbers_in(F.col("text"))
    return _docs(spark, folder).select("doc_id", F.size(n).alias("numbers"), F.array_max(n).alias("largest"))


@query
def distinct_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's distinct lines, as a digest."""
    return _docs(spark, folder).select("doc_id", F.sha2(text.distinct_lines(F.col("text")), 256).alias("lines"))


@query
def first_sentence_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """The first two sentences of every document (rows only)."""
    return _docs(spark, folder).select("doc_id", text.first_sentences(F.col("text")).alias("opening"))


@query
def clean_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Languages by company as a cleaned list; sources and domains are not listed."""
    d = table(spark, folder, "documents").filter("company_id is not null")
    per = d.groupBy("company_id").agg(F.array_sort(F.collect_list(F.coalesce("lang", F.lit("n/a")))).alias("x"))
    return per.select("company_id", F.array_join(text.clean_list(F.col("x")), "|").alias("langs"))


@query
def quote_snippets(spark: SparkSession, folder: str) -> DataFrame:
    """What stands around the first mention of a workforce (rows only)."""
    d = _docs(spark, folder).filter(F.col("text").contains("employees"))
    return d.select("doc_id", text.snippet(text.scrub_contacts(F.col("text")), "employees").alias("snippet"))


@query
def company_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One document a company out of its pages, within a budget of characters (rows only)."""
    pages = _docs(spark, folder).filter("company_id is not null").groupBy("company_id").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("page_path", F.lit("/")).alias("path"), F.col("text").alias("body")))).alias("pages"))
    return pages.select("company_id", text.build_document(F.col("pages"), 24_000, 8_000).alias("document"))


@query
def cache_keys(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents").filter("domain is not null")
    url = F.concat(F.lit("https://"), F.lower("domain"), F.coalesce("page_path", F.lit("/")))
    params = F.create_map(F.lit("page"), F.col("doc_id").cast("string"), F.lit("api_key"), F.lit("x"), F.lit("lang"), F.coalesce("lang", F.lit("-")))
    return d.select("doc_id", F.sha2(text.cache_url(url, params), 256).alias("cache_key"))


@query
def header_parts(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    kind = F.concat(F.lit("text/html; Charset=\"ISO-"), (F.col("event_id") % 9).cast("string"), F.lit("\""))
    name = F.concat(F.lit("attachment; filename=\"extract "), F.col("event_id").cast("string"), F.lit(".zip\"; size=1"))
    wait = F.when(F.col("event_id") % 3 == 0, "soon").otherwise((F.col("event_id") % 100).cast("string"))
    return e.select("event_id", text.header_charset(kind).alias("charset"), text.header_filename(name).alias("filename"), text.header_retry_after(wait).alias("retry_after"))


@query
def masked_persons(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with names of persons masked (rows only)."""
    d = _docs(spark, folder)
    return d.select("doc_id", persons.masked(F.col("text"), F.coalesce("domain", F.lit("")), F.lit("")).alias("text"))


@query
def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Visible text of documents read as pages (rows only)."""
    page = F.concat(F.lit("<html><head><title>"), F.coalesce("domain", F.lit("")), F.lit(" | site</title></head><body>"), "text", F.lit("</body></html>"))
    return _docs(spark, folder).select("doc_id", read_page(page).alias("p")).select("doc_id", "p.title", F.length("p.text").alias("chars"), F.array_join(site_names(F.col("p.title"), F.col("p.site_name")), "; ").alias("site_names"))


@query
def page_link_choice(spark: SparkSession, folder: str) -> DataFrame:
    """Links worth reading of pages that link to every path of their domain (rows only)."""
    d = table(spark, folder, "documents").filter("domain is not null and page_path is not null")
    per = d.groupBy("domain").agg(F.array_join(F.transform(F.array_sort(F.collect_set("page_path")), lambda p: F.concat(F.lit('<a href="'), p, F.lit('">page</a>'))), " ").alias("page"))
    links = page_links(F.col("page"), F.concat(F.lit("https://"), F.col("domain"), F.lit("/")))
    return per.select("domain", F.array_join(best_links(links, 5), " ").alias("links"))


def _extractions(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text, x): an extraction made of each document, with quotes that stand in it and such that don't."""
    d = _docs(spark, folder)
    line = F.regexp_extract("text", "^\\s*([^\\n]*)", 1)
    mine = F.when(F.col("doc_id") % 2 == 0, F.lower(line)).otherwise(F.concat(line, F.lit(" zz")))
    raw = F.struct(
        F.col("text").alias("summary"), F.array(F.lit("castings "), F.lit("Castings"), F.lit("n/a")).alias("product_lines"), F.array(F.lit("aerospace")).alias("end_markets"), F.lit("maker").alias("business_model"),
        F.struct((F.col("doc_id") % 300).alias("employee_count"), F.regexp_extract("text", "[^.]*employees[^.]*", 0).alias("employee_count_quote"), F.lit(2).cast("bigint").alias("facility_count"), F.lit(5).cast("bigint").alias("facility_sqft_total"), (1650 + F.col("doc_id") % 370).alias("founded_year")).alias("size_signals"),
        F.struct(F.lit("yes").alias("founder_led"), F.lit("maybe").alias("family_owned"), (F.col("doc_id") % 12).alias("generation"), F.lit("no").alias("pe_or_strategic_backed"), F.lit("unknown").alias("publicly_traded")).alias("ownership"),
        F.array(F.struct(F.lit("founded_year").alias("claim"), F.lit("/").alias("page"), mine.alias("quote")), F.struct(F.lit("x").alias("claim"), F.lit("/").alias("page"), F.lit("not there at all").alias("quote"))).alias("evidence"),
    )
    return settle(d.select("doc_id", "text", raw.alias("x"))).withColumn("x", normalised(F.col("x")))


@query
def grounded_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """How many pieces of each extraction's evidence have a quote, and how many of the quotes stand in the document."""
    rows = _extractions(spark, folder)
    return rows.select("doc_id", F.size("x.evidence").alias("quotes"), F.size(quoted(F.col("x.evidence"), F.col("text"))).alias("quoted"))


@query
def grounded_extractions(spark: SparkSession, folder: str) -> DataFrame:
    """Extractions made of documents, cleaned, grounded and checked."""
    rows = _extractions(spark, folder)
    out, dropped = grounded(F.col("x"), F.col("text"))
    return rows.select("doc_id", F.size(out["evidence"]).alias("evidence"), out["size_signals"]["founded_year"].alias("founded_year"), F.array_contains(dropped, "facility_sqft_total").alias("floor_dropped"), F.array_join(invalid(F.col("x")), ",").alias("invalid"))


@query
def fiscal_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Fiscal year (from 1 October) of each order, and the first Sunday of its month."""
    o = table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return o.select("o_orderkey", times.fiscal_year(F.col("d")).alias("fiscal_year"), times.first_sunday(F.col("d")).alias("first_sunday"))


@query
def number_formats(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "part")
    return p.select("p_partkey", F.format_number(F.col("p_partkey") * 1000, 0).alias("grouped"), text.general_number(F.col("p_size").cast("double")).alias("general"), text.ordinal(F.col("p_size")).alias("ordinal"))


# ---- files for people ---------------------------------------------------------------------------------------------------


@query
def ranked_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The ranked export's columns, but for the written reason."""
    c = table(spark, folder, "companies")
    sources = reports.company_sources(table(spark, folder, "company_records"), table(spark, folder, "raw_records"))
    out = reports.ranked_export(score.score(facts(spark, folder), THESIS), c.select(F.col("id").alias("company_id"), "city"), sources, THESIS.name, F.lit("2026-01-01T00:00:00Z"))
    return out.drop("reason")


@query
def market_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The market sidecar of statistics by sector and state that are counted from the companies themselves."""
    names = F.create_map(*[F.lit(x) for kv in geo.STATES.items() for x in kv])
    c = table(spark, folder, "companies").select(F.explode("naics_codes").alias("naics"), geo.state_code_or_text(F.col("state")).alias("geo_code"), "employee_count").filter("naics rlike '^[0-9]{2,6}$' and naics not rlike '^0+$'")
    stats = c.filter(F.col("geo_code").isin(*geo.STATES)).groupBy("naics", "geo_code").agg(F.count("*").alias("establishments"), F.sum("employee_count").alias("employees"))
    shaped = stats.select("naics", F.concat(F.lit("sector "), "naics").alias("naics_label"), F.lit(2025).alias("year"), F.lit("state").alias("geo_level"), "geo_code", F.try_element_at(names, "geo_code").alias("geo_name"), "establishments", "employees", F.lit(None).cast("bigint").alias("annual_payroll_usd_k"))
    return reports.market_sidecar(shaped, THESIS)


def _for_labels(spark: SparkSession, folder: str) -> DataFrame:
    at = hosts(spark, folder)
    c = table(spark, folder, "companies").select("id", F.col("canonical_name").alias("name"), web.own_domain(F.col("domain"), at).alias("domain"), geo.state_code_or_text(F.col("state")).alias("state"), geo.country_code(F.col("country")).alias("country"), "naics_codes")
    return reports.label_eligibility(c, THESIS, label_keys(spark, folder).select(F.col("label_key").alias("key")))


@query
def label_eligibility(spark: SparkSession, folder: str) -> DataFrame:
    """Which companies of the thesis's states can be labelled, and why others can't."""
    return _for_labels(spark, folder).select("company_id", "what")


@query
def rows_to_label(spark: SparkSession, folder: str) -> DataFrame:
    """The file of 40 companies to label, 15 a state at most: a sampling operator."""
    return reports.to_label(_for_labels(spark, folder), 40, 3, most=15)


@query
def label_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    """All label rows of the keys whose labels disagree."""
    said = F.lower(F.trim("decision"))
    rows = table(spark, folder, "label_rows").withColumn("decision", F.when(said.isin(*files.LABELS["pursue"]), "pursue").when(said.isin(*files.LABELS["pass"]), "pass"))
    return reports.label_conflicts(rows)


@query
def finder_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Companies of the thesis whose website is to be found, in an order that has the states in proportion."""
    c = table(spark, folder, "companies").select("id", F.col("canonical_name").alias("name"), "city", web.own_domain(F.col("domain"), hosts(spark, folder)).alias("domain"), geo.state_code_or_text(F.col("state")).alias("state"), geo.country_code(F.col("country")).alias("country"), "naics_codes")
    return reports.finder_targets(c, company_uei(spark, folder), 3, THESIS)


@query
def tokens_per_company(spark: SparkSession, folder: str) -> DataFrame:
    """Model tokens a company, with the characters of each company's documents as tokens read."""
    calls = table(spark, folder, "documents").select("company_id", F.col("n_chars").alias("tokens_in"), F.lit(None).cast("bigint").alias("tokens_out"))
    return reports.tokens_a_company(calls)


def _report(spark: SparkSession, folder: str) -> DataFrame:
    """The evaluation report over all keys whose labels agree, by the companies that have the same key."""
    scored = score.score(facts(spark, folder), THESIS)
    key = keys.label_key(F.nullif("name", F.lit("")), F.col("domain"), F.col("state"))
    firsts = scored.select("company_id", key.alias("label")).filter("label is not null").groupBy("label").agg(F.min("company_id").alias("company_id")).withColumn("how", F.when(F.col("label").startswith("d:"), "domain").otherwise("name"))
    labels = _labels(spark, folder).withColumn("company_name", F.col("key")).withColumn("domain", F.when(F.col("key").startswith("d:"), F.expr("substring(key, 3)")))
    return evaluation.report(labels, firsts.join(labels.select(F.col("key").alias("label")), "label", "left_semi"), scored, 40.0)


@query
def evaluation_report(spark: SparkSession, folder: str) -> DataFrame:
    """The evaluation report's columns, but for the written reason and the components' JSON."""
    return _report(spark, folder).drop("reason", "components")


@query
def excluded_positives(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.excluded_positives(evaluation.matched_items(_report(spark, folder)))


@query
def website_records(spark: SparkSession, folder: str) -> DataFrame:
    """Raw records by source after saving made-up results of the searches for websites: every third is found."""
    targets = settle(finder_targets(spark, folder))
    found = F.col("company_id") % 3 == 0
    results = targets.select("search_key", "company_id", F.when(found, "found").otherwise("none").alias("status"), F.when(found, F.concat(F.lit("c"), "company_id", F.lit(".example"))).alias("domain"), F.when(found, 0.9).alias("confidence"), F.expr("timestamp '2026-01-01'").alias("finished_at"))
    rows = reports.website_records(table(spark, folder, "raw_records"), results, targets)
    return rows.groupBy("source").agg(F.count("*").alias("records"), F.max(values.payload_field(F.col("payload_json"), "website").cast("string")).alias("last_website"))


@query
def page_addresses(spark: SparkSession, folder: str) -> DataFrame:
    """Where companies' first pages may be, the map file of their state, and their city as it is written."""
    c = table(spark, folder, "companies").select("id", web.own_domain(F.col("domain"), hosts(spark, folder)).alias("domain"), geo.state_code_or_text(F.col("state")).alias("state"), F.upper(geo.ascii_fold(F.col("city"))).alias("city"))
    return c.select("id", F.array_join(web.homepages(F.col("domain")), " ").alias("pages"), geo.area_slug(F.col("state")).alias("area"), geo.city_title(F.col("city")).alias("city"))


@query
def kept_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Facts out of analyses that are kept as JSON, made of documents: every fourth failed."""
    d = table(spark, folder, "documents").filter("company_id is not null").groupBy("company_id").agg(F.max("n_chars").alias("n"))
    kept = F.to_json(F.struct(F.lit("makes things").alias("summary"), F.array(F.lit("castings")).alias("product_lines"), F.struct(F.col("n").alias("facility_sqft_total")).alias("size_signals"), F.struct(F.lit("yes").alias("founder_led")).alias("ownership")))
    rows = d.select("company_id", F.when(F.col("company_id") % 4 == 0, "llm_timeout").otherwise("ok").alias("status"), kept.alias("extraction_json"))
    out = load_facts(table(spark, folder, "companies").select("id"), rows)
    return out.select("company_id", "enrichment_status", "extraction.summary", F.col("extraction.size_signals.facility_sqft_total").alias("floor"), F.col("extraction.ownership.founder_led").alias("founder_led"), F.array_join("extraction.product_lines", ",").alias("product_lines"))


@query
def resolved_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of a resolve run over all raw records (rows only)."""
    former = table(spark, folder, "company_records").select(F.col("raw_record_id").alias("id"), "company_id")
    return resolve_stats(resolve(table(spark, folder, "raw_records"), hosts(spark, folder), table(spark, folder, "source_priority"), former), former)


@query
def spaced_requests(spark: SparkSession, folder: str) -> DataFrame:
    """When each event could go out if those of a kind must be 40 seconds apart."""
    e = table(spark, folder, "events").select("event_id", "event_type", F.unix_timestamp("ts").cast("double").alias("at"))
    return cached.spaced(e, "event_type", "at", "event_id", 40.0).select("event_id", "starts")


# ---- sources and streams, over files made of the tables -----------------------------------------------------------------


def _made(rows: DataFrame, what: str) -> str:
    """A folder of CSV files made of rows, in the checkpoint folder."""
    path = f"{ensure_checkpoint_dir(rows.sparkSession)}/{what}-{uuid.uuid4().hex}"
    rows.write.option("header", True).option("escape", '"').option("sep", ";").csv(path)
    return path


@query
def csv_records(spark: SparkSession, folder: str) -> DataFrame:
    """Companies written as a list with foreign headers and contact columns, and read again by the CSV source."""
    c = table(spark, folder, "companies")
    listed = c.select(F.col("id").alias("Record ID"), F.col("canonical_name").alias("Company Name"), F.col("domain").alias("Web Site"), F.col("city").alias("City"), F.col("state").alias("State"), F.col("employee_count").alias("Employees"),
                      F.lit("Ann Lee").alias("Contact Name"), F.concat(F.lit("info@c"), "id", F.lit(".example")).alias("Reach"), F.concat(F.lit("mail a.b@c.test or 203-555-0148, "), "id").alias("Remarks"))
    out = files.read_csv(spark, _made(listed, "list"), {"source_record_id": "Record ID"})
    return out.select(F.col("source_record_id").cast("bigint").alias("id"), "name", "website", "city", "state", "employees", F.array_join(F.array_sort(F.map_keys("extra")), ",").alias("further"), F.try_element_at("extra", F.lit("Remarks")).alias("remarks"))


@query
def label_file(spark: SparkSession, folder: str) -> DataFrame:
    """Label rows whose decision means something, written as a file and read again by the labels source."""
    said = F.lower(F.trim("decision"))
    rows = table(spark, folder, "label_rows").filter(said.isin(*files.LABELS["pursue"], *files.LABELS["pass"]))
    out = files.read_labels(spark, _made(rows.select(F.col("company_name").alias("Company"), F.col("website").alias("Website"), F.col("state").alias("ST"), F.col("decision").alias("Verdict")), "labels"), {"state": "ST"})
    return out.groupBy("company_name", "website", "state", "decision").agg(F.count("*").alias("labels"), F.count_distinct("row_number").alias("rows"))


@query
def streamed_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """The last delivery of each record, kept by a stream of the deliveries."""
    path = f"{ensure_checkpoint_dir(spark)}/deliveries-{uuid.uuid4().hex}"
    rows = table(spark, folder, "raw_records")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/raw_records.parque[t]")  # a pattern, as the table may be a file or a folder
    ingest.keep_table(stream, path, ["source", "source_record_id"], "payload_hash", ["ingested_at", "id"], f"{path}-progress").awaitTermination()
    return ingest.current_table(spark, path, rows.schema).select("id", "source", "source_record_id", "payload_hash")
