"""Scores of companies against a thesis, component by component, with the reasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import naics_matches
from ..functions.text import ordinal, phrase_in
from ..plans.thesis import PARTS, Range, Thesis
from .running import numbered

# How components are graded.
NAICS_SHARE, TEXT_SHARE, FULL_HITS, FACILITY_MOST = 0.6, 0.4, 2, 0.8
UNKNOWN, OTHER_STATE, NOT_OWNED = 0.5, 0.25, 0.25
OWNED = {"founder_led": "founder-led", "family_owned": "family-owned", "pe_or_strategic_backed": "PE- or strategic-backed", "publicly_traded": "publicly traded"}

#: Type of the extraction column that facts may have.
EXTRACTION = (
    "summary string, product_lines array<string>, end_markets array<string>, business_model string, "
    "size_signals struct<employee_count:bigint,employee_count_quote:string,facility_count:bigint,facility_sqft_total:bigint,founded_year:bigint>, "
    "ownership struct<founder_led:string,family_owned:string,generation:bigint,pe_or_strategic_backed:string,publicly_traded:string>, "
    "evidence array<struct<claim:string,page:string,quote:string>>"
)


def four(x: Column) -> Column:
    """Rounded to four places, half up."""
    return F.floor(x * 10_000 + 0.5) / 10_000


def range_fit(x: Column, r: Range) -> Column:
    """1 inside the range, falling to 0 half the bound's size beyond it; 0 beyond a bound of 0 or less."""
    out = F.lit(1.0)
    if r.high is not None:
        fall = F.greatest(F.lit(0.0), 1 - (x - r.high) / (0.5 * r.high)) if r.high > 0 else F.lit(0.0)
        out = F.when(x > r.high, fall).otherwise(out)
    if r.low is not None:
        fall = F.greatest(F.lit(0.0), 1 - (r.low - x) / (0.5 * r.low)) if r.low > 0 else F.lit(0.0)
        out = F.when(x < r.low, fall).otherwise(out)
    return F.when(x.isNotNull(), out)


def _number(x: float) -> str:
    return f"{x:g}"


def _span(r: Range) -> str:
    if r.low is not None and r.high is not None:
        return f"{_number(r.low)}-{_number(r.high)}"
    return f"at least {_number(r.low)}" if r.low is not None else f"at most {_number(r.high)}"


def _where(x: Column, r: Range) -> Column:
    out = F.lit(f"within {_span(r)}")
    if r.high is not None:
        out = F.when(x > r.high, f"above the {_span(r)} range").otherwise(out)
    if r.low is not None:
        out = F.when(x < r.low, f"below the {_span(r)} range").otherwise(out)
    return out


def _texts() -> dict[str, Column]:
    e = "extraction."
    return {
        "product lines": F.lower(F.array_join(F.col(e + "product_lines"), "; ")), "end markets": F.lower(F.array_join(F.col(e + "end_markets"), "; ")),
        "summary": F.lower(F.col(e + "summary")), "evidence": F.lower(F.array_join(F.transform(F.col(e + "evidence"), lambda x: x["quote"]), " ")),
    }


def _cite(item: Column) -> Column:
    """How a piece of evidence is quoted after a statement; empty for none."""
    page = F.when(item["page"].isNotNull() & (item["page"] != ""), F.concat(F.lit(" ("), item["page"], F.lit(")"))).otherwise("")
    return F.coalesce(F.concat(F.lit(" — '"), F.nullif(item["quote"], F.lit("")), F.lit("'"), page), F.lit(""))


def _evidence(test) -> Column:
    return F.get(F.filter(F.col("extraction.evidence"), lambda x: F.coalesce((F.length(x["quote"]) > 0) & test(x), F.lit(False))), 0)


def sector(t: Thesis) -> tuple[Column, Column, Column]:
    """Score, whether there is evidence, and why."""
    codes = F.col("naics_codes")
    hit = naics_matches(codes, t.naics_prefixes)
    code = F.get(F.filter(codes, lambda c: naics_matches(F.array(c), t.naics_prefixes)), 0)
    text = F.concat_ws(" | ", *[F.coalesce(x, F.lit("")) for x in _texts().values()])
    phrases = list(dict.fromkeys(t.keywords + t.end_markets))
    found = F.filter(F.array(*[F.when(phrase_in(p, text), p) for p in phrases]), lambda x: x.isNotNull()) if phrases else F.array().cast("array<string>")
    n = F.when(F.col("extraction").isNotNull(), F.size(found)).otherwise(0)
    score = NAICS_SHARE * hit.cast("double") + TEXT_SHARE * F.least(F.lit(1.0), n / FULL_HITS)
    mentions = F.concat(F.lit("mentions "), F.array_join(F.slice(found, 1, 4), ", "))
    known = F.coalesce(F.size(codes) > 0, F.lit(False))
    why = (
        F.when(hit & (n > 0), F.concat(F.lit("Sector fit: NAICS "), code, F.lit("; "), mentions, F.lit(".")))
        .when(hit, F.concat(F.lit("Sector: NAICS "), code, F.lit(" is in the thesis; no thesis keywords found"), F.when(F.col("extraction").isNotNull(), " in the website data.").otherwise(" (no website data).")))
        .when(n > 0, F.concat(F.lit("Sector: "), mentions, F.when(known, "; NAICS outside the thesis.").otherwise("; NAICS unknown.")))
        .otherwise(F.concat(F.lit("No sector evidence: NAICS "), F.when(known, "outside the thesis").otherwise("unknown"), F.lit(" and no thesis keywords found.")))
    )
    return score, hit | (n > 0), why


def size(t: Thesis) -> tuple[Column, Column, Column]:
    site = F.col("extraction.size_signals")
    staff = F.coalesce(F.col("employee_count"), site["employee_count"])
    source = F.when(F.col("employee_count").isNotNull(), F.coalesce("employee_count_source", F.lit("records")))
    places = site["facility_count"]
    null = F.lit(None).cast("double")
    by_staff = range_fit(staff, t.employees) if t.employees else null
    by_places = F.least(F.lit(FACILITY_MOST), range_fit(places, t.facilities)) if t.facilities else null
    main = F.when(by_staff.isNotNull(), by_staff).otherwise(F.when(places.isNotNull(), by_places))
    money = F.when(F.col("revenue_usd_m").isNotNull(), range_fit(F.col("revenue_usd_m"), t.revenue_usd_m)) if t.revenue_usd_m else null
    score = F.when(main.isNotNull() & money.isNotNull(), (main + money) / 2).otherwise(F.coalesce(main, money, F.lit(UNKNOWN)))
    quote = F.coalesce(F.concat(F.lit(" (site: '"), F.when(source.isNull(), site["employee_count_quote"]), F.lit("')")), F.concat(F.lit(" ("), F.coalesce(source, F.lit("website")), F.lit(")")))
    texts = []
    if t.employees:
        texts.append(F.when(by_staff.isNotNull(), F.concat(F.lit("~"), F.format_number(staff, 0), F.lit(" employees"), quote, F.lit(", "), _where(staff, t.employees))))
    if t.facilities:
        many = F.when(places == 1, " facility").otherwise(" facilities")
        texts.append(F.when(by_staff.isNull() & places.isNotNull(), F.concat(places.cast("string"), many, F.lit(" (no employee count), "), _where(places, t.facilities))))
    if t.revenue_usd_m:
        texts.append(F.when(money.isNotNull(), F.concat(F.lit("$"), F.format_number("revenue_usd_m", 1), F.lit("M revenue (CSV), "), _where(F.col("revenue_usd_m"), t.revenue_usd_m))))
    known = main.isNotNull() | money.isNotNull()
    why = F.when(known, F.concat(F.concat_ws("; ", *texts), F.lit("."))).otherwise("Size unknown.") if texts else F.lit("Size unknown.")
    return score, known, why


def geography(t: Thesis) -> tuple[Column, Column, Column]:
    country, state = F.col("country"), F.col("state")
    abroad = country.isNotNull() & ~country.isin(*t.countries)
    inside = state.isin(*t.states)
    score = F.when(abroad, 0.0).when(state.isNull(), UNKNOWN).when(inside, 1.0).otherwise(OTHER_STATE)
    why = F.when(abroad, F.concat(F.lit("Outside the thesis countries ("), country, F.lit(")."))).when(state.isNull(), "State unknown.").when(inside, F.concat(F.lit("In-geography ("), state, F.lit(").")))
    return score, abroad | state.isNotNull(), why.otherwise(F.concat(F.lit("Outside the thesis states ("), state, F.lit(").")))


def ownership(t: Thesis) -> tuple[Column, Column, Column]:
    if not t.prefer:
        return F.lit(UNKNOWN), F.lit(False), F.lit("")
    says = {p: F.coalesce(F.col(f"extraction.ownership.{p}"), F.lit("unknown")) for p in t.prefer}
    some = reduce(lambda a, b: a | b, [c == "yes" for c in says.values()])
    none = reduce(lambda a, b: a & b, [c == "no" for c in says.values()])
    generation = F.col("extraction.ownership.generation")
    phrase = F.concat_ws(", ", *[F.when(c == "yes", OWNED[p]) for p, c in says.items()])
    if "family_owned" in says:
        phrase = F.concat(phrase, F.when((says["family_owned"] == "yes") & (generation > 0), F.concat(F.lit(" ("), ordinal(generation), F.lit(" generation)"))).otherwise(""))
    first = F.coalesce(*[F.when(c == "yes", p) for p, c in says.items()])
    why = F.when(some, F.concat(F.upper(F.substring(phrase, 1, 1)), F.substring(phrase, F.lit(2), F.length(phrase)), _cite(_evidence(lambda x: x["claim"] == first)), F.lit(".")))
    why = why.when(none, "Not " + " or ".join(OWNED[p] for p in t.prefer) + ".").otherwise("Ownership unknown.")
    return F.when(some, 1.0).when(none, NOT_OWNED).otherwise(UNKNOWN), some | none, why


def exclusion(t: Thesis) -> Column:
    """The first rule that excludes a company, as (rule, why); null if none does: domains, then ownership, then keywords, in their order."""
    rule = lambda name, why: F.struct(F.lit(name).alias("rule"), why.alias("why"))
    tests = []
    if t.exclude_domains:
        tests.append(F.when(F.col("domain").isin(*[d.lower() for d in t.exclude_domains]), rule("domain", F.lit("Excluded: domain is on the thesis exclusion list."))))
    for s in t.exclude_ownership:
        cite = _cite(F.get(F.filter(F.col("extraction.evidence"), _claims(s)), 0))
        tests.append(F.when(F.col(f"extraction.ownership.{s}") == "yes", rule(f"ownership:{s}", F.concat(F.lit(f"Excluded: ownership signal {s}"), cite, F.lit(".")))))
    fields = {"company name": F.lower("name")} | _texts()
    for k in t.exclude_keywords:
        where = F.coalesce(*[F.when(phrase_in(k, text), label) for label, text in fields.items()])
        cite = _cite(F.get(F.filter(F.col("extraction.evidence"), _mentions(k)), 0))
        shown = F.when(F.length(cite) > 0, cite).otherwise(F.concat(F.lit(" (in "), where, F.lit(")")))
        tests.append(F.when(where.isNotNull(), rule(f"keyword:{k}", F.concat(F.lit(f"Excluded: keyword '{k}'"), shown, F.lit(".")))))
    return F.coalesce(*tests) if tests else F.lit(None).cast("struct<rule:string,why:string>")


def _claims(signal: str):
    return lambda item: F.coalesce((F.length(item["quote"]) > 0) & (item["claim"] == signal), F.lit(False))


def _mentions(phrase: str):
    return lambda item: phrase_in(phrase, F.lower(item["quote"]))


def score(facts: DataFrame, t: Thesis) -> DataFrame:
    """Scores of facts (company_id, name, domain, state, country, naics_codes, employee_count, employee_count_source, revenue_usd_m, enrichment_status, extraction).

    Adds the four components (rounded to four places), total (one place, 0 if excluded), evidenced, confidence, excluded,
    exclusion_rule and reason.  Everything is one projection: no shuffle.  Null facts are unknowns, never errors.
    """
    parts = dict(zip(PARTS, (sector(t), size(t), geography(t), ownership(t))))
    out = facts.withColumns({p: four(s) for p, (s, _, _) in parts.items()})
    seen = F.filter(F.array(*[F.when(e, p) for p, (_, e, _) in parts.items()]), lambda x: x.isNotNull())
    out = out.withColumn("evidenced", seen).withColumn("__out", exclusion(t))
    total = sum((F.col(p) * t.weights[p] for p in PARTS), F.lit(0.0))
    status = F.col("enrichment_status")
    note = F.when(status.isNull(), "Website not analyzed yet.").when(status != "ok", F.concat(F.lit("Website not analyzed ("), status, F.lit(").")))
    reason = F.concat_ws(" ", *[F.nullif(w, F.lit("")) for p in ("sector", "geography", "size", "ownership") for w in [parts[p][2]]], note)
    n = F.size("evidenced")
    return out.withColumns({
        "excluded": F.col("__out").isNotNull(), "exclusion_rule": F.col("__out.rule"),
        "total": F.when(F.col("__out").isNotNull(), 0.0).otherwise(F.floor(total * 1000 + 0.5) / 10),
        "confidence": F.when(n == 4, "high").when(n == 3, "medium").otherwise("low"),
        "reason": F.coalesce(F.col("__out.why"), reason),
    }).drop("__out")


def ranked(scores: DataFrame, id_column: str = "company_id") -> DataFrame:
    """Adds rank, blank for excluded rows: by total, confidence and id. Places are counted by ranges, so no task sorts all rows."""
    order = F.when(F.col("confidence") == "high", 0).when(F.col("confidence") == "medium", 1).otherwise(2)
    placed = numbered(scores, [F.col("excluded"), F.desc("total"), order, F.col(id_column)], "rank")
    return placed.withColumn("rank", F.when(~F.col("excluded"), F.col("rank").cast("int")))


def summary(scores: DataFrame, threshold: float) -> DataFrame:
    """(what, value, n): companies by confidence, by exclusion rule, and shortlisted or not, in one pass."""
    sets = F.array(
        F.struct(F.lit("confidence").alias("what"), F.col("confidence").alias("value")),
        F.struct(F.lit("exclusion").alias("what"), F.coalesce("exclusion_rule", F.lit("(none)")).alias("value")),
        F.struct(F.lit("shortlisted").alias("what"), (~F.col("excluded") & (F.col("total") >= threshold)).cast("string").alias("value")),
    )
    return scores.select(F.explode(sets).alias("x")).groupBy("x.what", "x.value").agg(F.count("*").alias("n"))
