"""Extractions from texts: cleaned, and stripped of what the text does not say."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, clean_list, first_sentences, numbers_in, plain

WORKFORCE = "(?i)\\b(employ\\w*|staff\\w*|people|team members?|workforce|associates?|workers?|personnel|headcount)\\b"


def quoted(evidence: Column, document: Column) -> Column:
    """The pieces of evidence whose quote stands in the document, letter case and white space apart."""
    doc = plain(document)
    return F.filter(evidence, lambda e: F.coalesce(F.contains(doc, plain(e["quote"])), F.lit(False)))


def staff_supported(count: Column, quote: Column, document: Column) -> Column:
    """Whether a quote out of the document holds the number and a word for people who work."""
    return F.coalesce((F.length(quote) > 0) & F.contains(plain(document), plain(quote)) & F.array_contains(numbers_in(quote), count) & quote.rlike(WORKFORCE), F.lit(False))


def normalised(extraction: Column) -> Column:
    """Summary of two sentences, cleaned lists of ten, fillers as nulls, six pieces of evidence with a quote."""
    size = extraction["size_signals"]
    quote = F.when(size["employee_count"].isNotNull(), blank_to_null(size["employee_count_quote"]))
    kept = F.slice(F.filter(extraction["evidence"], lambda e: blank_to_null(e["quote"]).isNotNull()), 1, 6)
    return (
        extraction.withField("summary", first_sentences(extraction["summary"])).withField("product_lines", clean_list(extraction["product_lines"]))
        .withField("end_markets", clean_list(extraction["end_markets"])).withField("size_signals.employee_count_quote", quote).withField("evidence", kept)
    )


def grounded(extraction: Column, document: Column) -> tuple[Column, Column]:
    """(extraction without unsupported claims, sorted list of what was dropped)."""
    size = extraction["size_signals"]
    found = quoted(extraction["evidence"], document)
    lost = F.size(extraction["evidence"]) - F.size(found)
    numbers = numbers_in(document)
    staff = size["employee_count"].isNotNull() & ~staff_supported(size["employee_count"], size["employee_count_quote"], document)
    gone = {n: size[n].isNotNull() & ~F.coalesce(F.array_contains(numbers, size[n]), F.lit(False)) for n in ("founded_year", "facility_sqft_total")}
    dropped = F.filter(F.array(F.when(lost > 0, F.concat(F.lit("evidence:"), lost.cast("string"))), F.when(staff, "employee_count"), *[F.when(c, n) for n, c in gone.items()]), lambda x: x.isNotNull())
    null = lambda t: F.lit(None).cast(t)
    out = extraction.withField("size_signals.employee_count", F.when(~staff, size["employee_count"]).otherwise(null("bigint")))
    out = out.withField("size_signals.employee_count_quote", F.when(~staff, size["employee_count_quote"]).otherwise(null("string")))
    for n, c in gone.items():
        out = out.withField(f"size_signals.{n}", F.when(~c, size[n]).otherwise(null("bigint")))
    return out.withField("evidence", F.filter(found, lambda e: ~F.coalesce(F.array_contains(dropped, e["claim"]), F.lit(False)))), dropped


def invalid(extraction: Column) -> Column:
    """The fields of an extraction that break their ranges, sorted: years 1700-2100, generations 1-10, counts from 0 on."""
    size, own = extraction["size_signals"], extraction["ownership"]
    checks = {
        "employee_count": size["employee_count"] < 0, "facility_count": size["facility_count"] < 0, "facility_sqft_total": size["facility_sqft_total"] < 0,
        "founded_year": ~size["founded_year"].between(1700, 2100), "generation": ~own["generation"].between(1, 10),
    }
    for signal in ("founder_led", "family_owned", "pe_or_strategic_backed", "publicly_traded"):
        checks[signal] = ~own[signal].isin("yes", "no", "unknown")
    return F.array_sort(F.filter(F.array(*[F.when(c, n) for n, c in checks.items()]), lambda x: x.isNotNull()))
