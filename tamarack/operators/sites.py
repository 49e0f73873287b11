"""Web sites of companies: guesses checked against a table of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import city_key
from ..functions.keys import candidate_domains, entity_words, name_key, word_keys
from ..functions.pages import body_match, is_parked, page_verdict, place_match, read_page, site_names
from ..functions.text import scrub_contacts
from ..session import settle
from .match import name_similarity


def verify(pairs: DataFrame) -> DataFrame:
    """Adds confidence, rejected and the evidence to pairs of a target (name, city, state) and a page (html).

    The name is a title's if a part of the title or the site's name has the same key and group words, close to one from
    similarity 93 on, else in the body if all its distinctive words are on the page.  The place is the city or the state.
    """
    read = settle(pairs.withColumn("p", read_page(F.col("html"), keep_footer=True)).drop("html"))
    page = F.concat_ws("\n", "p.title", "p.description", "p.text")
    facts = read.withColumns({"page": page, "key": F.coalesce(name_key(F.col("name")), F.lit("")), "__i": F.monotonically_increasing_id()})
    facts = settle(facts.withColumn("names", site_names(F.col("p.title"), F.col("p.site_name"))))
    each = facts.select("__i", "key", entity_words(F.col("name")).alias("e1"), F.explode("names").alias("n")).withColumn("k2", name_key(F.col("n")))
    scored = settle(each.withColumn("s", name_similarity(F.col("key"), F.col("k2"))))
    best = scored.groupBy("__i").agg(F.max("s").alias("name_score"), F.max(((F.col("s") >= 100) & (entity_words(F.col("n")) == F.col("e1"))).cast("int")).alias("exact"))
    both = facts.join(best, "__i", "left")
    clean = scrub_contacts(F.col("page"))
    name = F.when(F.col("exact") == 1, "title").when(F.col("name_score") >= 93, "title_fuzzy").when(body_match(F.col("key"), word_keys(F.col("page"))), "body")
    out = both.withColumns({"name_match": name, "place_match": place_match(clean, city_key(F.col("city")), F.col("state")), "parked": is_parked(F.col("page"))})
    verdict = page_verdict(F.col("name_match"), F.col("place_match"), F.col("parked"))
    return out.withColumn("v", verdict).select(*[c for c in pairs.columns if c != "html"], "v.confidence", "v.rejected", "name_match", "name_score", "place_match")


def find_sites(targets: DataFrame, pages: DataFrame) -> DataFrame:
    """(company_id, status, domain, confidence) of targets (company_id, name, city, state) by pages (domain, html).

    Each guessed domain that has pages is checked; its best page counts.  found: one domain is verified; ambiguous: several;
    not_found: none; too_generic: nothing could be guessed.
    """
    guessed = targets.withColumn("guesses", candidate_domains(F.col("name")))
    tried = guessed.select("company_id", "name", "city", "state", F.explode("guesses").alias("domain")).join(pages, "domain")
    good = verify(tried).filter("confidence > 0").groupBy("company_id", "domain").agg(F.max("confidence").alias("confidence"))
    per = good.groupBy("company_id").agg(F.count("*").alias("n"), F.max_by(F.struct("domain", "confidence"), F.struct("confidence", "domain")).alias("best"))
    out = guessed.select("company_id", F.size("guesses").alias("g")).join(per, "company_id", "left")
    status = F.when(F.col("g") == 0, "too_generic").when(F.col("n") == 1, "found").when(F.col("n") > 1, "ambiguous").otherwise("not_found")
    one = F.col("n") == 1
    return out.select("company_id", status.alias("status"), F.when(one, F.col("best.domain")).alias("domain"), F.when(one, F.col("best.confidence")).alias("confidence"))


def recheck(before: DataFrame, targets: DataFrame, pages: DataFrame) -> DataFrame:
    """(outcome, companies) of checking again, with kept pages alone, what was found before (company_id, status, domain)."""
    now = find_sites(targets, pages).select("company_id", F.col("status").alias("s2"), F.col("domain").alias("d2"))
    both = before.join(now, "company_id", "left")
    outcome = F.when(F.col("s2").isNull(), "not_replayable").when((F.col("status") == F.col("s2")) & F.col("domain").eqNullSafe(F.col("d2")), "same").when((F.col("status") == "found") & (F.col("s2") != "found"), "removed").when((F.col("status") != "found") & (F.col("s2") == "found"), "added").otherwise("changed")
    return both.select(outcome.alias("outcome")).groupBy("outcome").agg(F.count("*").alias("companies"))
