"""Extractions of what companies' pages say, by a model that is a plain function."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grounding import grounded, invalid, normalised
from ..functions.pages import read_page
from ..functions.persons import all_masked
from ..functions.text import build_document, scrub_contacts
from ..operators.score import EXTRACTION
from ..session import settle

VERSION = "extract-1"


def schema_hash() -> str:
    return hashlib.sha256(EXTRACTION.encode()).hexdigest()[:16]


def cache_key(document, model: str):
    """Key of an answer: what was asked of which model, with which prompt and schema."""
    return F.sha2(F.concat_ws("|", F.lit(VERSION), F.lit(model), F.lit(schema_hash()), document), 256)


def documents_of(pages: DataFrame, budget: int = 24_000, per_page: int = 8_000) -> DataFrame:
    """(company_id, document) of pages (company_id, path, html): visible text without contact details, in order of the paths."""
    read = pages.withColumn("p", read_page(F.col("html")))
    body = scrub_contacts(F.concat_ws("\n", *[F.nullif(F.col(f"p.{c}"), F.lit("")) for c in ("title", "description", "text")]))
    parts = settle(read.select("company_id", F.struct("path", body.alias("body")).alias("page")))
    return parts.groupBy("company_id").agg(F.array_sort(F.collect_list("page")).alias("pages")).select("company_id", build_document(F.col("pages"), budget, per_page).alias("document"))


def ask(documents: DataFrame, model: Callable[[str], str], name: str, kept: DataFrame | None = None) -> DataFrame:
    """(company_id, document, key, answer, error, latency_ms, cache_hit): kept answers (key, answer) first, the model for the rest.

    An answer that isn't JSON is asked for once more; an error of one document is a status and ends nothing.
    """
    asked = documents.withColumn("key", cache_key(F.col("document"), name))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for text in part["document"]:
                answer, error, began = None, None, time.time()
                for _ in range(2):
                    try:
                        answer = model(text)
                        json.loads(answer)
                        error = None
                        break
                    except ValueError:
                        answer, error = None, "llm_invalid_output"
                    except TimeoutError:
                        error = "llm_timeout"
                        break
                    except ConnectionError:
                        error = "llm_unavailable"
                        break
                    except Exception:  # noqa: BLE001 - one document's failure must not end the run
                        error = "llm_error"
                        break
                rows.append((answer, error, (time.time() - began) * 1000))
            out = part.copy()
            out[["answer", "error", "latency_ms"]] = pd.DataFrame(rows, index=part.index)
            yield out

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema) + ", answer string, error string, latency_ms double"
    if kept is None:
        return asked.mapInPandas(run, shape).withColumn("cache_hit", F.lit(False))
    hit = asked.join(kept.select("key", "answer").dropDuplicates(["key"]), "key").select(*asked.columns, "answer", F.lit(None).cast("string").alias("error"), F.lit(0.0).alias("latency_ms"), F.lit(True).alias("cache_hit"))
    return hit.unionByName(asked.join(kept.select("key").distinct(), "key", "left_anti").select(*asked.columns).mapInPandas(run, shape).withColumn("cache_hit", F.lit(False)))


def enrich(companies: DataFrame, pages: DataFrame, model: Callable[[str], str], name: str, kept: DataFrame | None = None) -> DataFrame:
    """(company_id, status, extraction, dropped, key, answer, cache_hit, latency_ms) of companies (company_id, name, city, domain).

    status: no_website, no_text, an error of the model, invalid fields as llm_invalid_output, or ok.  The extraction is
    cleaned, stripped of what the pages don't say, and its summary and quotes masked of persons' names.
    """
    docs = documents_of(pages.join(companies.select("company_id"), "company_id", "left_semi"))
    answers = settle(ask(settle(docs.filter("length(document) > 0")), model, name, kept))
    parsed = answers.withColumn("x", normalised(F.from_json("answer", EXTRACTION)))
    out, dropped = grounded(F.col("x"), F.col("document"))
    judged = settle(parsed.withColumn("bad", invalid(F.col("x"))).withColumn("g", out).withColumn("dropped", dropped))
    rows = companies.join(judged, "company_id", "left")
    status = F.when(F.col("domain").isNull(), "no_website").when(F.col("key").isNull(), "no_text").when(F.col("error").isNotNull(), F.col("error")).when(F.size("bad") > 0, "llm_invalid_output").otherwise("ok")
    quotes = F.coalesce(F.transform("g.evidence", lambda e: e["quote"]), F.array().cast("array<string>"))
    texts = F.concat(F.array("g.summary", "g.size_signals.employee_count_quote"), quotes)
    rows = rows.withColumn("m", all_masked(texts, F.coalesce("name", F.lit("")), F.coalesce("city", F.lit(""))))
    told = F.transform("g.evidence", lambda e, i: e.withField("quote", F.get("m", i + 2)))
    clean = F.col("g").withField("summary", F.get("m", F.lit(0))).withField("size_signals.employee_count_quote", F.get("m", F.lit(1))).withField("evidence", told)
    return rows.withColumn("status", status).select("company_id", "status", F.when(F.col("status") == "ok", clean).alias("extraction"), "dropped", "key", "answer", "cache_hit", "latency_ms")


def load_facts(companies: DataFrame, enrichments: DataFrame) -> DataFrame:
    """The facts that score() takes: companies (id, name, domain, state, ...) with what was kept of their analysis.

    ``enrichments`` holds (company_id, status, extraction_json); the JSON counts only where the status is ok.  Companies
    without an analysis have null as status and extraction.
    """
    kept = enrichments.select("company_id", F.col("status").alias("enrichment_status"), F.when(F.col("status") == "ok", F.from_json("extraction_json", EXTRACTION)).alias("extraction"))
    return companies.withColumnRenamed("id", "company_id").join(kept, "company_id", "left")
