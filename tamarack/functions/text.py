"""Texts: contact details, phrases, sentences, numbers, snippets, documents and headers, as Spark expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import let

REMOVED = "[removed]"
# The shapes of contact details. A number needs separators, a lettered one a capital letter.
MAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"
NUMBER = "(?<!\\d)(?:\\+?1[\\s.-]?)?(?:\\(\\d{3}\\)\\s?|\\d{3}[\\s.-])\\d{3}[\\s.-]\\d{4}(?!\\d)"
LETTERED = (
    "(?<![\\w-])(?:(?:\\+?1[.-])?(?:\\(\\d{3}\\)\\s?|\\d{3}[.-])(?=[\\d.-]*[A-Z])[0-9A-Z]{3}[.-]?[0-9A-Z]{4}"
    "|\\d{3}[.-](?=\\d*[A-Z])[0-9A-Z]{4})(?![\\w-])"
)
# What people write where a value is missing.
EMPTY = ["", "unknown", "n/a", "na", "none", "null", "not stated", "not specified"]
# Query parameters that are secrets.
SECRET_PARAMS = ["api_key", "apikey", "key", "token", "access_token", "secret", "password"]


def scrub_contacts(text: Column) -> Column:
    """Mail addresses, then phone numbers, replaced by a placeholder."""
    return F.regexp_replace(F.regexp_replace(text, MAIL, F.lit(REMOVED)), f"{NUMBER}|{LETTERED}", F.lit(REMOVED))


def has_contacts(text: Column) -> Column:
    return text.rlike(f"{MAIL}|{NUMBER}|{LETTERED}")


def phrase_in(phrase: str, text: Column) -> Column:
    """Whether a small-letter text has the phrase in whole words, the last in the plural or not."""
    words = phrase.lower().split()
    if not words:
        return F.lit(False)
    body = "\\s+".join(re.escape(w) for w in words)
    return F.coalesce(text.rlike(f"(?<![a-z0-9]){body}(?:s|es)?(?![a-z0-9])"), F.lit(False))


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "\\s+", " "))


def plain(text: Column) -> Column:
    """Squeezed and in small letters, for comparing quotes with a text."""
    return F.lower(squeeze(text))


def numbers_in(text: Column) -> Column:
    """The distinct whole numbers of a text in order of size, thousands' commas allowed; numbers beyond a bigint are left out."""
    found = F.transform(F.regexp_extract_all(text, F.lit("\\d[\\d,]*"), F.lit(0)), lambda n: F.regexp_replace(n, ",", "").try_cast("bigint"))
    return F.array_sort(F.array_distinct(F.filter(found, lambda n: n.isNotNull())))


def blank_to_null(text: Column) -> Column:
    return F.when(~F.lower(F.trim(text)).isin(*EMPTY), F.trim(text))


def clean_list(items: Column, most: int = 10) -> Column:
    """Trimmed items without fillers and, letter case apart, without repeats; the first ``most``."""
    real = F.filter(F.transform(items, blank_to_null), lambda x: x.isNotNull())
    lows = F.transform(real, F.lower)
    firsts = F.filter(F.transform(real, lambda x, i: F.struct(x.alias("x"), (F.array_position(lows, F.lower(x)) == i + 1).alias("first"))), lambda s: s["first"])
    return F.slice(F.transform(firsts, lambda s: s["x"]), 1, most)


def first_sentences(text: Column, n: int = 2) -> Column:
    """The first sentences: cut at white space after . ! or ? and before a capital letter."""
    return F.array_join(F.slice(F.split(F.trim(text), "(?<=[.!?])\\s+(?=[A-Z])"), 1, n), " ")


def snippet(text: Column, word: str, around: int = 40) -> Column:
    """What stands around the first place of a pattern in a scrubbed text, squeezed; null if it is not there."""
    at = F.regexp_instr(text, F.lit(word))
    found = F.length(F.regexp_extract(text, f"({word})", 1))
    start = F.greatest(at - around, F.lit(1))
    return F.when(at > 0, squeeze(F.substring(text, start, at + found + around - start)))


def distinct_lines(text: Column) -> Column:
    """Squeezed lines of two characters and more, each where it first stands."""
    lines = F.transform(F.split(text, "\\r\\n|\\r|\\n"), squeeze)
    return F.array_join(F.array_distinct(F.filter(lines, lambda x: F.length(x) >= 2)), "\n")


def build_document(pages: Column, budget: int = 24_000, per_page: int = 8_000) -> Column:
    """Pages (array of path and body) under headers with their paths, cut at a budget of characters a page and in all."""
    chunks = F.transform(pages, lambda p: F.trim(F.concat(F.lit("### "), p["path"], F.lit("\n"), F.substring(F.coalesce(p["body"], F.lit("")), 1, per_page))))
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("used"))

    def add(acc: Column, chunk: Column) -> Column:
        cut = F.substring(chunk, F.lit(1), F.greatest(F.lit(0), F.lit(budget) - acc["used"]))
        grown = F.when(acc["used"] == 0, cut).otherwise(F.concat(acc["text"], F.lit("\n\n"), cut))
        return F.when((acc["used"] >= budget) | (F.length(cut) == 0), acc).otherwise(F.struct(grown.alias("text"), (acc["used"] + F.length(cut) + 2).alias("used")))

    return F.aggregate(chunks, start, add, lambda acc: acc["text"])


def cache_url(url: Column, params: Column) -> Column:
    """A URL with its parameters (a map) in order of their names, secrets left out."""
    kept = F.filter(F.array_sort(F.map_entries(params)), lambda e: ~F.lower(e["key"]).isin(*SECRET_PARAMS))
    query = F.array_join(F.transform(kept, lambda e: F.concat(F.url_encode(e["key"]), F.lit("="), F.url_encode(e["value"]))), "&")
    return let(query, lambda q: F.when(F.length(q) > 0, F.concat(url, F.lit("?"), q)).otherwise(url))


def header_charset(content_type: Column) -> Column:
    """The charset that a Content-Type header names, in small letters."""
    return F.nullif(F.lower(F.regexp_extract(content_type, "(?i)charset\\s*=\\s*[\"']?([A-Za-z0-9._:-]+)", 1)), F.lit(""))


def header_filename(disposition: Column) -> Column:
    return F.nullif(F.regexp_extract(disposition, "(?i)filename\\*?\\s*=\\s*(?:UTF-8'')?\"?([^\";]+)\"?", 1), F.lit(""))


def header_retry_after(value: Column) -> Column:
    """Seconds of a Retry-After header; null for dates and nonsense."""
    return F.when(F.trim(value).rlike("^\\d+$"), F.trim(value).try_cast("bigint"))


def general_number(value: Column) -> Column:
    """A number as text without a trailing .0."""
    return F.regexp_replace(value.cast("string"), "\\.0$", "")


def ordinal(n: Column) -> Column:
    teens = (n % 100).between(10, 20)
    ending = F.when(teens, "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), ending)


def word_rank(text: Column, words: Sequence[str]) -> Column:
    """Place of the first of the words (in their order) that begins a word of the text; null if none does."""
    places = [F.when(F.lower(text).rlike(f"(?<![a-z]){re.escape(w)}"), i) for i, w in enumerate(words)]
    return F.coalesce(*places)
