"""Web pages: visible text, links, names of the site, and whether a page is a company's own."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .geo import STATES
from .keys import GENERIC
from .text import word_rank

# What isn't read of a page, which pages are read, and which never.
DROPPED = {"script", "style", "noscript", "svg", "iframe", "nav", "footer", "header", "form", "template"}
WANTED = "about company who-we-are history overview products product services solutions capabilities what-we-do industries markets manufacturing facilities locations".split()
UNWANTED = (
    "contact team leadership staff people management executive board director governance career job employment privacy terms cookie legal "
    "login log-in signin sign-in account cart checkout register"
).split()
FILES = (".pdf .jpg .jpeg .png .gif .svg .webp .zip .doc .docx .xls .xlsx .ppt .pptx .mp4 .mp3 .dwg .step .stp").split()
PARKED = ["domain is for sale", "domain may be for sale", "buy this domain", "domain for sale", "parked free", "domain parking", "hugedomains", "this domain is parked", "sedo domain"]
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


class _Reader(HTMLParser):
    """Gathers title, description, site name, visible text pieces and links in one pass; a stack of dropped tags hides what is in them."""

    def __init__(self, dropped: set[str]):
        super().__init__(convert_charrefs=True)
        self.dropped, self.hidden, self.in_title, self.open_link = dropped, [], False, None
        self.title, self.description, self.site, self.pieces, self.links = "", "", "", [], []
        self.body = False
        self.head = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = {k: v or "" for k, v in attrs}
        if tag == "meta":
            if a.get("name", "").lower() == "description" and not self.description:
                self.description = a.get("content", "")
            if a.get("property", "").lower() == "og:site_name" and not self.site:
                self.site = a.get("content", "")
        elif tag in ("title", "head"):
            self.in_title, self.head = tag == "title" and not self.title, True
        elif tag == "body":
            self.body, self.head = True, False
        if tag in self.dropped and tag not in VOID:
            self.hidden.append(tag)
        if tag == "a" and a.get("href"):
            self.open_link = [a["href"].strip(), ""]

    def handle_endtag(self, tag: str) -> None:
        if tag == "title":
            self.in_title = False
        if tag == "head":
            self.head = False
        if tag in self.hidden:
            del self.hidden[len(self.hidden) - 1 - self.hidden[::-1].index(tag) :]
        if tag == "a" and self.open_link:
            self.links.append(tuple(self.open_link))
            self.open_link = None

    def handle_data(self, data: str) -> None:
        if self.in_title:
            self.title += data
        elif self.open_link is not None:
            self.open_link[1] += " " + data
        if not self.hidden and not self.in_title and not self.head:
            self.pieces.append(data)


def _read(page: str | None, keep_footer: bool) -> _Reader:
    reader = _Reader(DROPPED - {"footer", "header"} if keep_footer else DROPPED)
    reader.feed(page or "")
    reader.close()
    return reader


_squeeze = lambda s: re.sub(r"\s+", " ", s or "").strip()
_TEXT = StructType([StructField(n, StringType()) for n in ("title", "description", "site_name", "text")])
_LINKS = ArrayType(StructType([StructField("url", StringType()), StructField("path", StringType()), StructField("label", StringType())]))


def page_parts(page: str | None, keep_footer: bool = False) -> tuple[str, str, str, str]:
    """Title, description, site name and the distinct visible lines of two characters and more."""
    r = _read(page, keep_footer)
    lines = dict.fromkeys(x for x in (_squeeze(line) for piece in r.pieces for line in piece.splitlines()) if len(x) >= 2)
    return _squeeze(r.title), _squeeze(r.description), _squeeze(r.site), "\n".join(lines)


def read_page(page: Column, keep_footer: bool = False) -> Column:
    """Arrow UDF of page_parts, as a struct; empty strings for a null page."""

    @F.pandas_udf(_TEXT)
    def run(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([page_parts(p, keep_footer) for p in pages], columns=["title", "description", "site_name", "text"])

    return run(page)


def page_links(page: Column, base: Column) -> Column:
    """Arrow UDF: the page's web links as (url without query, path, label), in the order of the page."""

    @F.pandas_udf(_LINKS)
    def run(pages: pd.Series, bases: pd.Series) -> pd.Series:
        out = []
        for p, b in zip(pages, bases):
            found = []
            for href, label in _read(p, True).links:
                if href.startswith(("mailto:", "tel:", "javascript:", "#")):
                    continue
                u = urlsplit(urljoin(b or "", href))
                if u.scheme in ("http", "https"):
                    found.append((urlunsplit((u.scheme, u.netloc, u.path or "/", "", "")), u.path or "/", _squeeze(label)))
            out.append(found)
        return pd.Series(out, dtype=object)

    return run(page, base)


def best_links(links: Column, most: int) -> Column:
    """URLs of the links worth reading, by the first wanted word, depth and URL; pages about contacts, people and accounts, files and the home page are left out."""
    label = lambda x: F.concat_ws(" ", x["path"], x["label"])
    skip = "(?<![a-z])(?:" + "|".join(map(re.escape, UNWANTED)) + ")"
    file = F.lit("(?i)(?:" + "|".join(map(re.escape, FILES)) + ")$")
    fit = F.filter(links, lambda x: (x["path"] != "/") & ~F.regexp_like(x["path"], file) & ~F.regexp_like(F.lower(label(x)), F.lit(skip)) & word_rank(label(x), WANTED).isNotNull())
    ranked = F.array_sort(F.transform(fit, lambda x: F.struct(word_rank(label(x), WANTED).alias("r"), F.regexp_count(x["path"], F.lit("/")).alias("d"), x["url"].alias("u"))))
    return F.slice(F.array_distinct(F.transform(ranked, lambda x: x["u"])), 1, most)


def site_names(title: Column, site_name: Column) -> Column:
    """The parts of a title between dashes, bars, colons and bullets, and the site's own name."""
    parts = F.transform(F.split(title, "[|\\-–—:•·]"), F.trim)
    return F.filter(F.concat(parts, F.array(site_name)), lambda x: F.length(x) > 0)


# Confidence by evidence of name and of place.
CONFIDENCE = {("title", "city"): 0.95, ("title", "state"): 0.90, ("title_fuzzy", "city"): 0.85, ("body", "city"): 0.85, ("body", "state"): 0.75}


def page_verdict(name_match: Column, place_match: Column, parked: Column) -> Column:
    """(confidence, rejected) of a page by its evidence: confidence 0 with the reason, or one of CONFIDENCE without."""
    value = F.coalesce(*[F.when((name_match == n) & (place_match == p), c) for (n, p), c in CONFIDENCE.items()])
    why = F.when(parked, "parked domain").when(name_match.isNull(), "no name evidence").when(place_match.isNull(), "no city/state evidence").when(value.isNull(), "fuzzy title needs city")
    return F.struct(F.when(why.isNull(), value).otherwise(0.0).alias("confidence"), why.alias("rejected"))


def is_parked(page: Column) -> Column:
    return F.lower(page).rlike("|".join(map(re.escape, PARKED)))


def place_match(page: Column, city: Column, state: Column) -> Column:
    """city if the scrubbed page names it in whole words, else state if it has its code after a comma or before a postcode, or its name; else null."""
    flat = F.concat(F.lit(" "), F.regexp_replace(F.lower(page), "[^a-z0-9]+", " "), F.lit(" "))
    here = (F.length(city) > 0) & F.contains(flat, F.concat(F.lit(" "), city, F.lit(" ")))
    names = F.create_map(*[F.lit(x) for c, n in STATES.items() for x in (c, n.lower())])
    named = F.contains(flat, F.concat(F.lit(" "), F.try_element_at(names, state), F.lit(" ")))
    coded = F.regexp_like(page, F.concat(F.lit(",\\s*"), state, F.lit("\\b|\\b"), state, F.lit("\\s+\\d{5}\\b")))
    return F.when(F.coalesce(here, F.lit(False)), "city").when(F.coalesce(named | coded, F.lit(False)), "state")


def body_match(keys: Column, words: Column) -> Column:
    """Whether all distinctive words of a name's key (two, or one of six letters) are among a page's word keys."""
    own = F.filter(F.split(keys, " "), lambda w: ~F.array_contains(F.array(*[F.lit(g) for g in GENERIC]), w) & (F.length(w) >= 3))
    strong = (F.size(own) >= 2) | (F.length(F.get(own, 0)) >= 6)
    return F.coalesce((F.size(own) > 0) & strong & (F.size(F.array_except(own, words)) == 0), F.lit(False))
