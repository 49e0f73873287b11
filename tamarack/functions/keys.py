"""Match keys of names, sites and rows, as Spark expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geo import ascii_fold
from .values import let

# Endings of company names that say only what legal form the company has.
LEGAL_ENDINGS = "inc incorporated llc lllp corp corporation co company ltd limited lp llp plc pllc holdings holding group".split()
# Short forms with the one word they stand for.
SHORT_FORMS = {
    "mfg": "manufacturing", "mfr": "manufacturing", "mfrs": "manufacturing", "manuf": "manufacturing", "mfring": "manufacturing",
    "intl": "international", "natl": "national", "svc": "services", "svcs": "services", "srvcs": "services", "bros": "brothers",
    "eng": "engineering", "engr": "engineering", "assoc": "associates", "equip": "equipment", "dist": "distribution",
    "distr": "distribution", "elec": "electric", "ctr": "center", "tech": "technology", "mech": "mechanical", "fab": "fabrication",
}
# Words that don't tell one company from another.
GENERIC = (
    "industries industry services service enterprises enterprise group solutions solution systems system company technologies technology "
    "manufacturing products product international america american usa us national global general holdings holding partners associates "
    "corporation incorporated contracting construction supply supplies engineering consulting management resources sales southern southeast "
    "south north east west central united first"
).split()
# How guessed web addresses shorten words.
SITE_SHORT = {"manufacturing": "mfg", "company": "co", "international": "intl", "engineering": "eng", "technologies": "tech", "technology": "tech", "services": "svcs", "industries": "ind"}


def _lookup(table: Mapping[str, str], word: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, word), word)


def _among(words: Sequence[str], word: Column) -> Column:
    return F.array_contains(F.array(*[F.lit(w) for w in words]), word)


def name_tokens(name: Column) -> Column:
    """Words of a name: folded, small letters, & and + as "and", full stops gone."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(ascii_fold(name)), "[&+]", " and "), "\\.", "")
    return F.regexp_extract_all(plain, F.lit("[a-z0-9]+"), F.lit(0))


def singular(word: Column) -> Column:
    """A word without its plural ending: ies gives y, a last s goes; short words and ss, us, is stay."""
    return (
        F.when((F.length(word) <= 3) | word.rlike("(ss|us|is)$"), word)
        .when(word.endswith("ies"), F.regexp_replace(word, "ies$", "y"))
        .otherwise(F.regexp_replace(word, "s$", ""))
    )


def _drop_endings(words: Column, endings: Sequence[str]) -> Column:
    """The words without the run of endings at their end."""
    ends = F.transform(words, lambda w, i: F.when(~_among(endings, w), i + 1).otherwise(0))
    return F.slice(words, F.lit(1), F.coalesce(F.array_max(ends), F.lit(0)))


def name_key(name: Column) -> Column:
    """A name's key: short forms spelt out, legal endings and a leading "the" dropped, words in the singular.

    A name of nothing but endings keeps them.  Null gives null, a name without letters and digits an empty key.
    """

    def key(words: Column) -> Column:
        def rest(short: Column) -> Column:
            bare = F.when(F.get(short, 0) == "the", F.slice(short, 2, 1000)).otherwise(short)
            return let(bare, lambda b: F.when(F.size(b) > 0, b).otherwise(words))

        kept = let(_drop_endings(words, LEGAL_ENDINGS), rest)
        return F.array_join(F.transform(kept, singular), " ")

    return let(F.transform(name_tokens(name), lambda w: _lookup(SHORT_FORMS, w)), key)


def word_keys(text: Column) -> Column:
    """The distinct words of a text, spelt out and in the singular."""
    return F.array_sort(F.array_distinct(F.transform(name_tokens(text), lambda w: singular(_lookup(SHORT_FORMS, w)))))


def distinctive_tokens(name: Column) -> Column:
    """Words of a name that tell it apart: no endings, no generic words, three letters or more, no numbers."""
    words = F.filter(name_tokens(name), lambda w: ~w.isin("and", "the"))
    return F.filter(let(words, lambda w: _drop_endings(w, LEGAL_ENDINGS)), lambda w: ~_among(GENERIC, w) & (F.length(w) >= 3) & ~w.rlike("^[0-9]+$"))


def candidate_domains(name: Column, most: int = 4) -> Column:
    """Up to ``most`` guesses at a company's .com address; none if no distinctive word has four letters."""

    def guesses(words: Column) -> Column:
        whole, dashed = F.array_join(words, ""), F.array_join(words, "-")
        short = F.array_join(F.transform(words, lambda w: _lookup(SITE_SHORT, w)), "")
        lead = F.exists(F.slice(words, 1, 2), lambda w: ~_among(GENERIC, w) & (F.length(w) >= 3) & ~w.rlike("^[0-9]+$"))
        two = F.when((F.size(words) >= 3) & lead, F.array_join(F.slice(words, 1, 2), ""))
        fit = F.filter(F.array(whole, dashed, short, two), lambda x: x.isNotNull() & F.length(x).between(6, 40))
        return F.transform(F.slice(F.array_distinct(fit), 1, most), lambda x: F.concat(x, F.lit(".com")))

    words = let(F.filter(name_tokens(name), lambda w: ~w.isin("and", "the")), lambda w: _drop_endings(w, LEGAL_ENDINGS))
    good = F.exists(distinctive_tokens(name), lambda w: F.length(w) >= 4)
    return F.when(good, let(words, guesses)).otherwise(F.array().cast("array<string>"))


def entity_words(name: Column) -> Column:
    """group and holding(s) among a name's legal endings, as a sorted set."""
    words = name_tokens(name)
    endings = let(words, lambda w: F.slice(w, F.size(_drop_endings(w, LEGAL_ENDINGS)) + 1, F.greatest(F.size(w), F.lit(1))))
    picked = F.filter(endings, lambda w: w.isin("group", "holding", "holdings"))
    return F.array_sort(F.array_distinct(F.transform(picked, lambda w: F.when(w == "holdings", "holding").otherwise(w))))


def label_key(name: Column, domain: Column, state: Column) -> Column:
    """d:<domain>, or n:<name key>|<state in small letters> without one."""
    return F.coalesce(F.concat(F.lit("d:"), domain), F.concat(F.lit("n:"), name_key(name), F.lit("|"), F.lower(F.coalesce(state, F.lit("")))))


def search_key(uei: Column, name: Column, state: Column) -> Column:
    """uei:<id>, or n:<name key>|<state in small letters> without one."""
    return F.coalesce(F.concat(F.lit("uei:"), uei), F.concat(F.lit("n:"), name_key(name), F.lit("|"), F.lower(F.coalesce(state, F.lit("")))))


def row_hash(columns: Mapping[str, Column]) -> Column:
    """First 16 digits of the SHA-256 of a row's trimmed small-letter values with their headers, in order of the headers."""
    parts = [F.concat(F.lit(f"{h}="), F.lower(F.trim(F.coalesce(columns[h].cast("string"), F.lit(""))))) for h in sorted(columns)]
    return F.substring(F.sha2(F.concat_ws("\u001f", *parts), 256), 1, 16)


def typed_int(text: Column) -> Column:
    """A typed whole number: of a range the middle, rounded half to even, else the first number rounded so; thousands' commas are ignored."""
    plain = F.regexp_replace(text, ",", "")
    span = "(\\d+(?:\\.\\d+)?)\\s*(?:-|–|to)\\s*(\\d+(?:\\.\\d+)?)"
    a, b = F.regexp_extract(plain, span, 1).try_cast("double"), F.regexp_extract(plain, span, 2).try_cast("double")
    return F.coalesce(F.bround((a + b) / 2), F.bround(F.regexp_extract(plain, "\\d+(?:\\.\\d+)?", 0).try_cast("double"))).cast("bigint")


def typed_revenue(text: Column, unit: str = "usd_m") -> Column:
    """A typed amount in millions, rounded to four places; ``unit`` says what was typed: usd, usd_k or usd_m."""
    factor = {"usd": 1e-6, "usd_k": 1e-3, "usd_m": 1.0}[unit]
    return F.round(F.regexp_extract(F.regexp_replace(text, ",", ""), "-?\\d+(?:\\.\\d+)?", 0).try_cast("double") * factor, 4)


def naics_codes_of(text: Column) -> Column:
    """Codes with their flags out of a string like 333611Y~333612N."""
    items = F.filter(F.split(text, "~"), lambda x: x.rlike("^\\d{6}"))
    return F.transform(items, lambda x: F.struct(F.substring(x, 1, 6).alias("code"), F.nullif(F.substring(x, 7, 1), F.lit("")).alias("flag")))


def naics_matches(codes: Column, prefixes: Sequence[str]) -> Column:
    """Whether any code begins with any of the prefixes; false for null."""
    return F.coalesce(F.exists(codes, lambda c: F.exists(F.array(*[F.lit(p) for p in prefixes]), lambda p: F.startswith(c, p))), F.lit(False))


def naics_overlap(a: Column, b: Column) -> Column:
    """Whether one of two codes begins with the other, trailing zeros apart."""
    x, y = F.rtrim(a, F.lit("0")), F.rtrim(b, F.lit("0"))
    return F.startswith(x, y) | F.startswith(y, x)
